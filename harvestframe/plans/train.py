"""M5-M6: gradient-boosted regression with Spark ML: hold-out, walk-forward folds, importances, files.

Re-aimed from the reference's single-machine booster: ``GBTRegressor`` trains on
the cluster; numbers will not equal the reference's.  Early stopping uses a
validation tail of the *training* rows, never the test set.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestframe.config import Config
from harvestframe.plans.importance import model_scorer, permutation_importance
from harvestframe.plans.mlprep import chrono_split, fold_summary, regression_metrics, renumber, robust_apply, robust_stats, walk_forward
from harvestframe.session import written
from harvestframe.sources.bronze import write_csv, write_table

# Share of the training rows, the last of each series, that decides when boosting stops.
VALIDATION_SHARE = 0.15


def assemble(df: DataFrame, feature_cols: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(feature_cols), outputCol="features", handleInvalid="keep").transform(df)


def gbt(cfg: Config = Config(), with_validation: bool = True) -> GBTRegressor:
    m = cfg.model
    est = GBTRegressor(featuresCol="features", labelCol="target", maxIter=m.max_iter, maxDepth=m.max_depth,
                       stepSize=m.step_size, subsamplingRate=m.subsampling_rate,
                       featureSubsetStrategy=m.feature_subset_strategy,
                       minInstancesPerNode=m.min_instances_per_node, seed=m.seed)
    if with_validation:
        est = est.setValidationIndicatorCol("is_val")
    return est


def mark_validation_tail(train: DataFrame, n_train: Column, frac: float = VALIDATION_SHARE) -> DataFrame:
    """``is_val`` on the last rows of each series, from the row's position ``pos`` and the training length."""
    return train.withColumn("is_val", F.col("pos") >= n_train - F.floor(n_train * F.lit(frac)))


def fit(train: DataFrame, feature_cols: Sequence[str], n_train: Column, cfg: Config = Config()) -> GBTRegressionModel:
    return gbt(cfg).fit(assemble(mark_validation_tail(train, n_train), feature_cols))


def evaluate(model, test: DataFrame, feature_cols: Sequence[str], group: Sequence[str] = ("symbol",)) -> DataFrame:
    pred = model.transform(assemble(test, feature_cols))
    return regression_metrics(pred, list(group))


@dataclass(frozen=True)
class Trained:
    """A fitted model with the scaler of its rows; ``rows`` are the scaled rows with their role."""

    model: GBTRegressionModel
    stats: DataFrame
    rows: DataFrame
    feature_cols: tuple[str, ...]

    def holdout(self, group: Sequence[str] = ("symbol",)) -> DataFrame:
        return evaluate(self.model, self.rows.where(F.col("role") == "test"), self.feature_cols, group)


def train_model(gold: DataFrame, feature_cols: Sequence[str], cfg: Config = Config()) -> Trained:
    """M1, M2, M5: split by time, scale by the training rows, fit on them."""
    split = chrono_split(gold, feature_cols, cfg)
    stats = robust_stats(split.where(F.col("role") == "train"), feature_cols)
    rows = robust_apply(split, stats, feature_cols)
    n_train = F.col("n") - F.floor(F.col("n") * F.lit(cfg.model.test_size))
    model = fit(rows.where(F.col("role") == "train"), feature_cols, n_train, cfg)
    return Trained(model, stats, rows, tuple(feature_cols))


def fold_rows(gold: DataFrame, feature_cols: Sequence[str], cfg: Config = Config(),
              keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """All walk-forward folds as one table keyed by fold: (keys..., date, fold, role, train_end, target, features).

    Each fold's features are scaled by its own training rows; one pass fits the scalers of all folds.
    The table is written once, so that every fit reads just its fold.
    """
    keys = list(keys)
    train = chrono_split(gold, feature_cols, cfg, keys).where(F.col("role") == "train").drop("pos", "n", "role")
    rows = walk_forward(renumber(train, keys), cfg, keys)
    stats = robust_stats(rows.where(F.col("role") == "train"), feature_cols, ["fold", *keys])
    rows = robust_apply(rows, stats, feature_cols, ["fold", *keys])
    train_end = F.floor(F.col("n") / F.lit(cfg.model.n_cv_splits + 1)) * F.col("fold")
    return written(rows.select(*keys, "date", "fold", "role", "pos", train_end.alias("train_end"), "target", *feature_cols), "fold-rows")


def fold_predictions(gold: DataFrame, feature_cols: Sequence[str], cfg: Config = Config(),
                     side_by_side: int = 5, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """(keys..., date, fold, target, prediction): every validation row scored by the model of its fold.

    Up to ``side_by_side`` folds are fitted at once: their jobs share the executors, so a fold's short
    tree levels do not leave them idle.  A fold without training or validation rows is left out.
    """
    rows = fold_rows(gold, feature_cols, cfg, keys)
    have = rows.groupBy("fold").agg(F.count_if(F.col("role") == "train").alias("t"), F.count_if(F.col("role") == "val").alias("v"))
    folds = sorted(r["fold"] for r in have.where("t > 0 and v > 0").collect())  # at most n_cv_splits

    def scored(k: int) -> DataFrame:
        fold = rows.where(F.col("fold") == k)
        model = fit(fold.where(F.col("role") == "train"), feature_cols, F.col("train_end"), cfg)
        val = model.transform(assemble(fold.where(F.col("role") == "val"), feature_cols))
        return val.select(*keys, "date", "fold", "target", "prediction")

    if not folds:
        return rows.select(*keys, "date", "fold", "target", F.lit(0.0).alias("prediction")).limit(0)
    with ThreadPool(min(side_by_side, len(folds))) as pool:
        return reduce(DataFrame.unionByName, pool.map(inheritable_thread_target(rows.sparkSession)(scored), folds))


def cross_validate(gold: DataFrame, feature_cols: Sequence[str], cfg: Config = Config()) -> DataFrame:
    """A10: (metric, mean, std) over the folds' validation metrics, each fold scored by its own model."""
    return fold_summary(regression_metrics(fold_predictions(gold, feature_cols, cfg), ["fold"]), keys=())


def tree_importance(model, feature_cols: Sequence[str], spark) -> DataFrame:
    """M6 (cheap form): the model's impurity-based importances as (feature, importance)."""
    imp = model.featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(feature_cols, [float(v) for v in imp])), "feature string, importance double")


def holdout_importance(trained: Trained, repeats: int = 3) -> DataFrame:
    """M6: permutation importance on the hold-out rows."""
    rows = renumber(trained.rows.where(F.col("role") == "test").drop("pos", "n"))
    return permutation_importance(rows, trained.feature_cols, model_scorer(trained.model), repeats)


def save_model(trained: Trained, root: str, importance: DataFrame | None = None) -> None:
    """Model, scaler and the ranked importances (CSV with header) under ``root``: those given, else the trees' own."""
    spark = trained.rows.sparkSession
    trained.model.write().overwrite().save(f"{root}/model")
    write_table(trained.stats, f"{root}/scaler")
    ranked = importance if importance is not None else tree_importance(trained.model, trained.feature_cols, spark)
    ranked = ranked.select("feature", "importance").orderBy(F.desc("importance"), "feature")
    write_csv(ranked.coalesce(1), f"{root}/importance")  # one row per feature


def load_model(spark: SparkSession, root: str) -> tuple[GBTRegressionModel, DataFrame]:
    """The model and the scaler that ``save_model`` wrote."""
    return GBTRegressionModel.load(f"{root}/model"), spark.read.parquet(f"{root}/scaler")


def read_importance(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("feature string, importance double").option("header", True).csv(f"{root}/importance")
