"""M1-M4: leakage-safe model data, per series.

M1 chronological split, M2 robust scaling fit on the training rows only, M3
walk-forward folds (expanding window with a gap), M4 regression metrics.  All
are window/aggregate plans keyed by the series; a fold is attached to rows by
``explode(sequence(1, k))`` (k rows per input row), never by a cross join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestframe.config import Config
from harvestframe.functions.numeric import div
from harvestframe.operators.chunking import series_positions
from harvestframe.operators.stats import corr, exact_percentiles

KEY = "symbol"


def complete_rows(gold: DataFrame, feature_cols: Sequence[str], target: str = "target") -> DataFrame:
    """Rows with the target and every feature present."""
    return gold.dropna(subset=[target, *feature_cols])


def chrono_split(gold: DataFrame, feature_cols: Sequence[str], cfg: Config = Config(),
                 keys: Sequence[str] = (KEY,)) -> DataFrame:
    """M1: adds ``pos`` (0-based, by date), ``n`` and ``role`` in {train, test}; the last
    ``int(n * test_size)`` rows of each series are the test set."""
    keys = list(keys)
    df = series_positions(complete_rows(gold, feature_cols), keys, "date")
    test_n = F.floor(F.col("n") * F.lit(cfg.model.test_size))
    return df.withColumn("role", F.when(F.col("pos") >= F.col("n") - test_n, "test").otherwise("train"))


def robust_stats(train: DataFrame, feature_cols: Sequence[str], keys: Sequence[str] = (KEY,)) -> DataFrame:
    """M2 fit: (keys..., feature, center, scale) with center = median, scale = IQR (0 -> 1).

    Exact percentiles per (series, feature) from the distributed order statistic
    (no group is held in one task)."""
    keys = list(keys)
    long = (train.select(*keys, *[F.col(c).cast("double").alias(c) for c in feature_cols])
                 .unpivot(keys, list(feature_cols), "feature", "value"))
    q = exact_percentiles(long, [*keys, "feature"], "value", [0.25, 0.5, 0.75])
    iqr = F.col("q")[2] - F.col("q")[0]
    return q.select(*keys, "feature", F.col("q")[1].alias("center"),
                       F.when(iqr == 0, F.lit(1.0)).otherwise(iqr).alias("scale"))


def robust_apply(df: DataFrame, stats: DataFrame, feature_cols: Sequence[str], keys: Sequence[str] = (KEY,)) -> DataFrame:
    """M2 transform: join the per-series stats (one wide row per series) and scale in place."""
    keys = list(keys)
    wide = (stats.groupBy(*keys)
                 .pivot("feature", list(feature_cols))
                 .agg(F.first(F.struct("center", "scale"))))
    wide = wide.select(*keys, *[F.col(c).alias(f"__s_{c}") for c in feature_cols])
    out = df.join(wide, keys, "left")
    return out.withColumns({c: (F.col(c) - F.col(f"__s_{c}.center")) / F.col(f"__s_{c}.scale")
                            for c in feature_cols}).drop(*[f"__s_{c}" for c in feature_cols])


def fold_bounds(n: Column, k: int, gap: int) -> Column:
    """Array of (fold, train_end, val_start, val_end) for an n-row series."""
    fold = F.floor(n / F.lit(k + 1))
    return F.filter(
        F.transform(F.sequence(F.lit(1), F.lit(k)), lambda i: F.struct(
            i.alias("fold"), (fold * i).alias("train_end"), (fold * i + gap).alias("val_start"),
            F.least(fold * i + gap + fold, n).alias("val_end"))),
        lambda s: s["val_start"] < n)


def walk_forward(train: DataFrame, cfg: Config = Config(), keys: Sequence[str] = (KEY,)) -> DataFrame:
    """M3: one row per (row, fold) where the row is in that fold's train or validation range.

    ``train`` needs ``pos`` (0-based) and ``n`` per series, e.g. from ``chrono_split``
    restricted to role = train (then renumbered)."""
    m = cfg.model
    b = train.withColumn("__f", F.explode(fold_bounds(F.col("n"), m.n_cv_splits, m.gap_days)))
    role = (F.when(F.col("pos") < F.col("__f.train_end"), "train")
             .when((F.col("pos") >= F.col("__f.val_start")) & (F.col("pos") < F.col("__f.val_end")), "val"))
    return b.withColumns({"fold": F.col("__f.fold"), "role": role}).where(F.col("role").isNotNull()).drop("__f")


def renumber(df: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Fresh 0-based positions and lengths (e.g. for the training rows only)."""
    return series_positions(df, keys, "date")


def regression_metrics(df: DataFrame, group: Sequence[str], y: str = "target", p: str = "prediction") -> DataFrame:
    """M4: mae, rmse, r2, directional accuracy, corr per group, in one aggregation."""
    yc, pc = F.col(y), F.col(p)
    sse = F.sum((yc - pc) * (yc - pc))
    sst = F.var_pop(yc) * F.count(yc)
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(yc - pc)).alias("mae"),
        F.sqrt(F.avg((yc - pc) * (yc - pc))).alias("rmse"),
        (F.lit(1.0) - div(sse, sst)).alias("r2"),
        F.avg((F.signum(yc) == F.signum(pc)).cast("double")).alias("da"),
        corr(y, p).alias("corr"),
    )


def fold_summary(metrics: DataFrame, keys: Sequence[str] = (KEY,),
                 names: Sequence[str] = ("mae", "rmse", "r2", "da", "corr")) -> DataFrame:
    """A10: mean and sample std of each CV metric across folds."""
    keys = list(keys)
    long = metrics.unpivot([*keys, "fold"], list(names), "metric", "value")
    return long.groupBy(*keys, "metric").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
