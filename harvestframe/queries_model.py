"""Registered queries: model data M1-M6, scoring C1-C3, lineage L1-L3, fold stats A10.

The deterministic queries evaluate a momentum baseline (prediction = return_5d in
percent) so that the evaluation operators have an exact SQL oracle; of the Spark ML
model queries M5 and M6 are checked on rows only, C1 on what the booster does not change.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestframe.checks import sql as S
from harvestframe.plans import mlprep as M
from harvestframe.plans.gold import feature_names, market_features
from harvestframe.plans.importance import PRIMES, STEP, linear_scorer, permutation_importance
from harvestframe.plans.lineage import append_run, dataset_digest, digest_of, pipeline_metrics, prediction_histogram, run_record
from harvestframe.plans.scoring import SNAPSHOT_FEATURES, direction, latest_features, latest_row, snapshot_long
from harvestframe.queries_core import gold, gold_table, silver
from harvestframe.queries_quality import QSQL, report
from harvestframe.registry import CFG, kinds_for, register
from harvestframe.session import scratch_path, written

GOLD = S.gold_sql()
MF = market_features(CFG)
m = CFG.model
BASE = "return_5d * 100"


def model_sql() -> str:
    k, gap = m.n_cv_splits, m.gap_days
    return QSQL + f""",
cr AS (SELECT symbol, date, target, {', '.join(MF)}, {BASE} AS prediction FROM gold
       WHERE target IS NOT NULL AND {' AND '.join(f'{c} IS NOT NULL' for c in MF)}),
sp AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS pos, count(*) OVER (PARTITION BY symbol) AS n FROM cr),
sp2 AS (SELECT *, CASE WHEN pos >= n - floor(n * {m.test_size!r}) THEN 'test' ELSE 'train' END AS role FROM sp),
tr AS (SELECT * EXCLUDE (pos, n), row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS pos,
              count(*) OVER (PARTITION BY symbol) AS n FROM sp2 WHERE role = 'train'),
fb AS (SELECT *, unnest(range(1, {k + 1})) AS fold FROM tr),
fb2 AS (SELECT *, (n // {k + 1}) * fold AS train_end, (n // {k + 1}) * fold + {gap} AS val_start,
               least((n // {k + 1}) * fold + {gap} + (n // {k + 1}), n) AS val_end FROM fb),
folds AS (SELECT *, CASE WHEN pos < train_end THEN 'train' WHEN pos >= val_start AND pos < val_end THEN 'val' END AS frole
          FROM fb2 WHERE val_start < n),
fm AS (SELECT symbol, fold, count(*) AS n, avg(abs(target - prediction)) AS mae,
              sqrt(avg((target - prediction) * (target - prediction))) AS rmse,
              1 - {S.div('sum((target - prediction) * (target - prediction))', 'var_pop(target) * count(target)')} AS r2,
              avg(CASE WHEN sign(target) = sign(prediction) THEN 1.0 ELSE 0.0 END) AS da,
              {S.div('covar_samp(target, prediction)', 'stddev_samp(target) * stddev_samp(prediction)')} AS corr
       FROM folds WHERE frole = 'val' GROUP BY symbol, fold)"""


MSQL = model_sql()


def split(spark, sf):
    """Model data is prepared from the materialised gold table (as in the pipeline)."""
    return M.chrono_split(gold_table(spark, sf), MF, CFG)


def train_rows(spark, sf):
    return M.renumber(split(spark, sf).where(F.col("role") == "train").drop("pos", "n"))


def folds(spark, sf):
    return M.walk_forward(train_rows(spark, sf), CFG).withColumn("prediction", F.col("return_5d") * 100)


@register("m1_chrono_split", MSQL,
          "SELECT symbol, role, count(*) AS rows, min(date) AS first_date, max(date) AS last_date FROM sp2 GROUP BY symbol, role",
          kinds_for(["symbol", "role", "rows", "first_date", "last_date"], ints=("rows",), dates=("first_date", "last_date")))
def m1_chrono_split(spark, sf):
    """M1: chronological split, the last int(n * 0.15) complete rows of each series are the test set."""
    return split(spark, sf).groupBy("symbol", "role").agg(
        F.count(F.lit(1)).alias("rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


@register("m2_robust_scaling", MSQL,
          " UNION ALL ".join(
              f"SELECT symbol, '{c}' AS feature, quantile_cont({c}, 0.5) AS center, "
              f"CASE WHEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) = 0 THEN 1.0 "
              f"ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END AS scale FROM sp2 WHERE role = 'train' GROUP BY symbol"
              for c in MF),
          kinds_for(["symbol", "feature", "center", "scale"]))
def m2_robust_scaling(spark, sf):
    """M2: median / IQR per feature, fitted on the training rows only."""
    return M.robust_stats(split(spark, sf).where(F.col("role") == "train"), MF)


@register("m3_walk_forward", MSQL,
          "SELECT symbol, fold, frole AS role, count(*) AS rows, min(date) AS first_date, max(date) AS last_date "
          "FROM folds WHERE frole IS NOT NULL GROUP BY symbol, fold, frole",
          kinds_for(["symbol", "fold", "role", "rows", "first_date", "last_date"], ints=("fold", "rows"),
                    dates=("first_date", "last_date")))
def m3_walk_forward(spark, sf):
    """M3: expanding-window folds with a gap, over the training rows."""
    return folds(spark, sf).groupBy("symbol", "fold", "role").agg(
        F.count(F.lit(1)).alias("rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


FM_COLS = ["symbol", "fold", "n", "mae", "rmse", "r2", "da", "corr"]


@register("m4_metrics", MSQL, "SELECT * FROM fm", kinds_for(FM_COLS, ints=("fold", "n")))
def m4_metrics(spark, sf):
    """M4: mae, rmse, r2, directional accuracy, corr per fold (momentum baseline predictions)."""
    return M.regression_metrics(folds(spark, sf).where(F.col("role") == "val"), ["symbol", "fold"])


@register("a10_fold_stats", MSQL + """,
fml AS (UNPIVOT fm ON mae, rmse, r2, da, corr INTO NAME metric VALUE value)""",
          "SELECT symbol, metric, avg(value) AS mean, stddev_samp(value) AS std FROM fml GROUP BY symbol, metric",
          kinds_for(["symbol", "metric", "mean", "std"]))
def a10_fold_stats(spark, sf):
    """A10: mean and sample std of each CV metric across folds."""
    return M.fold_summary(M.regression_metrics(folds(spark, sf).where(F.col("role") == "val"), ["symbol", "fold"]))


@register("c2_direction", MSQL + """,
lastc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS k FROM cr) WHERE k = 1)""",
          f"SELECT symbol, date, round(prediction, 4) AS predicted_return_pct, CASE WHEN prediction > {m.bull_threshold} "
          f"THEN 'BULLISH' WHEN prediction < {m.bear_threshold} THEN 'BEARISH' ELSE 'NEUTRAL' END AS direction FROM lastc",
          kinds_for(["symbol", "date", "predicted_return_pct", "direction"]))
def c2_direction(spark, sf):
    """Direction label of the latest complete row per series (baseline prediction, 4 decimals)."""
    g = gold(spark, sf).dropna(subset=["target", *MF])
    last = latest_row(g.select("symbol", "date", (F.col("return_5d") * 100).alias("p")))
    return last.select("symbol", "date", F.round("p", 4).alias("predicted_return_pct"),
                       direction(F.col("p"), CFG).alias("direction"))


@register("c3_snapshot", MSQL + """,
lastg AS (SELECT * FROM (SELECT g.*, row_number() OVER (PARTITION BY g.symbol ORDER BY g.date DESC) AS k
                         FROM gold g JOIN cr USING (symbol, date)) WHERE k = 1)""",
          " UNION ALL ".join(f"SELECT symbol, date, '{c}' AS feature, round(CAST({c} AS DOUBLE), 4) AS value FROM lastg WHERE {c} IS NOT NULL"
                             for c in SNAPSHOT_FEATURES),
          kinds_for(["symbol", "date", "feature", "value"]))
def c3_snapshot(spark, sf):
    """Feature snapshot (4 decimals, NULLs left out) of the latest complete row per series."""
    g = gold(spark, sf).dropna(subset=["target", *MF])
    return snapshot_long(latest_row(g.select("symbol", "date", *SNAPSHOT_FEATURES)))


FIRST30 = feature_names(CFG)[:30]


@register("c3_latest_features", GOLD + """,
lastg AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS k FROM gold) WHERE k = 1)""",
          " UNION ALL ".join(f"SELECT symbol, date, close, '{c}' AS feature, round(CAST({c} AS DOUBLE), 4) AS value FROM lastg "
                             f"WHERE {c} IS NOT NULL" for c in FIRST30),
          kinds_for(["symbol", "date", "close", "feature", "value"]))
def c3_latest_features(spark, sf):
    """C3 latest-features view: close and the first 30 features of the latest row per series."""
    return latest_features(gold(spark, sf), FIRST30)


BUCKETS = [f"le_{str(e).replace('-', 'm').replace('.', 'p')}" for e in m.prediction_buckets]


@register("l3_prediction_histogram", MSQL,
          "SELECT " + ", ".join(f"CAST(count(*) FILTER (WHERE prediction <= {float(e)!r}) AS BIGINT) AS {b}"
                                for e, b in zip(m.prediction_buckets, BUCKETS))
          + ", count(prediction) AS le_inf, sum(prediction) AS sum FROM cr",
          kinds_for([*BUCKETS, "le_inf", "sum"], ints=(*BUCKETS, "le_inf")))
def l3_prediction_histogram(spark, sf):
    """L3: cumulative histogram of predictions with the reference's bucket edges."""
    g = gold(spark, sf).dropna(subset=["target", *MF]).withColumn("prediction", F.col("return_5d") * 100)
    return prediction_histogram(g, "prediction", CFG)


@register("l3_pipeline_metrics", MSQL,
          f"SELECT (SELECT count(*) FROM silver) AS silver_rows, {80} AS gold_features, "
          "(SELECT CAST(coalesce(bool_and(passed), false) AS INTEGER) FROM qall WHERE \"check\" = 'overall') AS quality_passed",
          kinds_for(["silver_rows", "gold_features", "quality_passed"], ints=("silver_rows", "gold_features", "quality_passed")))
def l3_pipeline_metrics(spark, sf):
    """L3: silver rows, gold feature count, quality verdict (1/0)."""
    from harvestframe.plans.gold import feature_columns
    g = gold(spark, sf)
    return pipeline_metrics(silver(spark, sf), feature_columns(g), report(spark, sf))


# ---------------------------------------------------------------- Spark ML
_MODELS: dict = {}


def trained_model(spark, sf):
    """The model, fitted once per content of the training data; M5, M6 and C1 share it."""
    from harvestframe.plans.train import train_model
    g = gold_table(spark, sf)
    key = (spark.sparkContext.applicationId, *dataset_digest(g).first())
    if key not in _MODELS:
        _MODELS[key] = train_model(g, MF, CFG)
    return _MODELS[key], g


@register("m5_gbt_train")
def m5_gbt_train(spark, sf):
    """M5: gradient-boosted trees (Spark ML) on the scaled training rows; hold-out metrics per symbol."""
    return trained_model(spark, sf)[0].holdout()


_FOLDS: dict = {}


def scored_folds(spark, sf):
    """The validation rows scored by their fold's model, fitted once per content of the training data."""
    from harvestframe.plans.train import fold_predictions
    g = gold_table(spark, sf)
    key = (spark.sparkContext.applicationId, *dataset_digest(g).first())
    if key not in _FOLDS:
        _FOLDS[key] = written(fold_predictions(g, MF, CFG), "fold-predictions")
    return _FOLDS[key]


@register("m4_fold_models")
def m4_fold_models(spark, sf):
    """M4: mae, rmse, r2, directional accuracy, corr per series and fold, scored by the model of each fold."""
    return M.regression_metrics(scored_folds(spark, sf), ["symbol", "fold"])


@register("a10_fold_models")
def a10_fold_models(spark, sf):
    """A10: mean and sample std over the folds of each metric of the fold models."""
    return M.fold_summary(M.regression_metrics(scored_folds(spark, sf), ["fold"]), keys=())


@register("m6_feature_importance")
def m6_feature_importance(spark, sf):
    """M6: feature importances of the trained model, written as CSV and read back, ranked."""
    from harvestframe.plans.train import read_importance, save_model
    root = scratch_path(spark, "model")
    save_model(trained_model(spark, sf)[0], root)
    return read_importance(spark, root).orderBy(F.desc("importance"))


@register("m6_permutation_importance")
def m6_permutation_importance(spark, sf):
    """M6: permutation importance of the trained model on the hold-out rows, written as CSV and read back, ranked."""
    from harvestframe.plans.train import holdout_importance, read_importance, save_model
    trained, root = trained_model(spark, sf)[0], scratch_path(spark, "model")
    save_model(trained, root, holdout_importance(trained))
    return read_importance(spark, root).orderBy(F.desc("importance"))


# Fixed scorer of the importance that SQL can follow; a weight of 0 is a feature that cannot matter.
LINEAR = {"return_5d": 80.0, "rsi": 0.05, "atr_pct": 60.0, "price_to_sma_20": 30.0, "is_monday": 0.0}
REPEATS = 3


def linear_importance_sql() -> str:
    plain = " + ".join(f"{w} * a.{c}" for c, w in LINEAR.items())
    dealt = " UNION ALL ".join(f"SELECT '{c}' AS feature, r, avg(abs(a.target - ({plain} - {w} * a.{c} + {w} * b.{c}))) AS mae FROM dealt a "
                               "JOIN te b ON b.symbol = a.symbol AND b.tpos = a.donor GROUP BY r" for c, w in LINEAR.items())
    return MSQL + f""",
te AS (SELECT * EXCLUDE (pos, n), row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS tpos, count(*) OVER (PARTITION BY symbol) AS tn
       FROM sp2 WHERE role = 'test'),
dealt AS (SELECT te.*, r, ([{', '.join(map(str, PRIMES))}][r % {len(PRIMES)} + 1] * tpos + 1 + (r * {STEP}) % greatest(tn - 1, 1)) % tn AS donor
          FROM te, (SELECT unnest(range({REPEATS})) AS r)),
base AS (SELECT avg(abs(a.target - ({plain}))) AS mae FROM te a),
grown AS ({dealt}),
imp AS (SELECT feature, avg(grown.mae - base.mae) AS importance, stddev_samp(grown.mae - base.mae) AS spread FROM grown, base GROUP BY feature)"""


@register("m6_permutation_linear", linear_importance_sql(), "SELECT *, row_number() OVER (ORDER BY importance DESC, feature) AS rank FROM imp",
          kinds_for(["feature", "importance", "spread", "rank"], ints=("rank",), strs=("feature",)))
def m6_permutation_linear(spark, sf):
    """M6: permutation importance of a fixed linear scorer on the hold-out rows."""
    rows = M.renumber(split(spark, sf).where(F.col("role") == "test").drop("pos", "n"))
    return permutation_importance(rows, list(LINEAR), linear_scorer(LINEAR.values()), REPEATS)


@register("c1_score_latest", MSQL + f""",
lastf AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS k FROM gold
                         WHERE {' AND '.join(f'{c} IS NOT NULL' for c in MF)}) WHERE k = 1)""",
          " UNION ALL ".join(f"SELECT symbol, date, {CFG.features.target_horizon_days} AS horizon_days, true AS scored, '{c}' AS feature, "
                             f"round(CAST({c} AS DOUBLE), 4) AS value FROM lastf WHERE {c} IS NOT NULL" for c in SNAPSHOT_FEATURES),
          kinds_for(["symbol", "date", "horizon_days", "scored", "feature", "value"], ints=("horizon_days",), bools=("scored",)))
def c1_score_latest(spark, sf):
    """Latest complete row per series scored with the saved and reloaded model and scaler; the columns
    that do not depend on the booster: horizon, whether a prediction and a direction came, and the snapshot."""
    from harvestframe.plans.scoring import score_latest
    from harvestframe.plans.train import load_model, save_model
    trained, g = trained_model(spark, sf)
    root = scratch_path(spark, "model")
    save_model(trained, root)
    model, stats = load_model(spark, root)
    out = score_latest(g, model, MF, stats, CFG)
    scored = F.col("predicted_return_pct").isNotNull() & F.col("direction").isin("BULLISH", "BEARISH", "NEUTRAL")
    return out.select("symbol", "date", "horizon_days", scored.alias("scored"), F.explode("snapshot").alias("feature", "value"))


@register("l1_run_record", GOLD, "SELECT 'baseline' AS run_id, count(*) AS rows, min(date) AS start_date, max(date) AS end_date, 5 AS n_metrics FROM gold",
          kinds_for(["run_id", "rows", "start_date", "end_date", "n_metrics"], ints=("rows", "n_metrics"), dates=("start_date", "end_date"), strs={"run_id"}))
def l1_run_record(spark, sf):
    """L1: a run record (metrics, params, rows, date range, digest) appended to a table and read back."""
    g = gold_table(spark, sf)
    met = {r["metric"]: r["mean"] for r in
           M.fold_summary(M.regression_metrics(folds(spark, sf).where(F.col("role") == "val"), ["fold"]), keys=())
           .collect()}  # five metrics
    path = scratch_path(spark, "runs")
    append_run(run_record("baseline", met, {"test_size": m.test_size, "n_cv_splits": m.n_cv_splits}, g, "0.2.0"), path)
    return spark.read.parquet(path).select("run_id", "rows", "start_date", "end_date", F.size("metrics").alias("n_metrics"))


@register("l2_dataset_digest")
def l2_dataset_digest(spark, sf):
    """L2: order-insensitive digest of the gold table (same data -> same digest)."""
    return dataset_digest(gold(spark, sf))


def _digest_cases_sql() -> str:
    cases = {"same_rows": "SELECT k, a, b FROM v", "null_moved": "SELECT k, b AS a, a AS b FROM v",
             "row_repeated": "SELECT k, a, b FROM v UNION ALL SELECT k, a, b FROM v WHERE k % 50 = 1",
             "other_row_repeated": "SELECT k, a, b FROM v WHERE k % 50 <> 1 UNION ALL SELECT k, a, b FROM v WHERE k % 50 = 2"}
    return " UNION ALL ".join(f"SELECT '{name}' AS \"case\", NOT EXISTS (({q}) EXCEPT ALL SELECT k, a, b FROM v) AND "
                              f"NOT EXISTS (SELECT k, a, b FROM v EXCEPT ALL ({q})) AS same FROM (SELECT 1)" for name, q in cases.items())


@register("l2_digest_cases", "v AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS a, o_custkey AS b FROM orders)",
          _digest_cases_sql(), [("case", "s"), ("same", "b")])
def l2_digest_cases(spark, sf):
    """L2: which changed copies of a table the digest tells from it: reordered, a NULL in the other of two equal
    columns, a repeated row, one row in the place of another."""
    from harvestframe.sources import tables as T
    v = T.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")).alias("a"), F.col("o_custkey").alias("b"))
    cases = {"same_rows": v.orderBy(F.desc("k")), "null_moved": v.select("k", F.col("b").alias("a"), F.col("a").alias("b")),
             "row_repeated": v.unionByName(v.where("k % 50 = 1")),
             "other_row_repeated": v.where("k % 50 <> 1").unionByName(v.where("k % 50 = 2"))}
    marked = [df.withColumn("case", F.lit(name)) for name, df in {"": v, **cases}.items()]
    one = reduce(DataFrame.unionByName, marked).groupBy("case").agg(F.concat_ws(":", F.count("*"), digest_of(["k", "a", "b"])).alias("digest"))
    plain = one.where("case = ''").select(F.col("digest").alias("plain"))
    return one.where("case <> ''").join(F.broadcast(plain), F.lit(True)).select("case", (F.col("digest") == F.col("plain")).alias("same"))
