"""C1-C3 batch scoring and T2 latest rows: one output row per series, no global sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestframe.config import Config

KEY = "symbol"
# The snapshot features the reference returns with each prediction.
SNAPSHOT_FEATURES = ("rsi", "macd", "bb_pct_b", "rvol_20d", "gdd_cumulative", "heat_stress_14d")


def latest_row(df: DataFrame, keys: Sequence[str] = (KEY,), require: Sequence[str] = ()) -> DataFrame:
    """The latest row per series (optionally the latest with every ``require`` column present),
    via ``max_by(struct(*), date)`` - a partial aggregate, no sort of the table."""
    keys = list(keys)
    src = df.dropna(subset=list(require)) if require else df
    others = [c for c in df.columns if c not in keys]
    best = src.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col("date")).alias("__r"))
    return best.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in others])


def direction(pred: Column, cfg: Config = Config()) -> Column:
    """BULLISH / BEARISH / NEUTRAL."""
    m = cfg.model
    return (F.when(pred > m.bull_threshold, "BULLISH")
             .when(pred < m.bear_threshold, "BEARISH")
             .otherwise("NEUTRAL"))


def snapshot_map(features: Sequence[str] = SNAPSHOT_FEATURES, digits: int = 4) -> Column:
    """Map feature -> value rounded to 4 decimals, NULL values left out."""
    m = F.map_from_arrays(F.array(*[F.lit(c) for c in features]),
                          F.array(*[F.round(F.col(c).cast("double"), digits) for c in features]))
    return F.map_filter(m, lambda k, v: v.isNotNull())


def snapshot_long(df: DataFrame, features: Sequence[str] = SNAPSHOT_FEATURES,
                  keys: Sequence[str] = (KEY,)) -> DataFrame:
    """C3 as rows (keys..., date, feature, value)."""
    return (df.select(*keys, "date", F.explode(snapshot_map(features)).alias("feature", "value")))


def latest_features(gold: DataFrame, feature_cols: Sequence[str], n: int = 30,
                    keys: Sequence[str] = (KEY,)) -> DataFrame:
    """C3 latest-features view: the latest row's close and first ``n`` features (4 decimals,
    NULLs left out), as rows (keys..., date, close, feature, value)."""
    cols = list(feature_cols)[:n]
    last = latest_row(gold.select(*keys, "date", "close", *cols), keys)
    return last.select(*keys, "date", "close", F.explode(snapshot_map(cols)).alias("feature", "value"))


def score_latest(gold: DataFrame, model, feature_cols: Sequence[str], stats: DataFrame | None = None,
                 cfg: Config = Config(), keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Latest complete row per series -> scale -> predict -> round 4 -> label + snapshot."""
    from harvestframe.plans.mlprep import robust_apply
    from harvestframe.plans.train import assemble
    last = latest_row(gold, keys, require=feature_cols)
    x = robust_apply(last, stats, feature_cols, keys) if stats is not None else last
    pred = model.transform(assemble(x, feature_cols))
    snap = [c for c in SNAPSHOT_FEATURES if c in gold.columns]
    # the label is decided on the unrounded prediction; the snapshot is the scored (complete) row
    out = last.select(*keys, snapshot_map(snap).alias("snapshot")).join(
        pred.select(*keys, "date", "prediction"), list(keys))
    return out.select(*keys, "date", F.round("prediction", 4).alias("predicted_return_pct"),
                      direction(F.col("prediction"), cfg).alias("direction"),
                      F.lit(cfg.features.target_horizon_days).alias("horizon_days"), "snapshot")
