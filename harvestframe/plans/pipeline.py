"""L4: the daily flow as a plain function: land, silver, gold, quality, training if due, metrics.

Tables are written between layers (this also cuts lineage, so an executor loss
recomputes from the last table, not from the raw sources).  The gate is real:
training runs only when every series passed the hard checks (``enforce_gate``).
"""

from __future__ import annotations

import datetime as dt

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestframe.config import Config
from harvestframe.operators import contracts as V
from harvestframe.operators.quality import quality_report
from harvestframe.plans.gold import build_gold, feature_columns, market_features
from harvestframe.plans.lineage import append_run, pipeline_metrics, run_record
from harvestframe.plans.silver import build_silver
from harvestframe.plans.train import cross_validate, holdout_importance, save_model, train_model
from harvestframe.sources.bronze import read_bronze, read_table, table_exists, write_bronze, write_table

CODE_VERSION = "0.2.0"
METRICS = ("mae", "rmse", "r2", "da", "corr")


def run_pipeline(spark: SparkSession, bars: DataFrame | None, weather_long: DataFrame | None, root: str,
                 cfg: Config = Config(), today: dt.date | None = None, force_train: bool = False,
                 enforce_gate: bool = True, train: bool = False, validate: bool = True,
                 feature_cols: Sequence[str] | None = None, skip_ingestion: bool = False) -> DataFrame:
    """One-row summary: silver_rows, gold_features, quality_passed, trained, and of a training the
    hold-out and cross-validation figures.

    Ingestion lands the given frames in bronze under ``root`` (re-landing replaces partitions);
    ``skip_ingestion`` builds from what is there.  Training runs on Mondays or when forced, on
    ``feature_cols`` (the market features unless given), and leaves the model, the scaler, the
    importances and a run record under ``root``.
    """
    today = today or dt.date.today()
    if not skip_ingestion:
        for name, frame in (("futures", bars), ("weather", weather_long)):
            if frame is not None:
                write_bronze(frame, f"{root}/bronze_{name}", name, today)
    landed = [read_bronze(spark, f"{root}/bronze_{n}") if table_exists(spark, f"{root}/bronze_{n}") else None for n in ("futures", "weather")]
    if landed[0] is None:
        raise FileNotFoundError(f"no futures landed under {root}")
    silver = read_table(spark, write_table(build_silver(*landed, cfg), f"{root}/silver"))
    if validate:
        silver = V.validate(silver, V.silver_rules(), "silver", V.SILVER_REQUIRED, V.SILVER_TYPES)
    gold = read_table(spark, write_table(build_gold(silver, cfg), f"{root}/gold"))
    if validate:
        gold = V.validate(gold, V.gold_rules(), "gold", V.GOLD_REQUIRED, V.GOLD_TYPES)
    feats = feature_columns(gold)
    report = read_table(spark, write_table(quality_report(gold, feats, cfg), f"{root}/quality"))
    metrics = pipeline_metrics(silver, feats, report)
    passed = metrics.select("quality_passed").first()[0] == 1
    do_train = (train and (today.weekday() == 0 or force_train)) and (passed or not enforce_gate)
    found: dict[str, float] = {}
    if do_train:
        used = list(feature_cols or [c for c in market_features(cfg) if c in feats])
        trained = train_model(gold, used, cfg)
        save_model(trained, root, holdout_importance(trained))
        hold = trained.holdout(()).first().asDict()
        found = {f"holdout_{k}": float(hold[k]) for k in METRICS if hold[k] is not None}
        found |= {f"cv_{r['metric']}": float(r["mean"]) for r in cross_validate(gold, used, cfg).collect() if r["mean"] is not None}
        params = {"features": len(used), "trees": cfg.model.max_iter, "folds": cfg.model.n_cv_splits}
        append_run(run_record(f"{today:%Y-%m-%d}", found, params, gold, CODE_VERSION), f"{root}/runs")
    figures = [F.lit(found.get(f"{kind}_{k}")).cast("double").alias(f"{kind}_{k}") for kind in ("holdout", "cv") for k in METRICS]
    return metrics.select("*", F.lit(bool(do_train)).alias("trained"), *figures)
