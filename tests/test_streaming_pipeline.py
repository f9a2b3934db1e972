"""R1 landing stream (late correction, replay-safe) and the L4 flow end to end."""

import datetime as dt
import os

import pytest


def test_stream_landing_replaces_corrections(spark, tmp_path):
    """A late file adds its rows and replaces those of the same key; other partitions are left alone."""
    from harvestframe.sources.bronze import read_bronze
    from harvestframe.streaming.landing import land_stream
    schema = "day string, v int, source string, ingest_date string"
    landing, root, ckpt = (str(tmp_path / x) for x in ("landing", "bronze", "ckpt"))

    def land(rows):
        spark.createDataFrame(rows, schema).write.mode("append").partitionBy("source", "ingest_date").parquet(landing)
        land_stream(spark, landing, spark.createDataFrame([], schema).schema, root, ckpt, ["day"]).awaitTermination()
        return {(r.d, r.day, r.v) for r in read_bronze(spark, root).selectExpr("cast(ingest_date AS string) AS d", "day", "v").collect()}

    assert land([("01-05", 1, "w", "2024-01-01"), ("07-05", 2, "w", "2024-07-01")]) == {("2024-01-01", "01-05", 1), ("2024-07-01", "07-05", 2)}
    before = {str(f): f.stat().st_mtime_ns for f in (tmp_path / "bronze" / "source=w" / "ingest_date=2024-07-01").glob("*.parquet")}
    assert land([("01-05", 3, "w", "2024-01-01"), ("01-06", 4, "w", "2024-01-01")]) == {
        ("2024-01-01", "01-05", 3), ("2024-01-01", "01-06", 4), ("2024-07-01", "07-05", 2)}
    after = {str(f): f.stat().st_mtime_ns for f in (tmp_path / "bronze" / "source=w" / "ingest_date=2024-07-01").glob("*.parquet")}
    assert before == after


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="driver tables not present")
def test_pipeline_end_to_end(spark, tmp_path):
    from harvestframe.config import Config, TransformConfig
    from harvestframe.plans.pipeline import run_pipeline
    from harvestframe.sources import tables as T
    sf = "/root/testdata/sf0.001"
    cfg = Config(transforms=TransformConfig(min_daily_volume=1000.0))
    out = run_pipeline(spark, T.bars(spark, sf), T.weather_long(spark, sf), str(tmp_path / "p"), cfg,
                       today=dt.date(1998, 12, 15), validate=True).collect()[0]
    assert out.silver_rows > 0 and out.gold_features == 80 and out.trained is False


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="driver tables not present")
def test_pipeline_trains_saves_and_reloads(spark, tmp_path):
    """Few trees: a fit per fold, model and scaler on disk, importances as CSV, a run record per run."""
    from harvestframe.config import Config, ModelConfig, MonitoringConfig, TransformConfig
    from harvestframe.plans.pipeline import run_pipeline
    from harvestframe.plans.scoring import score_latest
    from harvestframe.plans.train import load_model, read_importance
    from harvestframe.sources import tables as T
    sf, root = "/root/testdata/sf0.001", str(tmp_path / "p")
    cfg = Config(transforms=TransformConfig(min_daily_volume=1000.0), model=ModelConfig(max_iter=3, max_depth=2, n_cv_splits=2),
                 monitoring=MonitoringConfig(lookback_years=1))
    feats = ["return_5d", "rsi", "atr_pct", "is_monday"]
    weather = T.weather_long(spark, sf)
    out = run_pipeline(spark, T.bars(spark, sf), weather, root, cfg, today=dt.date(1998, 12, 15), train=True, force_train=True,
                       enforce_gate=False, feature_cols=feats).collect()[0]
    assert out.trained and out.holdout_mae > 0 and 0 <= out.cv_da <= 1
    again = run_pipeline(spark, None, None, root, cfg, today=dt.date(1998, 12, 15), skip_ingestion=True).collect()[0]
    assert again.silver_rows == out.silver_rows and not again.trained and again.holdout_mae is None
    model, stats = load_model(spark, root)
    assert model.getNumTrees <= 3
    scored = score_latest(spark.read.parquet(f"{root}/gold"), model, feats, stats, cfg).collect()
    assert len(scored) == 5 and all(r.predicted_return_pct is not None for r in scored)
    ranked = read_importance(spark, root).collect()
    assert {r.feature for r in ranked} == set(feats) and [r.importance for r in ranked] == sorted((r.importance for r in ranked), reverse=True)
    runs = spark.read.parquet(f"{root}/runs").collect()
    assert len(runs) == 1 and runs[0].metrics["holdout_mae"] == out.holdout_mae
    with pytest.raises(FileNotFoundError):
        run_pipeline(spark, None, None, str(tmp_path / "none"), cfg, skip_ingestion=True)
