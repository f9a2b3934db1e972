"""EMA scan, as-of join, weather pivot/units, contracts, PSI, folds, planning."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F


def test_ema_block_scan_matches_pandas(spark):
    from harvestframe.operators.ema import EmaSpec, alpha_from_com, alpha_from_span, with_ema
    rng = np.random.default_rng(0)
    frames = []
    for s, n in (("a", 3000), ("b", 40), ("c", 1)):
        x = 100 + np.cumsum(rng.normal(0, 1, n))
        lead = np.r_[[np.nan] * min(3, n - 1), x[min(3, n - 1):]]
        frames.append(pd.DataFrame({"symbol": s, "date": pd.date_range("2000-01-01", periods=n).date,
                                    "x": x, "y": lead, "z": rng.normal(0, 5, n)}))
    pdf = pd.concat(frames)
    specs = [EmaSpec("e5", "x", alpha_from_span(5)), EmaSpec("e60", "x", alpha_from_span(60)),
             EmaSpec("ey", "y", alpha_from_com(13)), EmaSpec("ez", "z", alpha_from_span(9))]
    out = with_ema(spark.createDataFrame(pdf), specs).toPandas().sort_values(["symbol", "date"])
    for s, g in pdf.groupby("symbol"):
        o = out[out.symbol == s]
        for sp in specs:
            exp = g[sp.src].ewm(alpha=sp.alpha, adjust=False).mean().values
            got = o[sp.out].astype(float).values
            assert (np.isnan(exp) == np.isnan(got)).all()
            m = ~np.isnan(exp)
            np.testing.assert_allclose(got[m], exp[m], rtol=1e-10, atol=1e-9)


def test_asof_nearest_tie_miss_and_null_field(spark):
    from harvestframe.operators.asof import asof_join
    d = dt.date
    spine = spark.createDataFrame([("s", d(2024, 1, 10)), ("s", d(2024, 2, 1)), ("s", d(2024, 3, 1))], "symbol string, date date")
    right = spark.createDataFrame([(d(2024, 1, 8), 1.0), (d(2024, 1, 12), 2.0), (d(2024, 2, 20), 3.0),
                                   (d(2024, 3, 2), None)], "date date, v double")
    got = {r["date"]: r["v"] for r in asof_join(spine, right, 3).collect()}
    assert got[d(2024, 1, 10)] == 1.0          # tie (2 before vs 2 after) -> earlier
    assert got[d(2024, 2, 1)] is None           # nothing within 3 days
    assert got[d(2024, 3, 1)] is None           # matched row with a NULL field stays NULL
    back = {r["date"]: r["v"] for r in asof_join(spine, right, 3, "forward").collect()}
    assert back[d(2024, 1, 10)] == 2.0


def test_weather_pivot_station_mean_units(spark):
    from harvestframe.plans.silver import clean_weather
    rows = [("2024-01-01", "station_a", "TMAX", 86.0), ("2024-01-01", "station_a", "TMIN", 66.0),
            ("2024-01-01", "station_a", "PRCP", 0.5), ("2024-01-01", "station_a", "SNOW", 1.0),
            ("2024-01-01", "station_b", "TMAX", 90.0), ("2024-01-01", "station_b", "TMIN", 70.0),
            ("2024-01-01", "station_b", "PRCP", 1.5), ("2024-01-01", "station_b", "SNOW", 0.0)]
    w = spark.createDataFrame(rows, "date string, region string, datatype string, value double")
    r = clean_weather(w).collect()[0]
    assert (r.tmax_f, r.tmin_f, r.prcp_in) == (88.0, 68.0, 1.0)
    assert r.snow_mm == pytest.approx(12.7)


def _silver_df(spark, silver_pdf):
    return spark.createDataFrame(silver_pdf)


def test_contracts_detect_each_violation(spark, silver_pdf):
    from harvestframe.operators import contracts as V
    base = silver_pdf[silver_pdf.symbol == "corn"].reset_index(drop=True)
    V.validate(spark.createDataFrame(base), V.silver_rules(), "silver", V.SILVER_REQUIRED)
    neg = base.copy(); neg.loc[5, "close"] = -10.0
    hl = base.copy(); hl.loc[10, "high"] = hl.loc[10, "low"] - 5
    dup = pd.concat([base, base.head(5)])
    for bad, rule in ((neg, "close_gt_0"), (hl, "high_ge_low"), (dup, "unique_symbol_date")):
        with pytest.raises(V.DataContractError, match=rule):
            V.validate(spark.createDataFrame(bad), V.silver_rules(), "silver", V.SILVER_REQUIRED)


def test_gold_contract_and_rsi(spark, gold_pdf):
    from harvestframe.operators import contracts as V
    rep = {r.rule: r.passed for r in V.report(spark.createDataFrame(gold_pdf), V.gold_rules(), V.GOLD_REQUIRED).collect()}
    assert all(rep.values()), rep


def _psi(spark, ref, cur):
    from harvestframe.operators.quality import psi_long
    n = len(ref) + len(cur)
    pdf = pd.DataFrame({"symbol": "s", "date": pd.date_range("2000-01-01", periods=n).date,
                        "v": np.r_[ref, cur]})
    return psi_long(spark.createDataFrame(pdf), ["v"]).collect()[0]["psi"]


def test_psi_identical_and_shifted(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(0, 1, 500)
    assert _psi(spark, a, a) < 0.01
    assert _psi(spark, rng.normal(0, 1, 500), rng.normal(5, 1, 500)) > 0.2


def test_psi_matches_numpy(spark):
    rng = np.random.default_rng(2)
    ref, cur = rng.normal(0, 1, 300), rng.normal(0.3, 1.2, 300)
    bins = np.unique(np.percentile(ref, np.linspace(0, 100, 11)))
    r = np.histogram(ref, bins)[0] / len(ref)
    c = np.histogram(cur, bins)[0] / len(cur)
    r, c = np.where(r == 0, 1e-6, r), np.where(c == 0, 1e-6, c)
    assert _psi(spark, ref, cur) == pytest.approx(float(np.sum((c - r) * np.log(c / r))), rel=1e-12)


def test_quality_empty_fails(spark):
    from harvestframe.operators.quality import quality_report
    e = spark.createDataFrame([], "symbol string, date date, close double, target double, log_return_1d double, rsi double")
    rows = quality_report(e, ["rsi"]).collect()
    assert [(r.check, r.passed, r.value) for r in rows] == [("row_count", False, 0.0), ("overall", False, None)]
    assert quality_report(e, ["rsi"], checks=["feature_nulls"]).count() == 0


def test_quality_report_passes_on_fixture(spark, gold_pdf):
    from harvestframe.config import Config, MonitoringConfig
    from harvestframe.operators.quality import quality_report
    from harvestframe.plans.gold import feature_names
    cfg = Config(monitoring=MonitoringConfig(lookback_years=2))
    rep = {(r.symbol, r.check): r.passed for r in quality_report(spark.createDataFrame(gold_pdf), feature_names(), cfg).collect()}
    assert rep[("corn", "leakage_check")] and rep[("corn", "date_continuity")]


@pytest.mark.parametrize("n,k,gap", [(300, 5, 5), (200, 4, 5), (200, 3, 7), (250, 4, 5)])
def test_walk_forward_folds(spark, n, k, gap):
    from harvestframe.config import Config, ModelConfig
    from harvestframe.plans.mlprep import walk_forward
    df = spark.createDataFrame([("s", i, n) for i in range(n)], "symbol string, pos int, n int")
    out = walk_forward(df, Config(model=ModelConfig(n_cv_splits=k, gap_days=gap))).toPandas()
    fold = n // (k + 1)
    for i in range(1, k + 1):
        tr = set(out[(out.fold == i) & (out.role == "train")].pos)
        va = set(out[(out.fold == i) & (out.role == "val")].pos)
        assert tr == set(range(fold * i))
        assert va == set(range(fold * i + gap, min(fold * i + gap + fold, n)))
        assert not tr & va and min(va) - max(tr) == gap + 1


def test_incremental_plan_refetches_current_half(spark):
    from harvestframe.sources.planning import fetch_plan
    today = dt.date(2024, 8, 15)
    start = dt.date(2022, 1, 1)
    halves = [dt.date(y, m, 1) for y in (2022, 2023, 2024) for m in (1, 7) if dt.date(y, m, 1) <= today]
    present = spark.createDataFrame([("st", h.isoformat()) for h in halves], "source string, ingest_date string")
    st = spark.createDataFrame([("st",)], "source string")
    plan = {r.period_start for r in fetch_plan(st, present, start, today, today).collect()}
    assert dt.date(2024, 7, 1) in plan and dt.date(2022, 1, 1) not in plan


def test_bronze_idempotent_overwrite(spark, tmp_path):
    from harvestframe.sources.bronze import list_partitions, read_bronze, write_bronze
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string")
    root = str(tmp_path / "bronze")
    write_bronze(df, root, "weather", "2024-01-01")
    write_bronze(df, root, "weather", "2024-01-01")
    write_bronze(df, root, "weather", "2024-01-02")
    assert read_bronze(spark, root, "weather").count() == 4
    assert read_bronze(spark, root, "weather", "2024-01-02", "2024-01-02").count() == 2
    assert list_partitions(spark, root).count() == 2


@pytest.mark.parametrize("per_e", [2, 65536])
def test_exact_percentiles_match_numpy(spark, per_e):
    from harvestframe.operators.stats import exact_percentiles
    rng = np.random.default_rng(0)
    pdf = pd.concat([pd.DataFrame({"g": "a", "v": rng.normal(0, 1, 5000)}),
                     pd.DataFrame({"g": "b", "v": rng.integers(0, 5, 999).astype(float)}),
                     pd.DataFrame({"g": "flag", "v": (rng.random(20_000) < 0.3).astype(float)}),
                     pd.DataFrame({"g": "wide", "v": rng.normal(0, 1, 500) * 10.0 ** rng.integers(-300, 300, 500)}),
                     pd.DataFrame({"g": "narrow", "v": 1.7e9 + rng.random(3000) * 1e-3}),
                     pd.DataFrame({"g": "signs", "v": rng.integers(-6, 7, 2001) * 1000.0}),
                     pd.DataFrame({"g": "zeros", "v": [0.0, -0.0, 5e-324, -5e-324, 0.0, 1.0]}),
                     pd.DataFrame({"g": "c", "v": [3.0]}), pd.DataFrame({"g": "d", "v": [1.0, 2.0]})])
    probs = [0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r.g: r.q for r in exact_percentiles(spark.createDataFrame(pdf), ["g"], "v", probs, per_e=per_e).collect()}
    for g, sub in pdf.groupby("g"):
        np.testing.assert_allclose(got[g], np.percentile(sub.v.values, [p * 100 for p in probs]), rtol=1e-12, atol=1e-12)


def test_exact_percentiles_of_infinities_nulls_and_no_rows(spark):
    from harvestframe.operators.stats import exact_percentiles
    inf, schema = float("inf"), "g string, v double"
    rows = [("a", -inf), ("a", 1.0), ("a", inf), ("a", None), (None, 4.0), ("b", None)]
    got = exact_percentiles(spark.createDataFrame(rows, schema), ["g"], "v", [0.0, 0.5, 1.0]).collect()
    assert [(r.g, r.q) for r in got] == [("a", [-inf, 1.0, inf])]
    assert exact_percentiles(spark.createDataFrame([], schema), ["g"], "v", [0.5]).collect() == []


def test_percentiles_and_psi_start_no_job_while_planned(spark):
    from harvestframe.operators.quality import psi_long
    from harvestframe.operators.stats import exact_percentiles
    rows = [("s", dt.date(2024, 1, 1) + dt.timedelta(i), float(i % 37)) for i in range(200)]
    df = spark.createDataFrame(rows, "symbol string, date date, v double")
    spark.sparkContext.setJobGroup("planning", "no job")
    try:
        psi = psi_long(df, ["v"])
        exact_percentiles(df, ["symbol"], "v", [0.5])
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    r = psi.collect()[0]
    ref, cur = np.arange(100) % 37, np.arange(100, 200) % 37
    edges = np.unique(np.percentile(ref, np.linspace(0, 100, 11)))
    a, b = (np.histogram(x, edges)[0] / 100 for x in (ref, cur))
    a, b = np.where(a == 0, 1e-6, a), np.where(b == 0, 1e-6, b)
    assert abs(r.psi - ((b - a) * np.log(b / a)).sum()) < 1e-9 and (r.n_ref, r.n_cur) == (100, 100)


@pytest.mark.parametrize("keep,expected", [("first", 1.0), ("last", 3.0)])
def test_dedupe_keeps_by_ingest_order(spark, keep, expected):
    from harvestframe.operators.reshape import dedupe_keep
    rows = [("s", dt.date(2024, 1, 2), 2.0, "2024-01-02"), ("s", dt.date(2024, 1, 2), 1.0, "2024-01-01"),
            ("s", dt.date(2024, 1, 2), 3.0, "2024-01-03"), ("s", dt.date(2024, 1, 3), 9.0, "2024-01-01")]
    df = spark.createDataFrame(rows, "symbol string, date date, close double, ingest_date string")
    out = {r.date: r.close for r in dedupe_keep(df, ["symbol", "date"], ["ingest_date"], keep).collect()}
    assert out == {dt.date(2024, 1, 2): expected, dt.date(2024, 1, 3): 9.0}
    assert dedupe_keep(df, ["symbol", "date"], ["ingest_date"], keep).columns == df.columns


@pytest.mark.parametrize("block", [365, 400, 1243])
def test_long_moments_match_pandas(spark, block):
    """Block-anchored O(1) rolling count/mean/std across block boundaries, with NULLs and a trend."""
    from pyspark.sql import functions as F
    from harvestframe.operators.windows import add_long_moments, row_index
    rng = np.random.default_rng(11)
    frames = []
    for s, n in (("a", 3000), ("b", 700)):
        x = 50 + 0.01 * np.arange(n) + rng.normal(0, 3, n)
        x[rng.random(n) < 0.1] = np.nan
        frames.append(pd.DataFrame({"symbol": s, "date": pd.date_range("2000-01-01", periods=n).date, "x": x}))
    pdf = pd.concat(frames)
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "symbol string, date date, x double")
    df = df.withColumn("__rn", row_index(("symbol",), "date"))
    df = df.withColumn("__blk", F.floor(F.col("__rn") / F.lit(block)))
    out = add_long_moments(df, "x", 365, "m", ("symbol",), block=block).toPandas().sort_values(["symbol", "date"])
    for s, g in pdf.groupby("symbol"):
        o = out[out.symbol == s]
        r = g["x"].rolling(365, min_periods=30)
        exp_mean, exp_std = r.mean().values, r.std().values
        ok = g["x"].rolling(365, min_periods=30).count().values >= 30
        got_mean = np.where(o["m_n"].values >= 30, o["m_mean"].astype(float).values, np.nan)
        got_std = np.where(o["m_n"].values >= 30, o["m_std"].astype(float).values, np.nan)
        np.testing.assert_array_equal(~np.isnan(exp_mean), ok)
        np.testing.assert_allclose(got_mean[ok], exp_mean[ok], rtol=1e-12)
        np.testing.assert_allclose(got_std[ok], exp_std[ok], rtol=1e-10)


def test_bronze_write_splits_a_hot_partition(spark, tmp_path):
    """One partition with nearly all rows becomes several files, and listing opens none of them."""
    import glob
    from harvestframe.sources.bronze import list_partitions, write_bronze
    root = str(tmp_path / "hot")
    key, size = "spark.sql.adaptive.advisoryPartitionSizeInBytes", spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set(key, "1m")
    try:
        df = spark.range(400_000).selectExpr("id", "uuid() AS u", "'hot' AS source", "if(id % 100 = 0, '2024-07-01', '2024-01-01') AS ingest_date")
        write_bronze(df, root)
    finally:
        spark.conf.set(key, size)
    assert len(glob.glob(f"{root}/source=hot/ingest_date=2024-01-01/*.parquet")) > 3
    assert spark.read.parquet(root).count() == 400_000
    for f in glob.glob(f"{root}/source=hot/*/*.parquet"):
        open(f, "wb").close()
    assert {tuple(r) for r in list_partitions(spark, root, "hot").collect()} == {("hot", "2024-01-01"), ("hot", "2024-07-01")}


def test_contract_casts(spark):
    from harvestframe.operators import contracts as V
    df = spark.createDataFrame([("2024-01-01", "1.5")], "date string, close string")
    out = V.validate(df, [V.not_null("date"), V.gt("close", 0)], "silver", ["date", "close"], V.SILVER_TYPES)
    assert dict(out.dtypes) == {"date": "date", "close": "double"}


def test_one_contract_error():
    from harvestframe.operators import contracts
    from harvestframe.plans import silver
    assert contracts.DataContractError is silver.DataContractError


def test_landed_readers(spark, tmp_path):
    """Files as they land, read with explicit schemas and joined by name."""
    from harvestframe.sources import landed as L
    spark.createDataFrame([("2024-01-01", "TMAX", 80.5, ",,N", "ST1")], "date string, datatype string, value double, attributes string, station string") \
        .write.json(str(tmp_path / "w"))
    w = L.read_weather(spark, str(tmp_path / "w"))
    assert [tuple(r) for r in w.collect()] == [("2024-01-01", "TMAX", 80.5, ",,N", "ST1")]
    (tmp_path / "b.csv").write_text(" Datetime ,Open,High,Low,Close,Volume\n2024-01-02,1,2,0.5,1.5,10\n")
    b = L.read_bars(spark, str(tmp_path / "b.csv"), "csv")
    assert b.columns == ["date", "open", "high", "low", "close", "volume"] and b.first().close == "1.5"
    both = L.read_sources([w, None, b])
    assert both.count() == 2 and {"station", "close"} <= set(both.columns)
    with pytest.raises(FileNotFoundError):
        L.read_sources([None])


def gapped_series(n=2500):
    rng = np.random.default_rng(11)
    frames = []
    for s, rows, missing in (("a", n, 0.4), ("b", n, 0.02), ("c", 30, 0.9), ("d", 1, 0.0), ("e", 5, 1.0)):
        x = 100 + np.cumsum(rng.normal(0, 1, rows))
        x[rng.random(rows) < missing] = np.nan
        y = x.copy()
        y[:rows // 3] = np.nan                    # starts late
        y[rows // 2: rows // 2 + rows // 4] = np.nan  # a gap longer than any average remembers
        frames.append(pd.DataFrame({"symbol": s, "date": np.arange(rows), "x": x, "y": y}))
    return pd.concat(frames)


@pytest.mark.parametrize("chunked", [False, True])
def test_ema_over_gaps_matches_pandas(spark, monkeypatch, chunked):
    from harvestframe.operators import ema
    monkeypatch.setattr(ema, "SEGMENT", 400)  # the long gap covers whole segments
    pdf = gapped_series()
    specs = [ema.EmaSpec(f"{c}{i}", c, a) for c in "xy" for i, a in enumerate((1 / 3, 2 / 61, 0.9))]
    df = spark.createDataFrame(pdf).withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in "xy"})
    out = ema.ema_over_gaps_by_blocks(df, specs, ["symbol"], "date") if chunked else ema.ema_over_gaps(df, specs)
    assert out.columns[:4] == ["symbol", "date", "x", "y"] and len(out.columns) == 10
    out = out.toPandas().sort_values(["symbol", "date"])
    for s, g in pdf.groupby("symbol"):
        o = out[out.symbol == s]
        assert len(o) == len(g)
        for sp in specs:
            np.testing.assert_allclose(o[sp.out].astype(float).values, g[sp.src].ewm(alpha=sp.alpha, adjust=False).mean().values, rtol=1e-10)


def test_ema_over_gaps_without_gaps_equals_the_row_blocks(spark):
    from harvestframe.operators.ema import EmaSpec, ema_over_gaps, with_ema
    rng = np.random.default_rng(3)
    df = spark.createDataFrame(pd.DataFrame({"symbol": "a", "date": np.arange(900), "x": rng.normal(0, 5, 900)}))
    specs = [EmaSpec("e", "x", 0.1)]
    one, two = (f(df, specs).orderBy("date").toPandas() for f in (with_ema, ema_over_gaps))
    np.testing.assert_allclose(one["e"], two["e"], rtol=1e-10, atol=1e-12)
    with pytest.raises(ValueError, match="alpha"):
        ema_over_gaps(df, [EmaSpec("e", "x", 1.0)])
