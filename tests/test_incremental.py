import dataclasses
import datetime as dt

import numpy as np
import pandas as pd
import pytest

from harvestframe.config import Config, FeatureConfig
from harvestframe.plans import incremental as I
from harvestframe.plans.gold import build_gold
from harvestframe.plans.silver import build_silver
from harvestframe.sources.bronze import list_partitions

# Short averages, so that a rebuild looks back about two years instead of five.
CFG = Config(correlated=(("wheat", "w"),), features=FeatureConfig(rolling_windows=(5, 10), macd_slow=15, rsi_period=6, long_window=100, rvol_windows=(5, 20)))
START = dt.date(2012, 1, 1)


@pytest.fixture(scope="module")
def inputs():
    rng = np.random.default_rng(11)
    days = pd.bdate_range("2012-01-02", "2019-06-28")
    bars = []
    for symbol in ("c", "w"):
        close = 50 * np.exp(np.cumsum(rng.normal(0, 0.01, len(days))))
        bars.append(pd.DataFrame({"symbol": symbol, "date": days.date, "open": close * 0.999, "high": close * 1.01, "low": close * 0.99,
                                  "close": close, "volume": rng.integers(1500, 9000, len(days)).astype(float)}))
    every = pd.date_range("2012-01-01", "2019-06-30")
    weather = pd.concat([pd.DataFrame({"date": every.strftime("%Y-%m-%d"), "region": region, "datatype": kind, "value": rng.uniform(0, 90, len(every))})
                         for region in ("a", "b") for kind in ("TMAX", "TMIN", "PRCP", "SNOW")])
    return pd.concat(bars), weather


def frames(spark, inputs, until):
    bars, weather = inputs
    return (spark.createDataFrame(bars[bars.date <= until]).repartition(4),
            spark.createDataFrame(weather[weather.date <= str(until)]).repartition(4))


def same(a, b):
    a, b = (x.toPandas().sort_values(["symbol", "date"]).reset_index(drop=True)[sorted(a.columns)] for x in (a, b))
    pd.testing.assert_frame_equal(a, b, check_dtype=False, rtol=1e-9, atol=1e-9)


def full(spark, bars, weather):
    silver = build_silver(bars, weather, CFG)
    return silver, build_gold(silver, CFG)


def test_two_runs_equal_one_build(spark, inputs, tmp_path):
    root = str(tmp_path / "r")
    early, late = dt.date(2019, 3, 1), dt.date(2019, 6, 28)
    first = I.daily_build(spark, *frames(spark, inputs, early), root, CFG, early, START).collect()
    assert {(r.symbol, r.silver_year, r.read_year) for r in first} == {("c", 2012, 2012), ("w", 2012, 2012)}
    kept = {str(f): f.stat().st_mtime_ns for layer in ("bars", "silver", "gold") for y in range(2012, 2018) for f in (tmp_path / "r" / layer).glob(f"symbol=*/year={y}/*.parquet")}
    again = I.daily_build(spark, *frames(spark, inputs, late), root, CFG, late, START).collect()
    # three months of new rows: this year of silver, the year before for the targets, and as many as the averages need
    assert {(r.symbol, r.silver_year, r.gold_year) for r in again} == {("c", 2019, 2018), ("w", 2019, 2018)}
    assert {r.read_year for r in again} <= {2016, 2017}
    assert all((tmp_path / f).stat().st_mtime_ns == at for f, at in kept.items())
    silver, gold = full(spark, *frames(spark, inputs, late))
    same(I.read_layer(spark, root, "silver"), silver)
    same(I.read_layer(spark, root, "gold"), gold)
    landed = [(r.source, r.ingest_date) for r in list_partitions(spark, f"{root}/bronze_futures").collect()]
    assert sorted(landed) == [(s, str(d)) for s in ("c", "w") for d in (early, late)]

    # nothing new: not a file changes; forced: all is landed again, and nothing differs
    files = lambda: {str(f): f.stat().st_mtime_ns for layer in ("silver", "gold") for f in (tmp_path / "r" / layer).rglob("*.parquet")}
    before = files()
    assert I.daily_build(spark, *frames(spark, inputs, late), root, CFG, late, START).count() == 0 and files() == before
    assert I.daily_build(spark, *frames(spark, inputs, late), root, CFG, late, START, force_refresh=True).count() == 0 and files() == before

    # an observation of the open half-year is corrected; one of a closed one only when forced
    bars, weather = frames(spark, inputs, late)
    pdf = weather.toPandas()
    pdf.loc[(pdf.date == "2019-05-15") & (pdf.datatype == "TMAX"), "value"] += 20
    pdf.loc[(pdf.date == "2013-05-15") & (pdf.datatype == "TMAX"), "value"] += 20
    ranges = I.daily_build(spark, bars, spark.createDataFrame(pdf), root, CFG, late, START).collect()
    assert {r.silver_year for r in ranges} == {2019}
    assert {r.silver_year for r in I.daily_build(spark, bars, spark.createDataFrame(pdf), root, CFG, late, START, force_refresh=True).collect()} == {2013}
    same(I.read_layer(spark, root, "gold"), full(spark, bars, spark.createDataFrame(pdf))[1])


def test_restated_bars(spark, inputs, tmp_path):
    """Kept first, a restated price changes nothing; kept last, it rebuilds from its year on."""
    bars, weather = inputs
    bars, weather = bars[bars.date < dt.date(2014, 1, 1)], weather[weather.date < "2014-01-01"]
    restated = bars.copy()
    restated.loc[(restated.symbol == "c") & (restated.date == dt.date(2013, 6, 3)), "high"] *= 1.5
    one, two = dt.date(2013, 12, 31), dt.date(2014, 1, 10)
    for keep, want in (("first", 0), ("last", 1)):
        cfg = dataclasses.replace(CFG, transforms=dataclasses.replace(CFG.transforms, dedupe_keep=keep))
        root = str(tmp_path / keep)
        I.daily_build(spark, spark.createDataFrame(bars), spark.createDataFrame(weather), root, cfg, one, START)
        ranges = I.daily_build(spark, spark.createDataFrame(restated), spark.createDataFrame(weather), root, cfg, two, START).collect()
        assert len(ranges) == want and all((r.symbol, r.silver_year) == ("c", 2013) for r in ranges)
        seen = spark.createDataFrame(restated if want else bars)
        same(I.read_layer(spark, root, "gold"), full(spark, seen, spark.createDataFrame(weather))[1])
