"""Hand-made edge cases (FIXTURES.md): no ANSI errors, pandas-compatible NULLs."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from series import SILVER_ORDER, synthetic_silver


def _gold(spark, pdf):
    from harvestframe.plans.gold import build_gold
    return build_gold(spark.createDataFrame(pdf[SILVER_ORDER])).toPandas().sort_values("date").reset_index(drop=True)


def test_constant_close_gives_nulls_not_errors(spark):
    pdf = synthetic_silver(n=80, seed=3)
    pdf["close"] = 100.0
    pdf["open"] = pdf["high"] = pdf["low"] = 100.0
    pdf["crude_close"] = 50.0
    g = _gold(spark, pdf)
    assert g["bb_pct_b"].isna().all()            # zero band width
    assert g["rsi"].isna().all()                 # zero losses -> RS undefined
    assert g["corn_crude_corr_20d"].isna().all()  # constant legs -> correlation undefined
    assert (g["atr"].dropna() == 0).all()
    assert g["parkinson_vol"].dropna().eq(0).all()


def test_negative_correlated_price_and_zero_volume(spark):
    pdf = synthetic_silver(n=60, seed=4)
    pdf.loc[30:35, "crude_close"] = -5.0
    pdf["volume"] = 0.0
    g = _gold(spark, pdf)
    assert g["volume_ratio_20"].isna().all()     # mean volume 0 -> NULL, not inf
    assert g["obv"].eq(0).all()


def test_iso_week_and_leap_day(spark):
    dates = [dt.date(2020, 12, 31), dt.date(2021, 1, 1), dt.date(2019, 12, 30), dt.date(2024, 12, 31)]
    pdf = synthetic_silver(n=len(dates), seed=1)
    pdf["date"] = dates
    pdf["day_of_week"] = [d.weekday() for d in dates]
    pdf["month"] = [d.month for d in dates]
    g = _gold(spark, pdf).set_index("date")
    wk = {d: pd.Timestamp(d).isocalendar().week for d in dates}
    for d in dates:
        assert np.isclose(g.loc[d, "week_sin"], np.sin(2 * np.pi * wk[d] / 52))
    assert wk[dt.date(2020, 12, 31)] == 53 and wk[dt.date(2019, 12, 30)] == 1
    assert np.isclose(g.loc[dt.date(2024, 12, 31), "doy_sin"], np.sin(2 * np.pi * 366 / 365))


def test_series_shorter_than_windows(spark):
    g = _gold(spark, synthetic_silver(n=8, seed=9))
    assert len(g) == 8
    assert g["sma_20"].isna().all() and g["rvol_60d"].isna().all() and g["prcp_zscore"].isna().all()
    assert g["ema_60"].notna().all() and g["target"].iloc[:3].notna().all() and g["target"].iloc[3:].isna().all()


def test_missing_datatype_for_a_station(spark):
    from harvestframe.plans.silver import clean_weather
    rows = [("2024-01-01", "a", "TMAX", 80.0), ("2024-01-01", "a", "TMIN", 60.0),
            ("2024-01-01", "b", "TMAX", 90.0), ("2024-01-01", "b", "PRCP", None)]
    w = spark.createDataFrame(rows, "date string, region string, datatype string, value double")
    r = clean_weather(w).collect()[0]
    assert r.tmax_f == 85.0 and r.tmin_f == 60.0 and r.prcp_in is None and r.snow_mm is None


def _bars(closes, **more):
    days = pd.bdate_range("2023-12-18", periods=len(closes)).date
    return pd.DataFrame({"symbol": "corn", "date": days, "open": 10.0, "high": 12.0, "low": 9.0, "close": closes, "volume": 5000.0, **more})


def test_null_close_same_returns_chunked_or_not(spark):
    """The forward fill of pct_change, also across a time bucket (the turn of the year)."""
    from dataclasses import replace
    from harvestframe.config import Config
    from harvestframe.plans.silver import clean_futures
    closes = [None, 10.0, 11.0, None, None, 12.0, 13.0, None, None, None, None, 14.0, 15.0, None, 16.0]
    raw = spark.createDataFrame(_bars(closes))
    one, cut = (clean_futures(raw, replace(Config(), series_chunk_rows=c)).toPandas().sort_values("date").reset_index(drop=True) for c in (None, 4))
    pd.testing.assert_frame_equal(one, cut)
    want = pd.Series(closes, dtype=float).ffill().pct_change()
    np.testing.assert_allclose(one["returns_1d"], want, equal_nan=True)


def test_repeated_day_counts_once_by_ingest_or_fails(spark):
    from harvestframe.plans.silver import build_silver
    first, later = _bars([10.0, 11.0], _ingest_date="2024-01-01"), _bars([20.0, 21.0], _ingest_date="2024-01-02")
    weather = spark.createDataFrame([("2023-12-18", "a", "TMAX", None, "2024-01-01"), ("2023-12-18", "a", "TMAX", 70.0, "2024-01-02"),
                                     ("2023-12-18", "a", "TMAX", 60.0, "2024-01-03"), ("2023-12-18", "a", "TMIN", 50.0, "2024-01-01")],
                                    "date string, region string, datatype string, value double, _ingest_date string")
    s = build_silver(spark.createDataFrame(pd.concat([later, first])), weather).orderBy("date").collect()
    assert [r.close for r in s] == [10.0, 11.0] and s[0].tmax_f == 70.0 and s[0].tmin_f == 50.0
    with pytest.raises(Exception, match="repeated key"):
        build_silver(spark.createDataFrame(pd.concat([first, first]).drop(columns="_ingest_date")), weather).collect()


def test_presence_branches(spark):
    from harvestframe.plans.gold import build_gold
    whole = build_gold(spark.createDataFrame(synthetic_silver(n=90, seed=2)[SILVER_ORDER])).orderBy("date").toPandas()
    for absent, gone in ((["tmax_f", "tmin_f", "prcp_in", "snow_mm"], {"gdd_daily", "prcp_zscore", "tmax_7d_avg", "heat_stress_7d"}),
                         (["prcp_in"], {"prcp_zscore", "prcp_sum_10d"}), (["wheat_close"], {"corn_wheat_ratio", "corn_wheat_spread"}),
                         (["crude_close"], {"corn_crude_corr_20d"}), (["usd_close"], {"usd_return_5d", "corn_usd_corr_20d"}),
                         (["wheat_close", "crude_close", "usd_close"], {"corn_wheat_ratio", "corn_usd_corr_20d"})):
        g = build_gold(spark.createDataFrame(synthetic_silver(n=90, seed=2)[SILVER_ORDER].drop(columns=absent))).orderBy("date").toPandas()
        assert not (gone | set(absent)) & set(g.columns)
        pd.testing.assert_frame_equal(g, whole[list(g.columns)])


def test_ema_with_a_gap_is_an_error(spark):
    from harvestframe.operators.ema import EmaSpec, with_ema
    rows = [("a", i, x) for i, x in enumerate([None, 1.0, 2.0, None, 5.0])]
    df = spark.createDataFrame(rows, "symbol string, date int, x double")
    with pytest.raises(Exception, match="NULL after the first value"):
        with_ema(df, [EmaSpec("e", "x", 0.5)]).collect()
    head = with_ema(df.where("date < 3"), [EmaSpec("e", "x", 0.5)]).orderBy("date").collect()
    assert [r.e for r in head] == [None, 1.0, 1.5]
