"""Registered queries: views, silver, gold and the feature operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from harvestframe.checks import sql as S
from harvestframe.plans.gold import build_gold
from harvestframe.plans.silver import build_silver
from harvestframe.registry import CFG, GOLD_COLS, kinds_for, register
from harvestframe.session import scratch_path
from harvestframe.sources import tables as T
from harvestframe.sources.landed import read_bars, read_weather

SILVER_COLS = ["symbol", "date", "open", "high", "low", "close", "volume", "returns_1d", "log_return_1d",
               "high_low_pct", "tmax_f", "tmin_f", "prcp_in", "snow_mm", "wheat_close", "crude_close",
               "usd_close", "day_of_week", "month"]


def landed(spark, sf):
    """The two landed inputs, staged once (reliable checkpoints in the shared folder) the way
    bronze tables are: silver reads each of them twice (spine + correlated closes, weather
    range + values), and each fact table behind them is then scanned exactly once."""
    from harvestframe.session import shared_dir
    shared_dir(spark)
    return T.bars(spark, sf).checkpoint(eager=True), T.weather_long(spark, sf).checkpoint(eager=True)


def silver(spark, sf):
    bars, weather = landed(spark, sf)
    return build_silver(bars, weather, CFG)


def gold(spark, sf):
    return build_gold(silver(spark, sf), CFG)


def gold_table(spark, sf):
    """Gold written once (reliable checkpoint in the shared folder), as the pipeline reads its
    written gold table: operators of several passes then scan it, not rebuild it."""
    return gold(spark, sf).checkpoint(eager=True)


@register("f32_silver_build", S.silver_sql(), "SELECT * FROM silver", kinds_for(SILVER_COLS))
def f32_silver_build(spark, sf):
    """F32: full silver table for every symbol."""
    return silver(spark, sf)


@register("f31_gold_build", S.gold_sql(), f"SELECT {', '.join(GOLD_COLS)} FROM gold", kinds_for(GOLD_COLS))
def f31_gold_build(spark, sf):
    """all 80 features + target over every symbol."""
    return gold(spark, sf)


# ---------------------------------------------------------------- views / sources read
@register("s1_read_weather", S.views_sql(), "SELECT * FROM weather_long",
          kinds_for(["date", "region", "datatype", "value"], dates=(), strs={"date", "region", "datatype"}))
def s1_read_weather(spark, sf):
    """Long-format daily observations, landed as JSON lines and read with an explicit schema."""
    path = scratch_path(spark, "landed-weather")
    T.weather_long(spark, sf).select("date", "datatype", "value", F.lit(",,N").alias("attributes"), F.col("region").alias("station")).write.json(path)
    return read_weather(spark, path).select("date", F.col("station").alias("region"), "datatype", "value")


@register("s2_read_futures", S.views_sql(), "SELECT * FROM bars",
          kinds_for(["symbol", "date", "open", "high", "low", "close", "volume"]))
def s2_read_futures(spark, sf):
    """Daily OHLCV per symbol, landed as CSV with capitalised names; names normalised, columns checked."""
    path = scratch_path(spark, "landed-bars")
    b = T.bars(spark, sf)
    b.toDF(*[c.capitalize() for c in b.columns]).withColumnRenamed("Date", "Datetime").write.option("header", True).csv(path)
    read = read_bars(spark, path, "csv")
    return read.select("symbol", F.to_date("date").alias("date"), *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close", "volume")])


# ---------------------------------------------------------------- F1-F30 projections of gold
FEATURE_QUERIES = {
    "f1_return": [f"return_{w}d" for w in CFG.features.rolling_windows],
    "f2_sma": [f"sma_{w}" for w in CFG.features.rolling_windows],
    "f3_ema": [f"ema_{w}" for w in CFG.features.rolling_windows],
    "f4_price_to_sma": [f"price_to_sma_{w}" for w in CFG.features.rolling_windows],
    "f5_high_low_range": ["high_low_range"],
    "f6_overnight_gap": ["overnight_gap"],
    "f7_volume_ratio": ["volume_ratio_20"],
    "f8_rsi": ["rsi"],
    "f9_macd": ["macd", "macd_signal_line", "macd_hist"],
    "f10_bollinger": ["bb_upper", "bb_lower", "bb_pct_b", "bb_bandwidth"],
    "f11_atr": ["atr", "atr_pct"],
    "f12_obv": ["obv", "obv_sma20", "obv_ratio"],
    "f13_realized_vol": [f"rvol_{w}d" for w in CFG.features.rvol_windows],
    "f14_vol_regime": ["vol_regime"],
    "f15_parkinson_vol": ["parkinson_vol"],
    "f16_returns": ["returns_1d", "log_return_1d"],
    "f17_gdd_daily": ["gdd_daily"],
    "f18_gdd_cumulative": ["gdd_cumulative"],
    "f19_heat_stress": ["heat_stress_flag"] + [f"heat_stress_{w}d" for w in CFG.features.heat_windows],
    "f20_prcp_zscore": ["prcp_zscore"],
    "f21_prcp_sum": [f"prcp_sum_{w}d" for w in CFG.features.prcp_sum_windows],
    "f22_tmax_trend": ["tmax_7d_avg", "tmax_anomaly_30d"],
    "f23_cyclical": ["month_sin", "month_cos", "doy_sin", "doy_cos", "week_sin", "week_cos"],
    "f24_crop_flags": ["is_planting", "is_pollination", "is_harvest", "is_growing_season"],
    "f25_wasde": ["days_to_wasde", "wasde_week", "is_monday"],
    "f26_calendar": ["day_of_week", "month"],
    "f27_wheat_spread": ["corn_wheat_ratio", "corn_wheat_spread"],
    "f28_cross_corr": ["corn_crude_corr_20d", "corn_usd_corr_20d"],
    "f29_usd_return": ["usd_return_5d"],
    "f30_target": ["target", "target_horizon"],
}


def _feature_query(name, cols):
    sel = ["symbol", "date", *cols]

    @register(name, S.gold_sql(), f"SELECT {', '.join(sel)} FROM gold", kinds_for(sel))
    def q(spark, sf):
        return gold(spark, sf).select(*sel)
    q.__doc__ = f"{name.split('_')[0].upper()}: {', '.join(cols)} for every symbol and day."
    return q


for _n, _c in FEATURE_QUERIES.items():
    _feature_query(_n, _c)


@register("f31_gold_build_chunked", S.gold_sql(), f"SELECT {', '.join(GOLD_COLS)} FROM gold", kinds_for(GOLD_COLS))
def f31_gold_build_chunked(spark, sf):
    """F31 with each series split into 400-row chunks plus halos (the hot-series plan):
    same rows and values as the one-task-per-series plan."""
    return build_gold(silver(spark, sf), CFG, chunk_rows=400)


@register("f32_silver_build_chunked", S.silver_sql(), "SELECT * FROM silver", kinds_for(SILVER_COLS))
def f32_silver_build_chunked(spark, sf):
    """F32 with the hot-series plan (positions + positional join for the returns)."""
    from dataclasses import replace
    cfg = replace(CFG, series_chunk_rows=250)
    return build_silver(*landed(spark, sf), cfg)
