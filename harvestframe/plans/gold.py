"""F31 gold build: 80 features + target over every series, and P8 feature selection.

Stage order (all windows share ``partitionBy(symbol)``, so one shuffle):
(a) lags/pads, (b) EMA pass 1 (closes and RSI gains/losses), (c) MACD + EMA pass 2
(signal line), (d) price, technical, volatility, weather, calendar, cross-asset, target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from harvestframe.config import Config
from harvestframe.functions import calendar, cross, price, technical, target, volatility, weather
from harvestframe.functions.numeric import clip_lower, clip_upper
from harvestframe.operators.chunking import CHUNK, HOME, POS, fill_forward, neighbour, running_sum_with_carry, with_halo, with_positions
from harvestframe.operators.ema import EmaSpec, alpha_from_com, alpha_from_span, ema_by_blocks, ema_over_gaps, ema_over_gaps_by_blocks, shared_block, with_ema
from harvestframe.operators.windows import lag, pad, row_index
from harvestframe.session import written

# The layer's column names and the columns that are no features.
SILVER_PASSTHROUGH = ["returns_1d", "log_return_1d", "high_low_pct", "tmax_f", "tmin_f", "prcp_in",
                      "snow_mm", "wheat_close", "crude_close", "usd_close", "day_of_week", "month"]
EXCLUDE = {"date", "target", "target_horizon", "open", "high", "low", "close", "volume", "symbol"}


def feature_names(cfg: Config = Config()) -> list[str]:
    f = cfg.features
    return (SILVER_PASSTHROUGH + price.names(f) + technical.names(f) + volatility.names(f)
            + weather.names(f) + calendar.names(f) + cross.names(f))


def gold_columns(cfg: Config = Config()) -> list[str]:
    silver = ["symbol", "date", "open", "high", "low", "close", "volume"] + SILVER_PASSTHROUGH[:3] + \
        ["tmax_f", "tmin_f", "prcp_in", "snow_mm", "wheat_close", "crude_close", "usd_close", "day_of_week", "month"]
    feats = [c for c in feature_names(cfg) if c not in SILVER_PASSTHROUGH]
    return silver + feats + ["target", "target_horizon"]


def present_columns(df: DataFrame, cfg: Config = Config()) -> list[str]:
    """The gold columns that a frame with features has, in order (P9: those of absent sources are left out)."""
    return [c for c in gold_columns(cfg) if c in df.columns]


def feature_columns(df: DataFrame) -> list[str]:
    """Numeric columns minus the exclusion set, in frame order."""
    return [f.name for f in df.schema.fields
            if f.name not in EXCLUDE and isinstance(f.dataType, NumericType)]


def _features(df: DataFrame, cfg: Config, keys=("symbol",)) -> DataFrame:
    """Stages (a)-(h) on a frame whose series windows are ``partitionBy(*keys)``.

    The row index and the EMA block number are computed once; every window is then
    ordered by ``(block, row)`` - the same order as by date - so the whole chain
    shares a single sort (plus one for the per-season GDD partition)."""
    f = cfg.features
    all_specs = ema_specs(cfg) + [signal_spec(cfg)]
    block = shared_block(all_specs)
    ema_kw: dict = {}
    order: str | tuple = "date"
    if block:
        df = df.withColumn("__rn", row_index(keys, "date"))
        df = df.withColumn("__blk", F.floor(F.col("__rn") / F.lit(block)))
        order = ("__blk", "__rn")
        ema_kw = {"rn": "__rn", "blk": "__blk", "block": block}
    if "__close_pad" not in df.columns:  # a chunked build brings what reaches beyond a chunk's halo
        df = df.withColumns({
            "__close_pad": pad("close", keys=keys, order=order),
            "__close_lag1": lag("close", keys=keys, order=order),
        })
        df = add_changes(df)
        gaps = f.ema_gaps
        df = ema_over_gaps(df, ema_specs(cfg), keys) if gaps else with_ema(df, ema_specs(cfg), keys=keys, order="date", **ema_kw)  # (b)
        df = technical.add_macd(df, f)
        df = ema_over_gaps(df, [signal_spec(cfg)], keys) if gaps else with_ema(df, [signal_spec(cfg)], keys=keys, order="date", **ema_kw)  # (c)
    df = price.add(df, f, keys, order)
    df = technical.add(df, f, keys, order)
    df = volatility.add(df, f, keys, order)
    df = weather.add(df, f, keys, order, defer_cumulative=True, block=block)
    df = calendar.add(df, f)
    df = cross.add(df, f, keys, order)
    df = target.add(df, f, keys, order)
    return weather.add_cumulative(df, f, keys, order)


def add_changes(df: DataFrame) -> DataFrame:
    df = df.withColumn("__delta", F.col("close") - F.col("__close_lag1"))
    return df.withColumns({"__gain": clip_lower("__delta", 0.0), "__loss": -clip_upper("__delta", 0.0)})


def signal_spec(cfg: Config = Config()) -> EmaSpec:
    return EmaSpec("macd_signal_line", "macd", alpha_from_span(cfg.features.macd_signal))


def ema_specs(cfg: Config = Config()) -> list[EmaSpec]:
    f = cfg.features
    spans = sorted(set(f.rolling_windows) | {f.macd_fast, f.macd_slow})
    specs = [EmaSpec(f"__ema_close_{s}", "close", alpha_from_span(s)) for s in spans]
    return specs + [EmaSpec("__rsi_up", "__gain", alpha_from_com(f.rsi_period - 1)),
                    EmaSpec("__rsi_dn", "__loss", alpha_from_com(f.rsi_period - 1))]


def lookback_rows(cfg: Config = Config()) -> int:
    """Rows of history a chunk needs: the longest chain of rolling windows.  What reaches further
    (EMAs, running sums, forward fills) is carried, not recomputed."""
    f = cfg.features
    return max(f.long_window, 1 + 20 + 60, 1 + f.corr_window, max(f.rolling_windows) + 1)


def build_gold(silver: DataFrame, cfg: Config = Config(), chunk_rows: int | None = None,
               bucket: str = "year") -> DataFrame:
    """F31.  ``chunk_rows`` splits each series into chunks of that many rows (with halos),
    so a series holding a large share of all rows is spread over many tasks; results
    are the same as the one-partition-per-series plan.  Chunks shorter than the halo would copy
    each row several times and are refused."""
    chunk_rows = chunk_rows or cfg.series_chunk_rows
    if not chunk_rows:
        g = _features(silver, cfg)
        return g.select(*present_columns(g, cfg))
    if chunk_rows < lookback_rows(cfg):
        raise ValueError(f"chunk_rows={chunk_rows} is shorter than the halo of {lookback_rows(cfg)} rows")
    keys = ("symbol",)
    f = cfg.features
    # phase A: what spans the series, without a whole-series window; written in steps, as each step
    # joins a frame with its own sums
    fills = {"close": "__close_pad", "usd_close": "__usd_pad"}
    a = fill_forward(silver, keys, "date", {c: out for c, out in fills.items() if c in silver.columns}, bucket)
    a = written(with_positions(a, keys, "date", F.date_trunc(bucket, F.col("date"))), "gold-positions")
    a = add_changes(neighbour(a, keys, ["close"], -1, pos=POS, suffix="__prev").withColumnRenamed("close__prev", "__close_lag1"))
    average = ema_over_gaps_by_blocks if f.ema_gaps else ema_by_blocks
    a = written(technical.add_macd(average(a, ema_specs(cfg), keys, POS), f), "gold-averages")
    a = average(a, [signal_spec(cfg)], keys, POS)
    a = a.withColumns({
        CHUNK: F.floor(F.col(POS) / F.lit(chunk_rows)),
        "__obv_term": F.coalesce(F.signum("__delta") * F.col("volume"), F.lit(0.0)),
    })
    a = running_sum_with_carry(a, "__obv_term", "__obv", keys, "date")
    if "tmax_f" in silver.columns:
        a = a.withColumns({
            "__gdd": clip_lower((F.col("tmax_f") + F.col("tmin_f")) / F.lit(2.0) - F.lit(float(f.gdd_base_temp_f)), 0.0),
            "__season": weather.season_year("date", f.season_start_month)})
        a = running_sum_with_carry(a, "__gdd", "__gdd_cum", (*keys, "__season"), "date", keep_null=True)
    a = written(a.drop("__obv_term", "__gdd", "__season", CHUNK), "gold-series")
    # phase B: the halo, the feature chain on (symbol, chunk), home rows kept
    b = with_halo(a, chunk_rows, back=lookback_rows(cfg), ahead=f.target_horizon_days)
    g = _features(b, cfg, keys=(*keys, CHUNK))
    return g.where(F.col(HOME)).select(*present_columns(g, cfg))


def market_features(cfg: Config = Config()) -> list[str]:
    """Features that depend only on the series' own bars and the calendar (no joined legs).

    The weather and cross-asset families are NULL wherever the other source has
    gaps; a model over complete rows of all 80 features can be empty on such data,
    so the registered model queries use this set (``feature_cols`` is a parameter)."""
    f = cfg.features
    return (["returns_1d", "log_return_1d", "high_low_pct", "day_of_week", "month"] + price.names(f)
            + technical.names(f) + volatility.names(f) + calendar.names(f))
