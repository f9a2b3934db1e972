"""F32 silver build: clean futures + weather + correlated closes, joined on a (symbol, date) spine.

Plan shape: futures and weather are aggregated first (partial aggregation
before any shuffle), the weather table is reduced to one row per date, the
as-of mapping is computed per distinct date, and the spine gets two date
equi-joins against date-sized tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestframe.config import Config
from harvestframe.functions.calendar import silver_calendar
from harvestframe.functions.numeric import div, ln_pos, nan_to_null
from harvestframe.operators.asof import asof_join
from harvestframe.operators.chunking import fill_forward, neighbour, series_positions
from harvestframe.operators.contracts import DataContractError
from harvestframe.operators.reshape import dedupe_keep, pivot_first_non_null, pivot_labels, require_unique
from harvestframe.operators.windows import lag, pad, pct_change_of_padded

# The output columns of the layer.
FUTURES_COLS = ["date", "open", "high", "low", "close", "volume", "returns_1d", "log_return_1d", "high_low_pct"]
WEATHER_COLS = ["tmax_f", "tmin_f", "prcp_in", "snow_mm"]
REQUIRED_OHLCV = ("date", "open", "high", "low", "close", "volume")


def normalise_columns(df: DataFrame) -> DataFrame:
    """Lower-case/strip names; ``date`` or ``datetime`` becomes ``date``."""
    df = df.toDF(*[c.lower().strip() for c in df.columns])
    if "date" not in df.columns and "datetime" in df.columns:
        df = df.withColumnRenamed("datetime", "date")
    return df


def require_columns(df: DataFrame, cols: Sequence[str], what: str = "futures") -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise DataContractError(f"{what} data missing columns {missing}")


# Audit columns that bronze adds; they order repeated ingests of a day.
INGEST_ORDER = ("_ingest_date", "_ingest_ts")


def ingest_columns(df: DataFrame, order: Sequence[str] | None) -> list[str]:
    """The columns that order ingests: those given, or the audit columns that the frame has."""
    return list(order) if order else [c for c in INGEST_ORDER if c in df.columns]


def one_per_day(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None, keep: str) -> DataFrame:
    """T4: the first (or last) ingest of a key; without an ingest order a repeated key is an error."""
    cols = ingest_columns(df, order)
    return dedupe_keep(df, keys, cols, keep) if cols else require_unique(df, keys)


def clean_futures(raw: DataFrame, cfg: Config = Config(), label: str | None = None,
                  ingest_order: Sequence[str] | None = None, symbol_col: str = "symbol") -> DataFrame:
    """P1-P3, T4, F16, P5, P6 for every series at once."""
    df = normalise_columns(raw)
    if label is not None and "label" in df.columns:                      # P2
        df = df.where(F.col("label") == label)
    require_columns(df, REQUIRED_OHLCV)
    if symbol_col not in df.columns:
        df = df.withColumn(symbol_col, F.lit(label or "default"))
    df = df.withColumn("date", F.to_date("date"))                         # P1
    df = df.withColumns({c: nan_to_null(F.col(c).cast("double")) for c in ("open", "high", "low", "close", "volume")})
    df = one_per_day(df, [symbol_col, "date"], ingest_order, cfg.transforms.dedupe_keep)   # T4
    df = df.where(F.col("volume") >= F.lit(float(cfg.transforms.min_daily_volume)))  # P3, before returns
    if cfg.series_chunk_rows:
        # hot-series plan: the forward fill by buckets, the previous row by a positional equi-join
        df = fill_forward(df, [symbol_col], "date", {"close": "__close_pad"})
        df = neighbour(series_positions(df, [symbol_col], "date"), [symbol_col], ["close", "__close_pad"], -1)
        prev = F.col("close_lag1")
        returns = div(F.col("__close_pad"), F.col("__close_pad_lag1")) - F.lit(1.0)
    else:
        df = df.withColumn("__close_pad", pad("close", keys=(symbol_col,)))
        prev = lag("close", 1, keys=(symbol_col,))
        returns = pct_change_of_padded("__close_pad", 1, keys=(symbol_col,))
    df = df.withColumns({                                                 # F16
        "returns_1d": returns,
        "log_return_1d": ln_pos(div(F.col("close"), prev)),
        "high_low_pct": div(F.col("high") - F.col("low"), F.col("close")),   # P5
    })
    return df.select(symbol_col, *FUTURES_COLS)                            # P6


def clean_weather(raw: DataFrame, cfg: Config = Config(), ingest_order: Sequence[str] | None = None) -> DataFrame:
    """A1 pivot, P4 units, A2 station mean: date, tmax_f, tmin_f, prcp_in, snow_mm."""
    df = raw.withColumn("date", F.to_date("date"))
    order = ingest_columns(df, ingest_order)
    wide = pivot_first_non_null(df, ["date", "region"], "datatype", cfg.weather_datatypes, "value", order)
    wide = wide.select("date", "region",
                       F.col("TMAX").alias("tmax_f"), F.col("TMIN").alias("tmin_f"),
                       F.col("PRCP").alias("prcp_in"),
                       (F.col("SNOW") * F.lit(cfg.transforms.snow_in_to_mm)).alias("snow_mm"))
    return wide.groupBy("date").agg(*[F.avg(c).alias(c) for c in WEATHER_COLS])


def correlated_closes(raw_bars: DataFrame, cfg: Config = Config(), ingest_order: Sequence[str] | None = None,
                      symbol_col: str = "symbol", prefilter: bool = True) -> DataFrame:
    """Date, wheat_close, crude_close, usd_close (one pivot instead of outer joins)."""
    df = normalise_columns(raw_bars).withColumn("date", F.to_date("date"))
    if prefilter:
        df = df.where(F.col(symbol_col).isin([s for _, s in cfg.correlated]))
    if ingest_columns(df, ingest_order):  # otherwise the spine has found the keys unique
        df = dedupe_keep(df, [symbol_col, "date"], ingest_columns(df, ingest_order), cfg.transforms.dedupe_keep)
    return pivot_labels(df, cfg.correlated, "close", symbol_col, prefilter=prefilter)


def build_silver(bars: DataFrame, weather_long: DataFrame | None, cfg: Config = Config(),
                 ingest_order: Sequence[str] | None = None) -> DataFrame:
    """F32: symbol, date, OHLCV, returns, weather, correlated closes, calendar.

    Of repeated ingests the first counts, by ``ingest_order`` or the audit columns of bronze.
    Without weather the weather columns are absent (P9), and gold leaves out what needs them.
    """
    spine_src = bars
    if cfg.spine_symbols:
        spine_src = bars.where(F.col("symbol").isin(list(cfg.spine_symbols)))
    futures = clean_futures(spine_src, cfg, ingest_order=ingest_order)
    t = cfg.transforms
    silver, weather_cols = futures, []
    if weather_long is not None:
        order = [c for c in ingest_columns(weather_long, ingest_order) if c in weather_long.columns]
        weather, weather_cols = clean_weather(weather_long, cfg, order), WEATHER_COLS
        silver = asof_join(futures, weather, t.asof_tolerance_days, t.asof_direction)   # J1
    if cfg.correlated:
        silver = silver.join(correlated_closes(bars, cfg, ingest_order, prefilter=False), "date", "left")   # J3
    silver = silver.withColumns(silver_calendar("date"))                              # F26
    return silver.select("symbol", *FUTURES_COLS, *weather_cols,
                         *[f"{lab}_close" for lab, _ in cfg.correlated], "day_of_week", "month")
