"""Read landed observations and price bars, tag lineage, read many sources at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harvestframe.operators.reshape import union_all

WEATHER_SCHEMA = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("datatype", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("attributes", T.StringType()),
    T.StructField("station", T.StringType()),
])


def read_weather(spark: SparkSession, path: str, fmt: str = "json", schema: T.StructType = WEATHER_SCHEMA) -> DataFrame:
    """Landed long-format observations with an explicit schema (no inference pass)."""
    r = spark.read.schema(schema)
    return r.parquet(path) if fmt == "parquet" else (r.option("header", True).csv(path) if fmt == "csv" else r.json(path))


def read_bars(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed OHLCV; names normalised and required columns checked by ``plans.silver``."""
    from harvestframe.plans.silver import REQUIRED_OHLCV, normalise_columns, require_columns
    r = spark.read
    df = r.parquet(path) if fmt == "parquet" else r.option("header", True).option("inferSchema", False).csv(path)
    df = normalise_columns(df)
    require_columns(df, REQUIRED_OHLCV)
    return df


def tag_weather(df: DataFrame, stations: DataFrame) -> DataFrame:
    """S3: station_id, region, year via a join with the station dimension."""
    st = stations.select("region", "station_id")
    return (df.join(st, "region", "left")
              .withColumn("year", F.year(F.to_date("date"))))


def tag_bars(df: DataFrame, instruments: DataFrame) -> DataFrame:
    """S3: ticker, label via the instrument dimension (symbol -> ticker, label)."""
    return df.join(instruments, "symbol", "left")


def read_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """S7 for separately landed roots: union by name, missing columns as NULL."""
    frames = [f for f in frames if f is not None]
    if not frames:
        raise FileNotFoundError("no source found")
    return union_all(frames)
