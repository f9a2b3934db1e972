"""Views over the driver's TPC-H-like tables that stand in for the reference's inputs.

* ``bars``         daily OHLCV per symbol (orders x customer, symbol = market segment)
* ``weather_long`` long daily observations per station (lineitem x supplier x nation x region)
* ``stations``     station dimension (region table)
* ``hourly_bars``  hourly OHLCV per event type (events)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, date, open, high, low, close, volume.

    open/close are the prices of the first/last order key of the day, so they
    are deterministic; ``min_by``/``max_by`` aggregate partially before the shuffle,
    so a hot segment-day costs one partial row per input partition.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return (j.groupBy(F.col("c_mktsegment").alias("symbol"), F.to_date("o_orderdate").alias("date"))
             .agg(F.min_by("o_totalprice", "o_orderkey").alias("open"),
                  F.max("o_totalprice").alias("high"),
                  F.min("o_totalprice").alias("low"),
                  F.max_by("o_totalprice", "o_orderkey").alias("close"),
                  (F.count(F.lit(1)) * F.lit(1000.0)).alias("volume")))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """region, station_id: one synthetic station per region."""
    r = table(spark, sf_dir, "region")
    return r.select(F.col("r_name").alias("region"),
                    F.format_string("ST%05d", F.col("r_regionkey")).alias("station_id"))


def weather_wide_by_station(spark: SparkSession, sf_dir: str, gap: tuple[int, int] | None = None) -> DataFrame:
    """``gap`` leaves out days of the month, for queries about days without observations."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", "l_discount", "l_tax", "l_shipdate")
    if gap:
        li = li.where(~F.dayofmonth("l_shipdate").between(*gap))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    sup_region = (s.join(n, s.s_nationkey == n.n_nationkey)
                   .join(r, F.col("n_regionkey") == r.r_regionkey)
                   .select("s_suppkey", "r_name"))
    j = li.join(sup_region, li.l_suppkey == sup_region.s_suppkey)
    return (j.groupBy(F.to_date("l_shipdate").alias("date"), F.col("r_name").alias("region"))
             .agg((F.lit(50.0) + F.max("l_quantity")).alias("TMAX"),
                  (F.lit(30.0) + F.min("l_quantity")).alias("TMIN"),
                  F.sum("l_discount").alias("PRCP"),
                  F.sum("l_tax").alias("SNOW")))


def weather_long(spark: SparkSession, sf_dir: str, gap: tuple[int, int] | None = None) -> DataFrame:
    """date (string, as landed), region, datatype, value."""
    w = weather_wide_by_station(spark, sf_dir, gap)
    long = w.unpivot(["date", "region"], ["TMAX", "TMIN", "PRCP", "SNOW"], "datatype", "value")
    return long.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "region", "datatype", "value")


def hourly_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol (event type), ts (hour), open, high, low, close, volume."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    return (e.groupBy(F.col("event_type").alias("symbol"), F.date_trunc("hour", "ts").alias("ts"))
             .agg(F.min_by("value", F.struct("ts", "event_id")).alias("open"),
                  F.max("value").alias("high"),
                  F.min("value").alias("low"),
                  F.max_by("value", F.struct("ts", "event_id")).alias("close"),
                  F.count(F.lit(1)).cast("double").alias("volume")))
