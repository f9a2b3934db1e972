"""Registered queries: sources and sinks S3-S14, streaming R1, pipeline L4.

Tables are written under the cluster's shared folder (``spark.checkpoint.dir``),
each run in a fresh sub-folder, and read back.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from harvestframe.checks import sql as S
from harvestframe.queries_core import silver
from harvestframe.queries_quality import QSQL, bronze_weather
from harvestframe.registry import CFG, GOLD_COLS, kinds_for, register
from harvestframe.session import scratch_path
from harvestframe.sources import bronze as B
from harvestframe.sources import planning as PL
from harvestframe.sources import tables as T
from harvestframe.sources.landed import read_sources

# Fixed query parameters: the "today" of the planning queries and a read range.
TODAY = dt.date(1998, 12, 15)
RANGE = ("1996-01-01", "1997-12-31")
LOOKBACK = CFG.monitoring.lookback_years


def half_year_start(d):
    return F.make_date(F.year(d), F.when(F.month(d) <= 6, 1).otherwise(7), F.lit(1))


HALF_SQL = "make_date(year(CAST(date AS DATE)), CASE WHEN month(CAST(date AS DATE)) <= 6 THEN 1 ELSE 7 END, 1)"
BW_SQL = S.views_sql() + f""",
bw AS (SELECT w.*, format('ST{{:05d}}', r.r_regionkey) AS station_id, year(CAST(w.date AS DATE)) AS year
       FROM weather_long w LEFT JOIN region r ON r.r_name = w.region),
lw AS (SELECT 'weather' AS source, strftime({HALF_SQL}, '%Y-%m-%d') AS ingest_date, date, region, datatype, value FROM weather_long)"""


def landed_weather(spark, sf):
    w = T.weather_long(spark, sf)
    return w.withColumns({"source": F.lit("weather"),
                          "ingest_date": F.date_format(half_year_start(F.to_date("date")), "yyyy-MM-dd")})


def bronze_root(spark, sf):
    root = scratch_path(spark, "bronze")
    B.write_bronze(landed_weather(spark, sf), root, ingest_ts=dt.datetime(2024, 1, 1))
    return root


BR_COLS = ["source", "ingest_date", "date", "region", "datatype", "value", "_ingest_date"]
BR_KINDS = kinds_for(BR_COLS, dates=(), strs={"source", "ingest_date", "date", "region", "datatype", "_ingest_date"})


@register("s3_lineage_tags", BW_SQL, "SELECT date, region, datatype, value, station_id, year FROM bw",
          kinds_for(["date", "region", "datatype", "value", "station_id", "year"], ints=("year",), dates=(),
                    strs={"date", "region", "datatype", "station_id"}))
def s3_lineage_tags(spark, sf):
    """S3: station_id, region and year tags via a join with the station dimension."""
    return bronze_weather(spark, sf).select("date", "region", "datatype", "value", "station_id", "year")


@register("s4_write_bronze", BW_SQL, "SELECT *, ingest_date AS _ingest_date FROM lw", BR_KINDS)
def s4_write_bronze(spark, sf):
    """Idempotent (source, ingest_date) partition overwrite; written twice, read back once."""
    root = scratch_path(spark, "bronze")
    lw = landed_weather(spark, sf)
    B.write_bronze(lw, root, ingest_ts=dt.datetime(2024, 1, 1))
    B.write_bronze(lw, root, ingest_ts=dt.datetime(2024, 1, 2))   # same partitions replaced, not appended
    return B.read_bronze(spark, root).select(*[F.col(c).cast("string") if c == "ingest_date" else F.col(c) for c in BR_COLS])


@register("s5_read_bronze_range", BW_SQL,
          f"SELECT *, ingest_date AS _ingest_date FROM lw WHERE ingest_date >= '{RANGE[0]}' AND ingest_date <= '{RANGE[1]}'",
          BR_KINDS)
def s5_read_bronze_range(spark, sf):
    """Partition-pruned read of an inclusive ingest-date range."""
    df = B.read_bronze(spark, bronze_root(spark, sf), "weather", RANGE[0], RANGE[1], require=True)
    return df.select(*[F.col(c).cast("string") if c == "ingest_date" else F.col(c) for c in BR_COLS])


@register("s6_list_partitions", BW_SQL, "SELECT DISTINCT source, ingest_date FROM lw",
          kinds_for(["source", "ingest_date"]))
def s6_list_partitions(spark, sf):
    """The partition keys present."""
    return B.list_partitions(spark, bronze_root(spark, sf), "weather")


@register("s7_read_all_sources", BW_SQL + f""",
lf AS (SELECT 'futures' AS source, strftime({HALF_SQL}, '%Y-%m-%d') AS ingest_date FROM bars)""",
          "SELECT source, count(*) AS rows FROM (SELECT source FROM lw UNION ALL SELECT source FROM lf) GROUP BY source",
          kinds_for(["source", "rows"], ints=("rows",)))
def s7_read_all_sources(spark, sf):
    """Separately landed roots read together by column name; one that was never landed is skipped."""
    roots = [bronze_root(spark, sf), scratch_path(spark, "futures"), scratch_path(spark, "never-landed")]
    fut = T.bars(spark, sf).withColumns({"source": F.lit("futures"),
                                         "ingest_date": F.date_format(half_year_start(F.col("date")), "yyyy-MM-dd")})
    B.write_bronze(fut, roots[1], ingest_ts=dt.datetime(2024, 1, 1))
    frames = [B.read_bronze(spark, r) if B.table_exists(spark, r) else None for r in roots]
    frames = [f if f is None else f.withColumn("date", F.col("date").cast("string")) for f in frames]
    return read_sources(frames).groupBy("source").agg(F.count(F.lit(1)).alias("rows"))


SIL_COLS = ["symbol", "date", "open", "high", "low", "close", "volume", "returns_1d", "log_return_1d",
            "high_low_pct", "tmax_f", "tmin_f", "prcp_in", "snow_mm", "wheat_close", "crude_close",
            "usd_close", "day_of_week", "month"]


@register("s8_table_io", S.silver_sql(), "SELECT * FROM silver", kinds_for(SIL_COLS))
def s8_table_io(spark, sf):
    """Write the silver table (partitioned by symbol), check it exists, read it back."""
    path = B.write_table(silver(spark, sf), scratch_path(spark, "silver"), partition_by="symbol")
    assert B.table_exists(spark, path)
    return B.read_table(spark, path).select(*SIL_COLS)


@register("s9_metadata", S.silver_sql(),
          "SELECT count(*) AS rows, 19 AS n_columns, min(date) AS min_date, max(date) AS max_date FROM silver",
          kinds_for(["rows", "n_columns", "min_date", "max_date"], ints=("rows", "n_columns"), dates=("min_date", "max_date")))
def s9_metadata(spark, sf):
    """Rows, column count, date range (and size in MB, not compared) of a written table."""
    path = B.write_table(silver(spark, sf), scratch_path(spark, "silver"))
    return B.metadata(spark, path).select("rows", "n_columns", "min_date", "max_date")


def present_partitions(spark, sf):
    """What has been landed: one bronze partition per (station, half-year), listed without reading it."""
    root = scratch_path(spark, "stations")
    w = bronze_weather(spark, sf).withColumn("source", F.col("station_id"))
    B.write_bronze(w.withColumn("ingest_date", F.date_format(half_year_start(F.to_date("date")), "yyyy-MM-dd")), root)
    return B.list_partitions(spark, root)


PLAN_SQL = BW_SQL + f""",
present AS (SELECT DISTINCT station_id AS source, strftime({HALF_SQL}, '%Y-%m-%d') AS ingest_date FROM bw),
st AS (SELECT DISTINCT format('ST{{:05d}}', r_regionkey) AS source FROM region)"""


def _plan_sql(start: dt.date, end: dt.date, force: bool) -> str:
    s0 = dt.date(start.year, 1 if start.month <= 6 else 7, 1)
    per = (f"SELECT st.source, CAST(p AS DATE) AS period_start, "
           f"CAST(p + INTERVAL 6 MONTH - INTERVAL 1 DAY AS DATE) AS period_end "
           f"FROM st, generate_series(DATE '{s0}', DATE '{end}', INTERVAL 6 MONTH) AS g(p)")
    if force:
        return per
    recent = f"period_end >= DATE '{TODAY}' - {CFG.refresh_window_days}"
    return (f"SELECT * FROM ({per}) x WHERE NOT EXISTS (SELECT 1 FROM present pr WHERE pr.source = x.source "
            f"AND CAST(pr.ingest_date AS DATE) = x.period_start) OR {recent} "
            f"UNION SELECT * FROM ({per}) y WHERE {recent}")


PLAN_KINDS = kinds_for(["source", "period_start", "period_end"], dates=("period_start", "period_end"))


@register("s10_incremental_plan", PLAN_SQL, _plan_sql(dt.date(TODAY.year - LOOKBACK, 1, 1), TODAY, False), PLAN_KINDS)
def s10_incremental_plan(spark, sf):
    """Half-year periods x stations still to fetch: missing ones plus those ending within 30 days."""
    stations = T.stations(spark, sf).select(F.col("station_id").alias("source"))
    return PL.fetch_plan(stations, present_partitions(spark, sf), dt.date(TODAY.year - LOOKBACK, 1, 1), TODAY, TODAY,
                         CFG.refresh_window_days)


@register("s11_staleness", PLAN_SQL,
          f"SELECT source, max(CAST(ingest_date AS DATE)) AS latest, datediff('day', max(CAST(ingest_date AS DATE)), DATE '{TODAY}') AS age_days, "
          f"datediff('day', max(CAST(ingest_date AS DATE)), DATE '{TODAY}') > 1 AS reload FROM present GROUP BY source",
          kinds_for(["source", "latest", "age_days", "reload"], ints=("age_days",), dates=("latest",), bools=("reload",)))
def s11_staleness(spark, sf):
    """Latest partition per source and whether it must be reloaded."""
    return PL.stale_sources(present_partitions(spark, sf), TODAY)


@register("s12_truncation_warning", BW_SQL,
          "SELECT source, ingest_date, count(*) AS rows FROM lw GROUP BY source, ingest_date HAVING count(*) >= 1000",
          kinds_for(["source", "ingest_date", "rows"], ints=("rows",)))
def s12_truncation_warning(spark, sf):
    """Bronze partitions with at least 1000 rows (a paged response may have been cut)."""
    root = bronze_root(spark, sf)
    return B.truncation_warnings(B.read_bronze(spark, root)).withColumn("ingest_date", F.col("ingest_date").cast("string"))


@register("s13_current_year_reload", PLAN_SQL, _plan_sql(dt.date(TODAY.year, 1, 1), TODAY, True), PLAN_KINDS)
def s13_current_year_reload(spark, sf):
    """Forced reload plan of the current year."""
    stations = T.stations(spark, sf).select(F.col("station_id").alias("source"))
    return PL.current_year_plan(stations, present_partitions(spark, sf), TODAY)


@register("s14_csv_sink", S.views_sql(), "SELECT symbol, count(*) AS days, avg(close) AS mean_close FROM bars GROUP BY symbol",
          kinds_for(["symbol", "days", "mean_close"], ints=("days",)))
def s14_csv_sink(spark, sf):
    """A small report written as CSV with header and read back with its schema."""
    rep = T.bars(spark, sf).groupBy("symbol").agg(F.count(F.lit(1)).alias("days"), F.avg("close").alias("mean_close"))
    path = scratch_path(spark, "csv")
    B.write_csv(rep, path)
    return spark.read.schema("symbol string, days bigint, mean_close double").option("header", True).csv(path)


@register("r1_stream_landing", BW_SQL, "SELECT source, ingest_date, count(*) AS rows FROM lw GROUP BY source, ingest_date",
          kinds_for(["source", "ingest_date", "rows"], ints=("rows",)))
def r1_stream_landing(spark, sf):
    """Landed files -> Structured Streaming (AvailableNow) -> bronze, then rows per partition."""
    from harvestframe.streaming.landing import land_stream
    landing, root, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "bronze"), scratch_path(spark, "ckpt")
    lw = landed_weather(spark, sf)
    lw.write.partitionBy("source", "ingest_date").parquet(landing)
    q = land_stream(spark, landing, lw.schema, root, ckpt, ["date", "region", "datatype"])
    q.awaitTermination()
    return B.read_bronze(spark, root).groupBy("source", F.col("ingest_date").cast("string").alias("ingest_date")) \
        .agg(F.count(F.lit(1)).alias("rows"))


@register("l4_pipeline", QSQL,
          "SELECT (SELECT count(*) FROM silver) AS silver_rows, 80 AS gold_features, "
          "(SELECT CAST(coalesce(bool_and(passed), false) AS INTEGER) FROM qall WHERE \"check\" = 'overall') AS quality_passed, false AS trained",
          kinds_for(["silver_rows", "gold_features", "quality_passed", "trained"], ints=("silver_rows", "gold_features", "quality_passed"), bools=("trained",)))
def l4_pipeline(spark, sf):
    """L4: land -> silver -> gold -> contracts -> quality -> metrics, tables written between layers."""
    from harvestframe.plans.pipeline import run_pipeline
    from harvestframe.queries_core import landed
    out = run_pipeline(spark, *landed(spark, sf), scratch_path(spark, "pipeline"), CFG, today=TODAY)
    return out.select("silver_rows", "gold_features", "quality_passed", "trained")


@register("l4_two_runs", S.gold_sql(), f"SELECT {', '.join(GOLD_COLS)} FROM gold", kinds_for(GOLD_COLS))
def l4_two_runs(spark, sf):
    """A build of what was landed by a date, then a plan-driven run over all rows that lands and
    rebuilds only what changed; gold is that of one build over everything."""
    from harvestframe.plans.incremental import daily_build, read_layer
    from harvestframe.queries_core import landed
    bars, weather = landed(spark, sf)
    root, cut, begin = scratch_path(spark, "two-runs"), dt.date(2000, 12, 31), dt.date(1992, 1, 1)
    daily_build(spark, bars.where(F.col("date") <= F.lit(cut)), weather.where(F.to_date("date") <= F.lit(cut)), root, CFG, cut, begin)
    daily_build(spark, bars, weather, root, CFG, dt.date(2001, 12, 31), begin)
    return read_layer(spark, root, "gold").select(*GOLD_COLS)
