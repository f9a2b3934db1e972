"""Plan-driven daily build: land only what the plans name, rebuild only what that changes.

Weather lands by station and half-year (S10): a period that is there and closed is not landed again,
a recent one replaces its partition.  Bars land by symbol (S11): a stale symbol's history goes into the
partition of the day.  Neither silver nor gold reads old ingests of bars again: ``bars`` under the root
keeps the one row that counts for each (symbol, date), merged with the day's partition alone.

What changed is found by comparing the landed partitions with what they replace or join.  From the
earliest changed date of a series follow the years of silver to rebuild, and, a target's horizon
earlier, those of gold.  Both tables are partitioned by (symbol, year), a rebuild replaces whole years,
and it reads back only as many years as the windows and averages look back.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestframe.config import Config
from harvestframe.functions.numeric import div
from harvestframe.plans.gold import build_gold, ema_specs, lookback_rows, signal_spec
from harvestframe.plans.silver import build_silver
from harvestframe.session import written
from harvestframe.sources.bronze import list_partitions, read_bronze, table_exists, write_bronze
from harvestframe.sources.planning import fetch_plan, stale_sources

BAR_COLS = ("symbol", "date", "open", "high", "low", "close", "volume")
#: An average forgets a row when its weight is below this part of the whole.
FORGOTTEN = 1e-17


def rows_back(cfg: Config = Config()) -> int:
    """Rows before the first rebuilt one that its features depend on: windows, and averages until they forget."""
    fade = lambda s: math.ceil(math.log(FORGOTTEN) / math.log(1 - s.alpha))
    averages = max(map(fade, ema_specs(cfg)))
    return max(lookback_rows(cfg), averages + fade(signal_spec(cfg)))


def _parts(df: DataFrame) -> DataFrame:
    return df.withColumn("year", F.year("date"))


def _swap(df: DataFrame, path: str) -> None:
    """Replace the (symbol, year) partitions that ``df`` has rows of; a large one is split over tasks."""
    (_parts(df).hint("rebalance", F.col("symbol"), F.col("year")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("symbol", "year").parquet(path))


def _read(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` with its symbol as text, whatever the folder names look like."""
    df = spark.read.option("basePath", path).parquet(path)
    return df.withColumn("symbol", F.col("symbol").cast("string"))


def land_weather(spark: SparkSession, weather_long: DataFrame, root: str, start: dt.date, today: dt.date,
                 cfg: Config = Config(), force: bool = False) -> dt.date | None:
    """Land the planned periods; the earliest date whose observations changed, or None."""
    path = f"{root}/bronze_weather"
    stations = weather_long.select(F.col("region").alias("source")).distinct()
    plan = fetch_plan(stations, list_partitions(spark, path), start, today, today, cfg.refresh_window_days, force)
    plan = written(plan, "weather-plan")  # a row per station and half-year
    cols = ["date", "region", "datatype", "value"]
    day = F.to_date("date")
    new = (weather_long.select(*cols).join(plan, (F.col("region") == F.col("source")) & day.between(F.col("period_start"), F.col("period_end")))
           .withColumn("ingest_date", F.col("period_start").cast("string")).drop("period_start", "period_end"))
    new = written(new, "weather-landed")
    if new.isEmpty():
        return None
    changed = new.select(*cols)
    if table_exists(spark, path):
        periods = [r[0] for r in plan.select(F.col("period_start").cast("string")).distinct().collect()]  # one per half-year
        old = read_bronze(spark, path).where(F.col("ingest_date").cast("string").isin(periods))
        old = old.join(new.select("source", F.col("ingest_date").cast("date")).distinct(), ["source", "ingest_date"], "left_semi").select(*cols)
        changed = changed.exceptAll(old).unionByName(old.exceptAll(changed))
    first = changed.agg(F.min(F.to_date("date"))).first()[0]
    write_bronze(new, path)
    return first


def land_bars(spark: SparkSession, bars: DataFrame, root: str, today: dt.date, cfg: Config = Config(),
              force: bool = False) -> DataFrame:
    """Land stale symbols and merge the day's rows into ``bars``; (symbol, first) of the symbols that changed."""
    path, held = f"{root}/bronze_futures", f"{root}/bars"
    present = list_partitions(spark, path)
    fresh = stale_sources(present, today).where("not reload").select(F.col("source").alias("symbol"))
    due = bars.select(*BAR_COLS) if force else bars.select(*BAR_COLS).join(fresh, "symbol", "left_anti")
    due = written(due.withColumn("date", F.to_date("date")), "bars-due")
    if not due.isEmpty():
        write_bronze(due.withColumns({"source": F.col("symbol"), "ingest_date": F.lit(str(today))}), path)
    changed = due
    if table_exists(spark, held):
        before = _read(spark, held).select(*BAR_COLS)
        if cfg.transforms.dedupe_keep == "last":  # a restated row counts
            changed = due.exceptAll(before)
        else:
            changed = due.join(before.select("symbol", "date"), ["symbol", "date"], "left_anti")
        changed = written(changed, "bars-changed")
        years = _parts(changed.select("symbol", "date")).select("symbol", "year").distinct()
        stay = _read(spark, held).join(years, ["symbol", "year"], "left_semi").join(changed.select("symbol", "date"), ["symbol", "date"], "left_anti")
        _swap(written(stay.select(*BAR_COLS).unionByName(changed), "bars-merged"), held)
    elif not due.isEmpty():
        _swap(due, held)
    return written(changed.groupBy("symbol").agg(F.min("date").alias("first")), "bars-first")


def _years_back(counts: DataFrame, begin: DataFrame, col: str, rows: int, out: str) -> DataFrame:
    """``begin`` with ``out``: the latest year so that ``rows`` rows lie between it and year ``col``, or the first one.

    ``counts`` has one row per (symbol, year), so a series is a few dozen rows here.
    """
    before = counts.join(begin.select("symbol", col), "symbol").where(F.col("year") < F.col(col))
    upto = F.expr("aggregate(filter(years, y -> y.year >= x.year), 0L, (s, y) -> s + y.n)")
    lists = before.groupBy("symbol").agg(F.collect_list(F.struct("year", "n")).alias("years"))
    enough = lists.select("symbol", "years", F.explode("years").alias("x")).withColumn("rows", upto)
    found = enough.groupBy("symbol").agg(F.coalesce(F.max(F.when(F.col("rows") >= rows, F.col("x.year"))), F.min("x.year")).alias(out))
    return begin.join(found, "symbol", "left").withColumn(out, F.coalesce(out, col))


def affected(spark: SparkSession, root: str, bars_first: DataFrame, weather_first: dt.date | None, cfg: Config = Config()) -> DataFrame:
    """(symbol, silver_year, gold_year, read_year): the first years to rebuild and to read, for the series that changed."""
    t = cfg.transforms
    counts = written(_read(spark, f"{root}/bars").where(F.col("volume") >= t.min_daily_volume).groupBy("symbol", "year").agg(F.count("*").alias("n")), "bars-years")
    legs = [s for _, s in cfg.correlated]
    leg_first = bars_first.where(F.col("symbol").isin(legs)).agg(F.min("first")).first()[0] if legs else None
    shared = [d for d in (leg_first, weather_first - dt.timedelta(days=t.asof_tolerance_days) if weather_first else None) if d]
    every = F.lit(min(shared) if shared else None).cast("date")  # joined into every series
    series = counts.groupBy("symbol").agg(F.min("year").alias("begins")).join(bars_first, "symbol", "left")
    first = (series.withColumn("first", F.least("first", every)).where("first is not null")
             .select("symbol", F.greatest("begins", F.year("first")).alias("silver_year")))
    h = cfg.features.target_horizon_days
    out = _years_back(counts, first, "silver_year", h, "gold_year")
    return written(_years_back(counts, out, "gold_year", rows_back(cfg), "read_year"), "affected")


def rebuild(spark: SparkSession, root: str, ranges: DataFrame, cfg: Config = Config()) -> None:
    """Replace the affected years of silver and gold.  Legs and weather are read over the same years."""
    span = ranges.agg(F.min("read_year"), F.min("silver_year")).first()
    if span[0] is None:
        return
    since = dt.date(span[0], 1, 1)
    everything = _read(spark, f"{root}/bars").where(F.col("year") >= span[0])  # prunes partitions
    mine = everything.join(ranges.select("symbol", "read_year"), "symbol").where(F.col("year") >= F.col("read_year")).select(*BAR_COLS)
    legs = everything.where(F.col("symbol").isin([s for _, s in cfg.correlated])).select(*BAR_COLS)
    bars = mine.unionByName(legs.join(ranges.select("symbol"), "symbol", "left_anti"))  # legs that did not change are read, not rebuilt
    weather = None
    if table_exists(spark, f"{root}/bronze_weather"):
        half = since - dt.timedelta(days=cfg.transforms.asof_tolerance_days)
        weather = read_bronze(spark, f"{root}/bronze_weather", start=dt.date(half.year, 1 if half.month <= 6 else 7, 1)).drop("_ingest_date", "_ingest_ts")
        weather = weather.withColumnRenamed("ingest_date", "_ingest_date")
    silver = build_silver(bars.withColumn("_ingest_date", F.lit("")), weather, cfg)
    silver = _parts(silver).join(ranges, "symbol")
    _swap(written(silver.where(F.col("year") >= F.col("silver_year")).drop("year", *ranges.columns[1:]), "silver-years"), f"{root}/silver")

    held = _read(spark, f"{root}/silver").where(F.col("year") >= span[0]).join(ranges, "symbol").where(F.col("year") >= F.col("read_year"))
    gold = written(build_gold(held.drop("year", *ranges.columns[1:]), cfg), "gold-slice")
    _swap(written(_carry_obv(spark, root, gold, ranges), "gold-years"), f"{root}/gold")


def _carry_obv(spark: SparkSession, root: str, gold: DataFrame, ranges: DataFrame) -> DataFrame:
    """The rows of ``gold`` from their gold_year on, with the volume balance carried on from the gold table.

    The balance is a running sum since the start of the series; a slice starts it anew, so its rows
    differ by one constant, read off the last row before the rebuilt years.
    """
    mine = _parts(gold).join(ranges.select("symbol", "gold_year"), "symbol")
    keep = mine.where(F.col("year") >= F.col("gold_year"))
    if table_exists(spark, f"{root}/gold"):
        prior = mine.where(F.col("year") < F.col("gold_year")).groupBy("symbol").agg(F.max("date").alias("at"), F.max_by("obv", "date").alias("own"))
        old = _read(spark, f"{root}/gold").select("symbol", F.col("date").alias("at"), F.col("obv").alias("whole"), "year")
        last = old.join(prior.withColumn("y", F.year("at")), ["symbol", "at"]).where(F.col("year") == F.col("y"))
        keep = keep.join(last.select("symbol", (F.col("whole") - F.col("own")).alias("__carry")), "symbol", "left")
        carry = F.coalesce("__carry", F.lit(0.0))
        keep = keep.withColumns({"obv": F.col("obv") + carry, "obv_sma20": F.col("obv_sma20") + carry})
        keep = keep.withColumn("obv_ratio", div(F.col("obv"), F.nullif("obv_sma20", F.lit(0.0)))).drop("__carry")
    return keep.select(*gold.columns)


def daily_build(spark: SparkSession, bars: DataFrame, weather_long: DataFrame | None, root: str, cfg: Config = Config(),
                today: dt.date | None = None, start: dt.date | None = None, force_refresh: bool = False) -> DataFrame:
    """One day: plans, landing, rebuild.  Returns (symbol, silver_year, gold_year, read_year) of the rebuilt series.

    ``start`` (default: January 1st of today's year less the lookback) bounds the weather plan.
    ``force_refresh`` lands every period and symbol again.  A leg without a value for longer than the
    look-back is taken as missing from there on.
    """
    today = today or dt.date.today()
    start = start or dt.date(today.year - cfg.monitoring.lookback_years, 1, 1)
    weather_first = land_weather(spark, weather_long, root, start, today, cfg, force_refresh) if weather_long is not None else None
    bars_first = land_bars(spark, bars, root, today, cfg, force_refresh)
    ranges = affected(spark, root, bars_first, weather_first, cfg)
    rebuild(spark, root, ranges, cfg)
    return ranges


def read_layer(spark: SparkSession, root: str, layer: str) -> DataFrame:
    """``silver`` or ``gold`` as built, without the partition column."""
    return _read(spark, f"{root}/{layer}").drop("year")
