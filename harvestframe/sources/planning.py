"""Incremental fetch planning as joins against the partition listing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def half_year_periods(start: dt.date, end: dt.date):
    """Calendar half-years [H1 01-01..06-30, H2 07-01..12-31] covering [start, end] as a column expression."""
    s = dt.date(start.year, 1 if start.month <= 6 else 7, 1)
    return F.sequence(F.lit(s), F.lit(end), F.expr("INTERVAL 6 MONTHS"))


def fetch_plan(stations: DataFrame, present: DataFrame, start: dt.date, end: dt.date, today: dt.date,
               refresh_days: int = 30, force: bool = False) -> DataFrame:
    """(source, period_start, period_end) still to fetch.

    A period is skipped when its partition (keyed by period start) exists, unless
    ``force`` or the period ends within ``refresh_days`` of ``today`` (late data)."""
    periods = stations.select(F.col("source"), F.explode(half_year_periods(start, end)).alias("period_start"))
    # a period always ends on its half-year end (June 30 / December 31), even past ``end``
    periods = periods.withColumn("period_end", F.date_sub(F.add_months("period_start", 6), 1))
    if force:
        return periods
    recent = F.col("period_end") >= F.date_sub(F.lit(today), refresh_days)
    have = present.select("source", F.to_date("ingest_date").alias("period_start"))
    missing = periods.join(have, ["source", "period_start"], "left_anti")
    return missing.unionByName(periods.where(recent)).distinct()


def stale_sources(present: DataFrame, today: dt.date, max_age_days: int = 1) -> DataFrame:
    """Per source the latest partition and whether it must be reloaded."""
    latest = present.groupBy("source").agg(F.max(F.to_date("ingest_date")).alias("latest"))
    return latest.withColumns({
        "age_days": F.datediff(F.lit(today), F.col("latest")),
        "reload": F.datediff(F.lit(today), F.col("latest")) > max_age_days,
    })


def current_year_plan(stations: DataFrame, present: DataFrame, today: dt.date) -> DataFrame:
    """Reload of the current year, forced."""
    return fetch_plan(stations, present, dt.date(today.year, 1, 1), today, today, force=True)
