"""Bounded nearest as-of join of a (symbol, date) spine with a date-keyed table.

pandas ``merge_asof(direction="nearest", tolerance=k days)``: each spine row takes
the right row whose date is closest within k days, ties to the earlier date;
unmatched rows keep NULLs, and a matched right row with NULL fields stays NULL.

Plan: the mapping is computed once per *distinct spine date* (bounded by the
calendar, not by the number of series): distinct dates x (2k+1) day offsets,
equi-joined with the right table on date, best offset by
``min_by(struct(right cols), struct(|off|, off))``.  The spine then gets a plain
equi-join on date with that mapping (AQE broadcasts it after measuring it).
The big side is never exploded and the join key is never skewed by a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def offsets(tolerance_days: int, direction: str = "nearest") -> list[int]:
    k = int(tolerance_days)
    if direction == "nearest":
        return list(range(-k, k + 1))
    if direction == "backward":
        return list(range(-k, 1))
    if direction == "forward":
        return list(range(0, k + 1))
    raise ValueError(f"direction must be nearest, backward or forward, not {direction!r}")


def asof_date_map(spine_dates: DataFrame, right: DataFrame, tolerance_days: int = 3,
                  direction: str = "nearest", on: str = "date",
                  value_cols: Sequence[str] | None = None) -> DataFrame:
    """(on, value cols...) for each distinct spine date that found a match."""
    value_cols = [c for c in (value_cols or right.columns) if c != on]
    offs = F.array(*[F.lit(o) for o in offsets(tolerance_days, direction)])
    cand = (spine_dates.select(on).distinct()
            .select(on, F.explode(offs).alias("__off"))
            .withColumn("__rdate", F.date_add(F.col(on), F.col("__off"))))
    r = right.select(F.col(on).alias("__rdate"), *value_cols)
    m = cand.join(r, "__rdate")
    best = (m.groupBy(on)
             .agg(F.min_by(F.struct(*value_cols),
                           F.struct(F.abs("__off").alias("a"), F.col("__off").alias("o"))).alias("__v")))
    return best.select(on, *[F.col(f"__v.{c}").alias(c) for c in value_cols])


def calendar_dates(right: DataFrame, tolerance_days: int, on: str = "date") -> DataFrame:
    """Every calendar day within ``tolerance_days`` of the right table's date range
    (one row per day: bounded by the calendar, derived from the right side only)."""
    k = int(tolerance_days)
    bounds = right.agg(F.min(on).alias("lo"), F.max(on).alias("hi"))
    return bounds.select(F.explode(F.sequence(F.date_sub("lo", k), F.date_add("hi", k))).alias(on))


def asof_join(spine: DataFrame, right: DataFrame, tolerance_days: int = 3,
              direction: str = "nearest", on: str = "date",
              value_cols: Sequence[str] | None = None, mapping_on: str = "calendar") -> DataFrame:
    """J1.  ``mapping_on="calendar"`` (default) maps every day of the right table's
    range, so the spine's source is read once; ``"spine"`` maps the distinct spine
    dates instead (smaller when the right side spans far more days than the spine)."""
    dates = calendar_dates(right, tolerance_days, on) if mapping_on == "calendar" else spine
    mapping = asof_date_map(dates, right, tolerance_days, direction, on, value_cols)
    return spine.join(mapping, on, "left")
