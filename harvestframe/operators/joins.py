"""Date-keyed left join.  Broadcasts are left to Spark's own size checks (statistics, and AQE at runtime)."""

from __future__ import annotations

from pyspark.sql import DataFrame

def left_join_on_date(spine: DataFrame, dim: DataFrame, on=("date",)) -> DataFrame:
    """Left join of a date-keyed table (holidays stay NULL).

    ``dim`` is date-keyed (one row per day) so its size is bounded by the
    calendar; AQE decides broadcast vs. sort-merge from its measured size.
    """
    return spine.join(dim, list(on), "left")
