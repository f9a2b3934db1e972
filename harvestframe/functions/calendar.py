"""F23-F26 calendar features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestframe.config import FeatureConfig
from harvestframe.functions.numeric import TWO_PI

NAMES = ["month_sin", "month_cos", "doy_sin", "doy_cos", "week_sin", "week_cos",
         "is_planting", "is_pollination", "is_harvest", "is_growing_season",
         "days_to_wasde", "wasde_week", "is_monday"]

# Fixed values (crop calendar months and the report day) that must equal the reference's.
PLANTING_MONTHS = (4, 5)
POLLINATION_MONTHS = (7,)
HARVEST_MONTHS = (9, 10, 11)
GROWING_SEASON = (4, 10)
WASDE_DAY = 10
WASDE_WEEK_DAYS = 3


def names(f: FeatureConfig | None = None) -> list[str]:
    return list(NAMES)


def silver_calendar(date_col: str = "date") -> dict:
    """Monday = 0 (rule N10) and month."""
    d = F.col(date_col)
    return {"day_of_week": F.weekday(d), "month": F.month(d)}


def _cyc(fn, x, period):
    return fn(F.lit(TWO_PI) * x.cast("double") / F.lit(float(period)))


def add(df: DataFrame, f: FeatureConfig | None = None) -> DataFrame:
    d = F.col("date")
    m, doy, wk = F.month(d), F.dayofyear(d), F.weekofyear(d)  # weekofyear is ISO (rule N11)
    days = F.abs(F.lit(WASDE_DAY) - F.dayofmonth(d))
    return df.withColumns({
        "month_sin": _cyc(F.sin, m, 12), "month_cos": _cyc(F.cos, m, 12),
        "doy_sin": _cyc(F.sin, doy, 365), "doy_cos": _cyc(F.cos, doy, 365),
        "week_sin": _cyc(F.sin, wk, 52), "week_cos": _cyc(F.cos, wk, 52),
        "is_planting": m.isin(*PLANTING_MONTHS).cast("int"),
        "is_pollination": m.isin(*POLLINATION_MONTHS).cast("int"),
        "is_harvest": m.isin(*HARVEST_MONTHS).cast("int"),
        "is_growing_season": m.between(*GROWING_SEASON).cast("int"),
        "days_to_wasde": days,
        "wasde_week": (days <= WASDE_WEEK_DAYS).cast("int"),
        "is_monday": (F.weekday(d) == 0).cast("int"),
    })
