"""F17-F22 agronomic features: growing degree days, heat stress, precipitation anomaly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestframe.config import FeatureConfig
from harvestframe.functions.numeric import clip_lower, div, flag, nullif0
from harvestframe.operators.windows import (KEY, ORDER, add_long_moments, count_from_parts, rolling_mean,
                                            rolling_mean_from_parts, rolling_sum,
                                            running_parts, running_sum_keep_null, trailing)


def names(f: FeatureConfig) -> list[str]:
    return (["gdd_daily", "gdd_cumulative", "heat_stress_flag"]
            + [f"heat_stress_{w}d" for w in f.heat_windows]
            + ["prcp_zscore"] + [f"prcp_sum_{w}d" for w in f.prcp_sum_windows]
            + ["tmax_7d_avg", "tmax_anomaly_30d"])


def season_year(date_col: str, start_month: int):
    """Season label: the calendar year (start 1) or the year the season started in."""
    d = F.col(date_col)
    return F.year(d) if start_month == 1 else F.year(F.add_months(d, -(start_month - 1)))


def add(df: DataFrame, f: FeatureConfig, keys=KEY, order=ORDER, defer_cumulative: bool = False,
        block: int | None = None) -> DataFrame:
    """Nothing without temperatures, and no precipitation features without ``prcp_in``."""
    if "tmax_f" not in df.columns:
        return df
    tmax, tmin = F.col("tmax_f"), F.col("tmin_f")
    wet = "prcp_in" in df.columns
    sources = {"__prcp": "prcp_in", "__tmax": "tmax_f"} if wet else {"__tmax": "tmax_f"}
    L, mp = f.long_window, f.long_min_periods
    mean, std = {}, None
    if block and block >= L:
        # O(1) per row: block-anchored running moments sharing the caller's (block, row) sort
        df = add_long_moments(df, list(sources.values()), L, list(sources), keys, block=block)
        for p in sources:
            mean[p] = F.when(F.col(f"{p}_n") >= mp, F.col(f"{p}_mean"))
        std = F.when(F.col("__prcp_n") >= mp, F.col("__prcp_std")) if wet else None
    else:
        # means and counts from running sums (O(1) per row); the std in-frame
        df = df.withColumns({k: v for p, c in sources.items() for k, v in running_parts(F.col(c), p, keys, order).items()})
        for p in sources:
            mean[p] = rolling_mean_from_parts(p, L, mp, keys, order)
        if wet:
            std = F.when(count_from_parts("__prcp", L, keys, order) >= mp,
                         F.stddev_samp(F.col("prcp_in")).over(trailing(L, keys, order)))
    new = {
        "gdd_daily": clip_lower((tmax + tmin) / F.lit(2.0) - F.lit(float(f.gdd_base_temp_f)), 0.0),
        "heat_stress_flag": flag(tmax > F.lit(float(f.gdd_heat_stress_f))),
        "__season": season_year("date", f.season_start_month),
        "tmax_7d_avg": rolling_mean(tmax, 7, keys=keys, order=order),
        "tmax_anomaly_30d": tmax - mean["__tmax"],
    }
    if wet:
        prcp = F.col("prcp_in")
        new["prcp_zscore"] = div(prcp - mean["__prcp"], nullif0(std))
        new |= {f"prcp_sum_{w}d": rolling_sum(prcp, w, 1, keys=keys, order=order) for w in f.prcp_sum_windows}
    df = df.withColumns(new)
    df = df.withColumns({f"heat_stress_{w}d": rolling_sum("heat_stress_flag", w, 1, keys=keys, order=order)
                         for w in f.heat_windows})
    df = df.drop(*[f"{p}{x}" for p in ("__prcp", "__tmax") for x in ("__x0", "__s", "__n", "_n", "_mean", "_std")
                   if f"{p}{x}" in df.columns])
    return df if defer_cumulative else add_cumulative(df, f, keys, order)


def add_cumulative(df: DataFrame, f: FeatureConfig, keys=KEY, order=ORDER) -> DataFrame:
    """F18 GDD running sum per season.  Its window is partitioned by (series, season);
    a caller runs it last so the other windows keep sharing one sort."""
    if "gdd_daily" not in df.columns:
        return df
    # a chunked build passes the exact series-wide value in "__gdd_cum"
    gdd = (F.col("__gdd_cum") if "__gdd_cum" in df.columns
           else running_sum_keep_null("gdd_daily", keys=(*keys, "__season"), order=order))
    return df.withColumn("gdd_cumulative", gdd).drop("__season")
