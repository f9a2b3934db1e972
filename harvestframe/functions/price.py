"""F1-F7 price and return features.  Needs ``__close_pad``, ``__close_lag1`` and ``__ema_close_{w}``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestframe.config import FeatureConfig
from harvestframe.functions.numeric import div
from harvestframe.operators.windows import KEY, ORDER, pct_change_of_padded, rolling_mean


def names(f: FeatureConfig) -> list[str]:
    out = []
    for w in f.rolling_windows:
        out += [f"return_{w}d", f"sma_{w}", f"ema_{w}", f"price_to_sma_{w}"]
    return out + ["high_low_range", "overnight_gap", "volume_ratio_20"]


def add(df: DataFrame, f: FeatureConfig, keys=KEY, order=ORDER) -> DataFrame:
    first = {}
    for w in f.rolling_windows:
        first[f"return_{w}d"] = pct_change_of_padded("__close_pad", w, keys=keys, order=order)      # F1
        first[f"sma_{w}"] = rolling_mean("close", w, keys=keys, order=order)                        # F2
        first[f"ema_{w}"] = F.col(f"__ema_close_{w}")                       # F3
    first["high_low_range"] = div(F.col("high") - F.col("low"), F.col("close"))           # F5
    first["overnight_gap"] = div(F.col("open") - F.col("__close_lag1"), F.col("__close_lag1"))  # F6
    first["volume_ratio_20"] = div(F.col("volume"), rolling_mean("volume", 20, keys=keys, order=order))          # F7
    df = df.withColumns(first)
    return df.withColumns({f"price_to_sma_{w}": div(F.col("close"), F.col(f"sma_{w}")) - F.lit(1.0)
                           for w in f.rolling_windows})                              # F4
