"""forward return target (percent), NULL in the last ``h`` rows of each series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestframe.config import FeatureConfig
from harvestframe.functions.numeric import div
from harvestframe.operators.windows import KEY, ORDER, lead


def add(df: DataFrame, f: FeatureConfig, keys=KEY, order=ORDER) -> DataFrame:
    h = f.target_horizon_days
    return df.withColumns({
        "target": (div(lead("close", h, keys=keys, order=order), F.col("close")) - F.lit(1.0)) * F.lit(100.0),
        "target_horizon": F.lit(h),
    })
