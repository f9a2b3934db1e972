"""F13-F15 realised volatility, volatility regime, Parkinson estimator."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestframe.config import FeatureConfig
from harvestframe.functions.numeric import SQRT_252, div, flag, ln_pos
from harvestframe.operators.windows import KEY, ORDER, rolling_mean, rolling_std


def names(f: FeatureConfig) -> list[str]:
    return [f"rvol_{w}d" for w in f.rvol_windows] + ["vol_regime", "parkinson_vol"]


def add(df: DataFrame, f: FeatureConfig, keys=KEY, order=ORDER) -> DataFrame:
    cols = {f"rvol_{w}d": rolling_std("log_return_1d", w, keys=keys, order=order) * F.lit(SQRT_252) for w in f.rvol_windows}
    # As written in the reference: a rolling std of ln(high/low), not the mean of squares.
    cols["parkinson_vol"] = (rolling_std(ln_pos(div(F.col("high"), F.col("low"))), 20, keys=keys, order=order)
                             / F.lit(2.0 * math.sqrt(math.log(2.0)))) * F.lit(SQRT_252)
    df = df.withColumns(cols)
    return df.withColumn("vol_regime", flag(F.col("rvol_20d") > rolling_mean("rvol_20d", 60, keys=keys, order=order)))
