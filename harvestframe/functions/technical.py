"""F8-F12 technical indicators: RSI, MACD, Bollinger, ATR, OBV.

Needs ``__close_lag1``, ``__delta``, ``__ema_close_{fast,slow}``, ``__rsi_up``, ``__rsi_dn``
and, for the MACD signal, a second EMA pass (see ``plans.gold``).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestframe.config import FeatureConfig
from harvestframe.functions.numeric import div, nullif0
from harvestframe.operators.windows import KEY, ORDER, rolling_mean, rolling_std, running_sum

NAMES = ["rsi", "macd", "macd_signal_line", "macd_hist", "bb_upper", "bb_lower", "bb_pct_b",
         "bb_bandwidth", "atr", "atr_pct", "obv", "obv_sma20", "obv_ratio"]


def names(f: FeatureConfig) -> list[str]:
    return list(NAMES)


def add_macd(df: DataFrame, f: FeatureConfig) -> DataFrame:
    return df.withColumn("macd", F.col(f"__ema_close_{f.macd_fast}") - F.col(f"__ema_close_{f.macd_slow}"))


def add(df: DataFrame, f: FeatureConfig, keys=KEY, order=ORDER) -> DataFrame:
    """Everything but ``macd``/``macd_signal_line`` which the EMA passes produce."""
    c, h, l, c1 = F.col("close"), F.col("high"), F.col("low"), F.col("__close_lag1")
    bb_mid = rolling_mean("close", f.bb_period, keys=keys, order=order)
    bb_std = rolling_std("close", f.bb_period, keys=keys, order=order)
    tr = F.greatest(h - l, F.abs(h - c1), F.abs(l - c1))                    # F11, NULL-skipping
    obv_term = F.coalesce(F.signum(F.col("__delta")) * F.col("volume"), F.lit(0.0))
    df = df.withColumns({
        "rsi": F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + div(F.col("__rsi_up"), nullif0("__rsi_dn"))),
        "macd_hist": F.col("macd") - F.col("macd_signal_line"),
        "bb_upper": bb_mid + F.lit(2.0) * bb_std,
        "bb_lower": bb_mid - F.lit(2.0) * bb_std,
        "__bb_mid": bb_mid,
        "__tr": tr,
        # F12; a chunked build passes the exact series-wide running sum in "__obv"
        "obv": F.col("__obv") if "__obv" in df.columns else running_sum(obv_term, keys=keys, order=order),
    })
    width = F.col("bb_upper") - F.col("bb_lower")
    df = df.withColumns({
        "bb_pct_b": div(c - F.col("bb_lower"), nullif0(width)),
        "bb_bandwidth": div(width, F.col("__bb_mid")),
        "atr": rolling_mean("__tr", f.atr_period, keys=keys, order=order),
        "obv_sma20": rolling_mean("obv", 20, keys=keys, order=order),
    })
    return df.withColumns({
        "atr_pct": div(F.col("atr"), c),
        "obv_ratio": div(F.col("obv"), nullif0("obv_sma20")),
    })


SQRT_LN2_X2 = 2.0 * math.sqrt(math.log(2.0))
