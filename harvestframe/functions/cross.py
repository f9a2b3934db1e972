"""F27-F29 cross-asset features; the other legs are columns joined on the spine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestframe.config import FeatureConfig
from harvestframe.functions.numeric import div, ln_pos, nullif0
from harvestframe.operators.windows import KEY, ORDER, lag, pad, pct_change_of_padded, rolling_corr

NAMES = ["corn_wheat_ratio", "corn_wheat_spread", "corn_crude_corr_20d", "usd_return_5d", "corn_usd_corr_20d"]


def names(f: FeatureConfig | None = None) -> list[str]:
    return list(NAMES)


def add(df: DataFrame, f: FeatureConfig, keys=KEY, order=ORDER) -> DataFrame:
    """The features of the legs that the frame has."""
    n = f.corr_window
    legs = [leg for leg in ("wheat", "crude", "usd") if f"{leg}_close" in df.columns]
    # The other leg's log return is taken on the spine after the left join, so a
    # holiday NULL removes two returns (as in the reference).
    helpers, out = {}, {}
    for leg in legs:
        close = F.col(f"{leg}_close")
        if leg == "wheat":
            out["corn_wheat_ratio"] = div(F.col("close"), nullif0("wheat_close"))
            out["corn_wheat_spread"] = F.col("close") - close
            continue
        helpers[f"__{leg}_lr"] = ln_pos(div(close, lag(f"{leg}_close", keys=keys, order=order)))
        if leg == "usd":
            if "__usd_pad" not in df.columns:  # a chunked build brings it
                helpers["__usd_pad"] = pad("usd_close", keys=keys, order=order)
            out["usd_return_5d"] = pct_change_of_padded("__usd_pad", 5, keys=keys, order=order)
        out[f"corn_{leg}_corr_20d"] = rolling_corr("log_return_1d", f"__{leg}_lr", n, keys=keys, order=order)
    if helpers:
        df = df.withColumns(helpers)
    return df.withColumns(out).drop(*helpers, "__usd_pad") if out else df
