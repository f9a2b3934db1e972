"""A made-up silver table, shared by the tests."""


def synthetic_silver(n=500, seed=42, symbol="corn", end="2024-06-28"):
    """A made-up silver series ending on a fixed business day: heavy-tailed multiplicative prices,
    temperatures from the day of the year, rain on about a third of the days, legs in units of their own."""
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(seed)
    days = pd.bdate_range(end=end, periods=n)

    def walk(start, spread):
        return start * np.exp(np.cumsum(rng.standard_t(6, n) * spread))

    close = walk(82.0, 0.011)
    open_ = close * (1 + rng.uniform(-0.008, 0.008, n))
    season = np.cos(2 * np.pi * (days.dayofyear.to_numpy() - 200) / 365.25)
    tmax = 61 + 29 * season + rng.gamma(2.0, 4.0, n)
    wet = rng.random(n) < 0.35
    df = pd.DataFrame({
        "symbol": symbol, "date": days.date, "close": close, "open": open_,
        "high": np.maximum(open_, close) * (1 + rng.exponential(0.006, n)),
        "low": np.minimum(open_, close) * (1 - rng.exponential(0.006, n)),
        "volume": np.round(rng.lognormal(9.5, 0.6, n)),
        "tmax_f": tmax, "tmin_f": tmax - rng.uniform(9, 27, n),
        "prcp_in": np.where(wet, rng.exponential(0.21, n), 0.0), "snow_mm": np.where(wet & (tmax < 40), 11.0, 0.0),
        "wheat_close": walk(14.0, 0.013), "crude_close": walk(2900.0, 0.02), "usd_close": walk(1.3, 0.004),
    })
    df["high_low_pct"] = (df["high"] - df["low"]) / df["close"]
    df["returns_1d"] = df["close"].pct_change()
    df["log_return_1d"] = np.log1p(df["returns_1d"])
    df["day_of_week"] = days.dayofweek.astype("int32")
    df["month"] = days.month.astype("int32")
    return df


SILVER_ORDER = ["symbol", "date", "open", "high", "low", "close", "volume", "returns_1d", "log_return_1d",
                "high_low_pct", "tmax_f", "tmin_f", "prcp_in", "snow_mm", "wheat_close", "crude_close",
                "usd_close", "day_of_week", "month"]
