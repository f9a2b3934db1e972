"""Gold features against a pandas re-statement of the formulas."""

import numpy as np
import pandas as pd
import pytest


def pandas_oracle(g: pd.DataFrame) -> pd.DataFrame:
    g = g.sort_values("date").reset_index(drop=True)
    c = g["close"]
    o = pd.DataFrame({"date": g["date"]})
    for w in (5, 10, 20, 60):
        o[f"sma_{w}"] = c.rolling(w).mean()
        o[f"ema_{w}"] = c.ewm(span=w, adjust=False).mean()
        o[f"return_{w}d"] = c.pct_change(w)
    d = c.diff()
    up = d.clip(lower=0).ewm(com=13, adjust=False).mean()
    dn = (-d.clip(upper=0)).ewm(com=13, adjust=False).mean()
    o["rsi"] = 100 - 100 / (1 + up / dn.replace(0, np.nan))
    macd = c.ewm(span=12, adjust=False).mean() - c.ewm(span=26, adjust=False).mean()
    o["macd"] = macd
    o["macd_signal_line"] = macd.ewm(span=9, adjust=False).mean()
    mid, sd = c.rolling(20).mean(), c.rolling(20).std()
    o["bb_upper"] = mid + 2 * sd
    o["bb_pct_b"] = (c - (mid - 2 * sd)) / (4 * sd).replace(0, np.nan)
    tr = pd.concat([g.high - g.low, (g.high - c.shift()).abs(), (g.low - c.shift()).abs()], axis=1).max(axis=1)
    o["atr"] = tr.rolling(14).mean()
    o["obv"] = (np.sign(d) * g.volume).fillna(0).cumsum()
    o["rvol_20d"] = g.log_return_1d.rolling(20).std() * np.sqrt(252)
    gdd = ((g.tmax_f + g.tmin_f) / 2 - 50).clip(lower=0)
    o["gdd_cumulative"] = gdd.groupby(pd.to_datetime(g.date).dt.year).cumsum()
    o["heat_stress_30d"] = (g.tmax_f > 95).astype(int).rolling(30, min_periods=1).sum()
    rm, rs = g.prcp_in.rolling(365, min_periods=30).mean(), g.prcp_in.rolling(365, min_periods=30).std()
    o["prcp_zscore"] = (g.prcp_in - rm) / rs.replace(0, np.nan)
    o["corn_crude_corr_20d"] = g.log_return_1d.rolling(20).corr(np.log(g.crude_close / g.crude_close.shift(1)))
    o["usd_return_5d"] = g.usd_close.pct_change(5)
    o["target"] = (c.shift(-5) / c - 1) * 100
    return o


@pytest.mark.parametrize("symbol", ["corn", "oats"])
def test_features_match_pandas(gold_pdf, silver_pdf, symbol):
    got = gold_pdf[gold_pdf.symbol == symbol].reset_index(drop=True)
    exp = pandas_oracle(silver_pdf[silver_pdf.symbol == symbol])
    for col in exp.columns[1:]:
        a, b = got[col].astype(float).values, exp[col].astype(float).values
        assert (np.isnan(a) == np.isnan(b)).all(), col
        m = ~np.isnan(a)
        np.testing.assert_allclose(a[m], b[m], rtol=1e-9, atol=1e-9, err_msg=col)


def test_feature_count_and_list(spark, silver_pdf):
    from harvestframe.plans.gold import build_gold, feature_columns, feature_names
    g = build_gold(spark.createDataFrame(silver_pdf))
    assert feature_columns(g) == feature_names()
    assert len(feature_names()) == 80


def test_last_targets_null_and_bounds(gold_pdf):
    for _, g in gold_pdf.groupby("symbol"):
        assert g["target"].tail(5).isna().all() and g["target"].iloc[:-5].notna().all()
        assert (g["gdd_cumulative"].dropna() >= 0).all()
        assert g["rsi"].dropna().between(0, 100).all()
    for c in ("month_sin", "month_cos", "doy_sin", "doy_cos", "week_sin", "week_cos"):
        assert gold_pdf[c].between(-1, 1).all()


def test_symbol_alone_equals_union(spark, silver_pdf, gold_pdf):
    from harvestframe.plans.gold import build_gold
    alone = build_gold(spark.createDataFrame(silver_pdf[silver_pdf.symbol == "oats"])).toPandas()
    alone = alone.sort_values("date").reset_index(drop=True)
    union = gold_pdf[gold_pdf.symbol == "oats"].reset_index(drop=True)
    pd.testing.assert_frame_equal(alone, union, check_dtype=False)


def test_partitioning_does_not_change_result(spark, silver_pdf, gold_pdf):
    from harvestframe.plans.gold import build_gold
    shuffled = spark.createDataFrame(silver_pdf.sample(frac=1.0, random_state=3)).repartition(7)
    g = build_gold(shuffled).toPandas().sort_values(["symbol", "date"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(g, gold_pdf, check_dtype=False)


def test_no_lookahead(gold_pdf):
    from harvestframe.plans.gold import feature_names
    for _, g in gold_pdf.groupby("symbol"):
        nxt = g["log_return_1d"].shift(-1)
        for c in feature_names():
            if g[c].notna().sum() > 30 and g[c].std() > 0:
                assert abs(g[c].corr(nxt)) < 0.95, c


def test_chunked_build_equals_series_build(spark):
    """A long series split in 400-row chunks gives the same gold, whatever reaches beyond their halos."""
    from series import SILVER_ORDER, synthetic_silver
    from harvestframe.plans.gold import build_gold, lookback_rows
    pdf = pd.concat([synthetic_silver(n=3000, seed=5, symbol="hot"), synthetic_silver(n=120, seed=6, symbol="cold")])
    pdf = pdf[SILVER_ORDER]
    assert lookback_rows() <= 400
    pdf.loc[(pdf.symbol == "hot") & pdf.index.isin(range(700, 1300)), "usd_close"] = np.nan
    with pytest.raises(ValueError):
        build_gold(spark.createDataFrame(pdf.head(10)), chunk_rows=100)
    s = spark.createDataFrame(pdf)
    a = build_gold(s).toPandas().sort_values(["symbol", "date"]).reset_index(drop=True)
    b = build_gold(s, chunk_rows=400).toPandas().sort_values(["symbol", "date"]).reset_index(drop=True)
    assert len(a) == len(b) == len(pdf)
    for c in a.columns:
        if c in ("symbol", "date"):
            assert (a[c] == b[c]).all()
            continue
        x, y = a[c].astype(float).values, b[c].astype(float).values
        assert (np.isnan(x) == np.isnan(y)).all(), c
        m = ~np.isnan(x)
        np.testing.assert_allclose(y[m], x[m], rtol=1e-10, atol=1e-8, err_msg=c)


def test_averages_over_missing_closes_match_pandas(spark):
    """With ``ema_gaps`` a NULL close re-weights the averages, chunked or not; without it the build fails."""
    from dataclasses import replace
    from series import SILVER_ORDER, synthetic_silver
    from harvestframe.config import Config
    from harvestframe.plans.gold import build_gold
    pdf = synthetic_silver(n=1500, seed=5)[SILVER_ORDER].astype({"close": object})
    pdf.loc[np.random.default_rng(1).random(1500) < 0.1, "close"] = None
    pdf.loc[range(600, 680), "close"] = None
    s = spark.createDataFrame(pdf)
    with pytest.raises(Exception, match="NULL after the first value"):
        build_gold(s).collect()
    cfg = Config()
    cfg = replace(cfg, features=replace(cfg.features, ema_gaps=True))
    close = pdf["close"].astype(float).reset_index(drop=True)
    mean = lambda x, **kw: x.ewm(adjust=False, **kw).mean()
    macd = mean(close, span=12) - mean(close, span=26)
    delta = close.diff()
    up, down = mean(delta.clip(lower=0), com=13), mean(-delta.clip(upper=0), com=13)
    want = {"macd": macd, "macd_signal_line": mean(macd, span=9), "rsi": 100 - 100 / (1 + up / down.replace(0, np.nan))}
    frames = [build_gold(s, cfg, chunk_rows=n).orderBy("date").toPandas() for n in (None, 400)]
    for got in frames:
        for name, exp in want.items():
            np.testing.assert_allclose(got[name].astype(float), exp, rtol=1e-9, atol=1e-9, err_msg=name)
    for c in frames[0].columns.drop(["symbol", "date"]):
        np.testing.assert_allclose(frames[1][c].astype(float), frames[0][c].astype(float), rtol=1e-9, atol=1e-8, err_msg=c)
