"""DuckDB SQL for the silver and gold builds over the driver tables.

Written independently from the Spark plans (plain SQL windows and a recursive
CTE for the EMA recurrence), so a match is evidence for both.
"""

from __future__ import annotations

import math

from harvestframe.config import Config
from harvestframe.functions.numeric import GRID_SHIFT

CFG = Config()


def lit(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def sround(e: str, digits: int = 8, max_decimals: int = 6) -> str:
    """Same arithmetic as ``functions.numeric.sround``."""
    phi = lit(GRID_SHIFT)
    d = f"least({max_decimals}, {digits - 1} - CAST(floor(log10(abs({e}))) AS BIGINT))"
    return (f"(CASE WHEN ({e}) IS NULL THEN NULL WHEN ({e}) = 0 THEN CAST(0.0 AS DOUBLE) "
            f"WHEN {d} >= 0 THEN (round(({e}) * pow(10.0, {d}) + {phi}, 0) - {phi}) / pow(10.0, {d}) "
            f"ELSE (round(({e}) / pow(10.0, -({d})) + {phi}, 0) - {phi}) * pow(10.0, -({d})) END)")


def div(a: str, b: str) -> str:
    return f"(({a}) / nullif(({b}), 0))"


def ln_pos(e: str) -> str:
    return f"(CASE WHEN ({e}) > 0 THEN ln({e}) END)"


def clip_lower(e: str, lo: float = 0.0) -> str:
    return f"(CASE WHEN ({e}) IS NOT NULL THEN greatest(({e}), {lit(lo)}) END)"


def w_rows(n: int, part: str = "symbol", order: str = "date") -> str:
    return f"(PARTITION BY {part} ORDER BY {order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


W = "(PARTITION BY symbol ORDER BY date)"
W_RUN = "(PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def rmean(x: str, n: int, mp: int | None = None) -> str:
    mp = n if mp is None else mp
    return f"(CASE WHEN count({x}) OVER {w_rows(n)} >= {mp} THEN avg({x}) OVER {w_rows(n)} END)"


def rsum(x: str, n: int, mp: int | None = None) -> str:
    mp = n if mp is None else mp
    return f"(CASE WHEN count({x}) OVER {w_rows(n)} >= {mp} THEN sum(CAST({x} AS DOUBLE)) OVER {w_rows(n)} END)"


def rstd(x: str, n: int, mp: int | None = None) -> str:
    mp = n if mp is None else mp
    return f"(CASE WHEN count({x}) OVER {w_rows(n)} >= {mp} THEN stddev_samp({x}) OVER {w_rows(n)} END)"


def rcorr(x: str, y: str, n: int) -> str:
    xm = f"(CASE WHEN {y} IS NOT NULL THEN {x} END)"
    ym = f"(CASE WHEN {x} IS NOT NULL THEN {y} END)"
    fr = w_rows(n)
    return (f"(CASE WHEN count({xm}) OVER {fr} >= {n} THEN "
            f"{div(f'covar_samp({xm}, {ym}) OVER {fr}', f'(stddev_samp({xm}) OVER {fr}) * (stddev_samp({ym}) OVER {fr})')} END)")


def views_sql(gap: tuple[int, int] | None = None) -> str:
    """bars and weather_long over the driver tables (FIXTURES.md views); ``gap`` leaves out days of the month."""
    where = f"WHERE day(l.l_shipdate) NOT BETWEEN {gap[0]} AND {gap[1]}" if gap else ""
    return f"""
bars AS (
  SELECT c.c_mktsegment AS symbol, CAST(o.o_orderdate AS DATE) AS date,
         arg_min(o.o_totalprice, o.o_orderkey) AS open, max(o.o_totalprice) AS high,
         min(o.o_totalprice) AS low, arg_max(o.o_totalprice, o.o_orderkey) AS close,
         CAST(count(*) AS DOUBLE) * {lit(1000)} AS volume
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2),
wx AS (
  SELECT CAST(l.l_shipdate AS DATE) AS date, r.r_name AS region,
         {lit(50)} + max(l.l_quantity) AS TMAX, {lit(30)} + min(l.l_quantity) AS TMIN,
         sum(l.l_discount) AS PRCP, sum(l.l_tax) AS SNOW
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  {where}
  GROUP BY 1, 2),
weather_long AS (
  SELECT strftime(date, '%Y-%m-%d') AS date, region, 'TMAX' AS datatype, TMAX AS value FROM wx UNION ALL
  SELECT strftime(date, '%Y-%m-%d'), region, 'TMIN', TMIN FROM wx UNION ALL
  SELECT strftime(date, '%Y-%m-%d'), region, 'PRCP', PRCP FROM wx UNION ALL
  SELECT strftime(date, '%Y-%m-%d'), region, 'SNOW', SNOW FROM wx)"""


def silver_sql(cfg: Config = CFG, min_volume: float | None = None, views: str | None = None) -> str:
    """WITH-list text ending in a ``silver`` CTE, over ``views`` that define bars and weather_long."""
    t = cfg.transforms
    mv = t.min_daily_volume if min_volume is None else min_volume
    k = t.asof_tolerance_days
    corr_cols = ",\n         ".join(
        f"max(CASE WHEN symbol = '{sym}' THEN close END) AS {lab}_close" for lab, sym in cfg.correlated)
    syms = ", ".join(f"'{s}'" for _, s in cfg.correlated)
    spine = "" if not cfg.spine_symbols else "AND symbol IN (" + ", ".join(f"'{s}'" for s in cfg.spine_symbols) + ")"
    return (views or views_sql()) + f""",
wpiv AS (
  SELECT CAST(date AS DATE) AS date, region,
         min(value) FILTER (WHERE datatype = 'TMAX') AS tmax_f,
         min(value) FILTER (WHERE datatype = 'TMIN') AS tmin_f,
         min(value) FILTER (WHERE datatype = 'PRCP') AS prcp_in,
         min(value) FILTER (WHERE datatype = 'SNOW') * {lit(t.snow_in_to_mm)} AS snow_mm
  FROM weather_long WHERE value IS NOT NULL AND NOT isnan(value)
  GROUP BY 1, 2),
wday AS (
  SELECT date, avg(tmax_f) AS tmax_f, avg(tmin_f) AS tmin_f, avg(prcp_in) AS prcp_in, avg(snow_mm) AS snow_mm
  FROM wpiv GROUP BY date),
fut0 AS (SELECT * FROM bars WHERE volume >= {lit(mv)} {spine}),
fut AS (
  SELECT symbol, date, open, high, low, close, volume,
         {div('close', 'lag(close) OVER ' + W)} - 1 AS returns_1d,
         {ln_pos(div('close', 'lag(close) OVER ' + W))} AS log_return_1d,
         {div('high - low', 'close')} AS high_low_pct
  FROM fut0),
sd AS (SELECT DISTINCT date FROM fut),
cand AS (
  SELECT sd.date AS sdate, wd.tmax_f, wd.tmin_f, wd.prcp_in, wd.snow_mm,
         datediff('day', sd.date, wd.date) AS off
  FROM sd JOIN wday wd ON wd.date BETWEEN sd.date - {k} AND sd.date + {k}),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sdate ORDER BY abs(off), off) AS rk FROM cand)
  WHERE rk = 1),
corr AS (
  SELECT date,
         {corr_cols}
  FROM bars WHERE symbol IN ({syms}) GROUP BY date),
silver AS (
  SELECT f.symbol, f.date, f.open, f.high, f.low, f.close, f.volume, f.returns_1d, f.log_return_1d,
         f.high_low_pct, b.tmax_f, b.tmin_f, b.prcp_in, b.snow_mm,
         {", ".join(f"c.{lab}_close" for lab, _ in cfg.correlated)},
         isodow(f.date) - 1 AS day_of_week, month(f.date) AS month
  FROM fut f LEFT JOIN best b ON b.sdate = f.date LEFT JOIN corr c ON c.date = f.date)"""


def _alpha_span(s: float) -> float:
    return 2.0 / (s + 1.0)


def gold_sql(cfg: Config = CFG, min_volume: float | None = None) -> str:
    """WITH-list text ending in a ``gold`` CTE (all gold columns)."""
    f = cfg.features
    spans = sorted(set(f.rolling_windows) | {f.macd_fast, f.macd_slow})
    ar = 1.0 / f.rsi_period  # com = period - 1
    a9 = _alpha_span(f.macd_signal)

    def step(prev: str, x: str, a: float) -> str:
        return f"{lit(1 - a)} * {prev} + {lit(a)} * {x}"

    ema_init = ", ".join(f"close AS e{s}" for s in spans)
    ema_next = ", ".join(f"{step(f'e.e{s}', 'g.close', _alpha_span(s))} AS e{s}" for s in spans)
    fast_next = step(f"e.e{f.macd_fast}", "g.close", _alpha_span(f.macd_fast))
    slow_next = step(f"e.e{f.macd_slow}", "g.close", _alpha_span(f.macd_slow))
    L, mp = f.long_window, f.long_min_periods
    rw = f.rolling_windows
    s = silver_sql(cfg, min_volume) + f""",
g0 AS (
  SELECT *, row_number() OVER {W} AS rn, lag(close) OVER {W} AS close_lag1,
         close - lag(close) OVER {W} AS delta,
         last_value(close IGNORE NULLS) OVER {W_RUN} AS close_pad
  FROM silver),
g1 AS (
  SELECT *, {clip_lower('delta')} AS gain,
         -(CASE WHEN delta IS NOT NULL THEN least(delta, {lit(0)}) END) AS loss
  FROM g0),
ema AS (
  SELECT symbol, rn, {ema_init}, CAST(NULL AS DOUBLE) AS up, CAST(NULL AS DOUBLE) AS dn,
         CAST(0.0 AS DOUBLE) AS sig
  FROM g1 WHERE rn = 1
  UNION ALL
  SELECT g.symbol, g.rn, {ema_next},
         CASE WHEN e.up IS NULL THEN g.gain ELSE {step('e.up', 'g.gain', ar)} END,
         CASE WHEN e.dn IS NULL THEN g.loss ELSE {step('e.dn', 'g.loss', ar)} END,
         {step('e.sig', f'(({fast_next}) - ({slow_next}))', a9)}
  FROM ema e JOIN g1 g ON g.symbol = e.symbol AND g.rn = e.rn + 1),
g2 AS (
  SELECT g.*, {", ".join(f"e.e{s}" for s in spans)}, e.up, e.dn, e.sig AS macd_signal_line,
         e.e{f.macd_fast} - e.e{f.macd_slow} AS macd,
         greatest(g.high - g.low, abs(g.high - g.close_lag1), abs(g.low - g.close_lag1)) AS tr,
         sum(coalesce(sign(g.delta) * g.volume, {lit(0)})) OVER (PARTITION BY g.symbol ORDER BY g.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS obv,
         {ln_pos(div('g.crude_close', 'lag(g.crude_close) OVER (PARTITION BY g.symbol ORDER BY g.date)'))} AS crude_lr,
         {ln_pos(div('g.usd_close', 'lag(g.usd_close) OVER (PARTITION BY g.symbol ORDER BY g.date)'))} AS usd_lr,
         last_value(g.usd_close IGNORE NULLS) OVER (PARTITION BY g.symbol ORDER BY g.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS usd_pad,
         {clip_lower(f'(g.tmax_f + g.tmin_f) / {lit(2)} - {lit(f.gdd_base_temp_f)}')} AS gdd_daily,
         coalesce(CAST(g.tmax_f > {lit(f.gdd_heat_stress_f)} AS INTEGER), 0) AS heat_stress_flag
  FROM g1 g JOIN ema e ON e.symbol = g.symbol AND e.rn = g.rn),
g3 AS (
  SELECT *,
         {", ".join(f"{div('close_pad', f'lag(close_pad, {w}) OVER {W}')} - 1 AS return_{w}d" for w in rw)},
         {", ".join(f"{rmean('close', w)} AS sma_{w}" for w in rw)},
         {", ".join(f"e{w} AS ema_{w}" for w in rw)},
         {div('high - low', 'close')} AS high_low_range,
         {div('open - close_lag1', 'close_lag1')} AS overnight_gap,
         {div('volume', rmean('volume', 20))} AS volume_ratio_20,
         100 - 100 / (1 + {div('up', 'nullif(dn, 0)')}) AS rsi,
         macd - macd_signal_line AS macd_hist,
         {rmean('close', f.bb_period)} AS bb_mid,
         {rstd('close', f.bb_period)} AS bb_std,
         {rmean('tr', f.atr_period)} AS atr,
         {rmean('obv', 20)} AS obv_sma20,
         {", ".join(f"{rstd('log_return_1d', w)} * {lit(math.sqrt(252))} AS rvol_{w}d" for w in f.rvol_windows)},
         ({rstd(ln_pos(div('high', 'low')), 20)} / {lit(2.0 * math.sqrt(math.log(2.0)))}) * {lit(math.sqrt(252))} AS parkinson_vol,
         CASE WHEN gdd_daily IS NOT NULL THEN sum(gdd_daily) OVER (PARTITION BY symbol, year(date) ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS gdd_cumulative,
         {", ".join(f"{rsum('heat_stress_flag', w, 1)} AS heat_stress_{w}d" for w in f.heat_windows)},
         {div(f"prcp_in - {rmean('prcp_in', L, mp)}", f"nullif({rstd('prcp_in', L, mp)}, 0)")} AS prcp_zscore,
         {", ".join(f"{rsum('prcp_in', w, 1)} AS prcp_sum_{w}d" for w in f.prcp_sum_windows)},
         {rmean('tmax_f', 7)} AS tmax_7d_avg,
         tmax_f - {rmean('tmax_f', L, mp)} AS tmax_anomaly_30d,
         {div('close', 'nullif(wheat_close, 0)')} AS corn_wheat_ratio,
         close - wheat_close AS corn_wheat_spread,
         {rcorr('log_return_1d', 'crude_lr', f.corr_window)} AS corn_crude_corr_20d,
         {div('usd_pad', f'lag(usd_pad, 5) OVER {W}')} - 1 AS usd_return_5d,
         {rcorr('log_return_1d', 'usd_lr', f.corr_window)} AS corn_usd_corr_20d,
         ({div(f'lead(close, {f.target_horizon_days}) OVER {W}', 'close')} - 1) * 100 AS target,
         {f.target_horizon_days} AS target_horizon
  FROM g2),
g4 AS (
  SELECT *,
         {", ".join(f"{div('close', f'sma_{w}')} - 1 AS price_to_sma_{w}" for w in rw)},
         bb_mid + 2 * bb_std AS bb_upper, bb_mid - 2 * bb_std AS bb_lower,
         {div('atr', 'close')} AS atr_pct,
         {div('obv', 'nullif(obv_sma20, 0)')} AS obv_ratio,
         coalesce(CAST(rvol_20d > {rmean('rvol_20d', 60)} AS INTEGER), 0) AS vol_regime,
         sin({lit(2 * math.pi)} * month(date) / {lit(12)}) AS month_sin,
         cos({lit(2 * math.pi)} * month(date) / {lit(12)}) AS month_cos,
         sin({lit(2 * math.pi)} * dayofyear(date) / {lit(365)}) AS doy_sin,
         cos({lit(2 * math.pi)} * dayofyear(date) / {lit(365)}) AS doy_cos,
         sin({lit(2 * math.pi)} * week(date) / {lit(52)}) AS week_sin,
         cos({lit(2 * math.pi)} * week(date) / {lit(52)}) AS week_cos,
         CAST(month(date) IN (4, 5) AS INTEGER) AS is_planting,
         CAST(month(date) IN (7) AS INTEGER) AS is_pollination,
         CAST(month(date) IN (9, 10, 11) AS INTEGER) AS is_harvest,
         CAST(month(date) BETWEEN 4 AND 10 AS INTEGER) AS is_growing_season,
         abs(10 - day(date)) AS days_to_wasde,
         CAST(abs(10 - day(date)) <= 3 AS INTEGER) AS wasde_week,
         CAST(isodow(date) = 1 AS INTEGER) AS is_monday
  FROM g3),
gold AS (
  SELECT *, {div('close - bb_lower', 'nullif(bb_upper - bb_lower, 0)')} AS bb_pct_b,
         {div('bb_upper - bb_lower', 'bb_mid')} AS bb_bandwidth
  FROM g4)"""
    return s
