"""More DuckDB oracle fragments (windows, joins, stats, quality, model data)."""

from __future__ import annotations

from harvestframe.checks.sql import lit

HOURLY = """
ev AS (SELECT event_id, ts, event_type, value FROM events),
hb AS (
  SELECT event_type AS symbol, date_trunc('hour', ts) AS ts,
         arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, (ts, event_id)) AS close, CAST(count(*) AS DOUBLE) AS volume
  FROM ev GROUP BY 1, 2)"""


def gap_ema_sql(spans=(5, 60), com=13) -> str:
    """Averages over every hour row by row, with the hours since the last value as state."""
    last = {f"e{s}": ("close", 2.0 / (s + 1.0), "gap") for s in spans} | {"up": ("rise", 1.0 / (com + 1.0), "rgap")}
    step = ", ".join(
        f"CASE WHEN g.{x} IS NULL THEN e.{out} WHEN e.{out} IS NULL THEN g.{x} "
        f"ELSE (pow({lit(1 - a)}, e.{n}) * e.{out} + {lit(a)} * g.{x}) / (pow({lit(1 - a)}, e.{n}) + {lit(a)}) END AS {out}"
        for out, (x, a, n) in last.items())
    return HOURLY + f""",
hours AS (SELECT symbol, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM hb GROUP BY symbol),
h0 AS (SELECT hours.symbol, hours.ts, hb.close, CASE WHEN hb.close > hb.open THEN hb.close - hb.open END AS rise,
              row_number() OVER (PARTITION BY hours.symbol ORDER BY hours.ts) AS rn
       FROM hours LEFT JOIN hb ON hb.symbol = hours.symbol AND hb.ts = hours.ts),
hg AS (
  SELECT symbol, rn, ts, {", ".join(f"{x} AS {out}" for out, (x, _, _) in last.items())}, 1 AS gap, 1 AS rgap FROM h0 WHERE rn = 1
  UNION ALL
  SELECT g.symbol, g.rn, g.ts, {step},
         CASE WHEN g.close IS NULL THEN e.gap + 1 ELSE 1 END, CASE WHEN g.rise IS NULL THEN e.rgap + 1 ELSE 1 END
  FROM hg e JOIN h0 g ON g.symbol = e.symbol AND g.rn = e.rn + 1)"""


def hourly_ema_sql(spans=(5, 60), com=13) -> str:
    a = [2.0 / (s + 1.0) for s in spans]
    ar = 1.0 / (com + 1.0)
    init = ", ".join(f"close AS e{s}" for s in spans)
    nxt = ", ".join(f"{lit(1 - x)} * e.e{s} + {lit(x)} * g.close AS e{s}" for s, x in zip(spans, a))
    return HOURLY + f""",
h0 AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS rn,
              (CASE WHEN close - lag(close) OVER (PARTITION BY symbol ORDER BY ts) IS NOT NULL
                    THEN greatest(close - lag(close) OVER (PARTITION BY symbol ORDER BY ts), {lit(0)}) END) AS gain
       FROM hb),
he AS (
  SELECT symbol, rn, ts, {init}, CAST(NULL AS DOUBLE) AS up FROM h0 WHERE rn = 1
  UNION ALL
  SELECT g.symbol, g.rn, g.ts, {nxt},
         CASE WHEN e.up IS NULL THEN g.gain ELSE {lit(1 - ar)} * e.up + {lit(ar)} * g.gain END
  FROM he e JOIN h0 g ON g.symbol = e.symbol AND g.rn = e.rn + 1)"""
