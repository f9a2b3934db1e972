"""Registered queries: contracts V1-V5, quality Q1-Q9."""

from __future__ import annotations

from pyspark.sql import functions as F

from harvestframe.checks import sql as S
from harvestframe.config import Config
from harvestframe.operators import contracts as V
from harvestframe.operators.quality import CHECKS, min_rows, psi_long, quality_report
from harvestframe.plans.gold import feature_columns, feature_names
from harvestframe.queries_core import gold, gold_table, silver
from harvestframe.registry import CFG, kinds_for, register
from harvestframe.sources import tables as T

SIL, GOLD = S.silver_sql(), S.gold_sql()
FEATS = feature_names(CFG)
REP = ["rule", "column", "failures", "passed"]
REP_KINDS = kinds_for(REP, ints=("failures",), bools=("passed",))


def _rule_sql(table: str, rules: list[tuple[str, str, str]], required: list[tuple[str, str]] = ()) -> str:
    """rules: (name, column, SQL failure-count aggregate)."""
    parts = [f"SELECT '{n}' AS rule, '{c}' AS \"column\", CAST({agg} AS BIGINT) AS failures FROM {table}" for n, c, agg in rules]
    parts += [f"SELECT '{c}_present' AS rule, '{c}' AS \"column\", CAST(1 AS BIGINT) AS failures" for c, _ in required]
    return "SELECT *, failures = 0 AS passed FROM (" + " UNION ALL ".join(parts) + ")"


def bad(pred: str) -> str:
    return f"count(*) FILTER (WHERE NOT coalesce({pred}, false))"


def nn(c):
    return (f"{c}_not_null", c, bad(f"{c} IS NOT NULL"))


def gt(c, v, nullable=False):
    p = f"{c} > {v}"
    return (f"{c}_gt_{v:g}", c, bad(f"({c} IS NULL OR {p})" if nullable else p))


def ge(c, v, nullable=False):
    p = f"{c} >= {v}"
    return (f"{c}_ge_{v:g}", c, bad(f"({c} IS NULL OR {p})" if nullable else p))


def cge(a, b):
    return (f"{a}_ge_{b}", a, bad(f"{a} >= {b}"))


def uniq(keys):
    return ("unique_" + "_".join(keys), ",".join(keys), f"count(*) - count(DISTINCT ({', '.join(keys)}))")


def share(c, s):
    return (f"{c}_non_null_ge_{s:g}", c, f"CASE WHEN avg(CASE WHEN {c} IS NOT NULL THEN 1.0 ELSE 0.0 END) < {s} THEN 1 ELSE 0 END")


NON_EMPTY = ("non_empty", "*", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END")


def bronze_weather(spark, sf):
    from harvestframe.sources.landed import tag_weather
    return tag_weather(T.weather_long(spark, sf), T.stations(spark, sf))


@register("v2_bronze_weather_contract", S.views_sql() + """,
bw AS (SELECT w.*, format('ST{:05d}', r.r_regionkey) AS station_id FROM weather_long w LEFT JOIN region r ON r.r_name = w.region)""",
          _rule_sql("bw", [nn("date"), nn("datatype"),
                           ("datatype_in_set", "datatype", bad("datatype IN ('TMAX', 'TMIN', 'PRCP', 'SNOW')")),
                           nn("station_id"), nn("region"), NON_EMPTY]), REP_KINDS)
def v2_bronze_weather_contract(spark, sf):
    """V2: bronze weather contract report (one aggregation pass)."""
    return V.report(bronze_weather(spark, sf), V.bronze_weather_rules())


# The reference's instrument tickers and labels, mapped onto the driver's segments.
INSTRUMENTS = [("BUILDING", "ZC=F", "corn"), ("AUTOMOBILE", "ZW=F", "wheat"), ("FURNITURE", "CL=F", "crude"),
               ("HOUSEHOLD", "DX-Y.NYB", "usd")]
INST = ", ".join(f"('{s}', '{t}', '{lab}')" for s, t, lab in INSTRUMENTS)


def bronze_futures(spark, sf):
    from harvestframe.sources.landed import tag_bars
    inst = spark.createDataFrame(INSTRUMENTS, "symbol string, ticker string, label string")
    return tag_bars(T.bars(spark, sf), inst)


@register("v3_bronze_futures_contract", S.views_sql() + f""",
inst(symbol, ticker, label) AS (VALUES {INST}),
bf AS (SELECT b.*, i.ticker, i.label FROM bars b LEFT JOIN inst i USING (symbol))""",
          _rule_sql("bf", [nn("date"), gt("open", 0), gt("high", 0), gt("low", 0), gt("close", 0), ge("volume", 0),
                           nn("ticker"), nn("label"), cge("high", "low"), cge("high", "open")]), REP_KINDS)
def v3_bronze_futures_contract(spark, sf):
    """V3: bronze futures contract report (MACHINERY has no instrument: ticker/label failures)."""
    return V.report(bronze_futures(spark, sf), V.bronze_futures_rules())


@register("v4_silver_contract", SIL,
          _rule_sql("silver", [nn("date"), ("day_of_week_in_set", "day_of_week", bad("day_of_week IN (0, 1, 2, 3, 4, 5, 6)")),
                               gt("open", 0), gt("high", 0), gt("low", 0), gt("close", 0), ge("volume", 0),
                               ge("prcp_in", 0, True), uniq(["symbol", "date"]), cge("high", "low"),
                               share("close", 0.95)]), REP_KINDS)
def v4_silver_contract(spark, sf):
    """V4: silver contract report."""
    return V.report(silver(spark, sf), V.silver_rules(), V.SILVER_REQUIRED)


@register("v5_gold_contract", GOLD,
          _rule_sql("gold", [nn("date"), gt("close", 0),
                             ("rsi_in_0_100", "rsi", bad("(rsi IS NULL OR rsi BETWEEN 0 AND 100)")),
                             ge("gdd_cumulative", 0, True), uniq(["symbol", "date"]), share("target", 0.8)]), REP_KINDS)
def v5_gold_contract(spark, sf):
    """V5: gold contract report."""
    return V.report(gold(spark, sf), V.gold_rules(), V.GOLD_REQUIRED)


@register("v1_validate_bad_rows", SIL + """,
badsilver AS (SELECT * REPLACE (CASE WHEN day(date) = 5 THEN -10.0 ELSE close END AS close,
                                CASE WHEN day(date) = 10 THEN low - 5 ELSE high END AS high) FROM silver
              UNION ALL SELECT * FROM silver WHERE day(date) = 1)""",
          _rule_sql("badsilver", [nn("date"), ("day_of_week_in_set", "day_of_week", bad("day_of_week IN (0, 1, 2, 3, 4, 5, 6)")),
                                  gt("open", 0), gt("high", 0), gt("low", 0), gt("close", 0), ge("volume", 0),
                                  ge("prcp_in", 0, True), uniq(["symbol", "date"]), cge("high", "low"),
                                  share("close", 0.95)]), REP_KINDS)
def v1_validate_bad_rows(spark, sf):
    """V1: lazy validation collects every failure: negative closes (5th of each month), high < low
    (10th), duplicated days (1st) injected into silver; all three rules report."""
    s = silver(spark, sf)
    d = F.dayofmonth("date")
    bad_rows = s.withColumns({"close": F.when(d == 5, F.lit(-10.0)).otherwise(F.col("close")),
                              "high": F.when(d == 10, F.col("low") - 5).otherwise(F.col("high"))})
    return V.report(bad_rows.unionByName(s.where(d == 1)), V.silver_rules(), V.SILVER_REQUIRED)


# ---------------------------------------------------------------- Q
def quality_sql(cfg: Config = CFG) -> str:
    m, f = cfg.monitoring, cfg.features
    h = f.target_horizon_days
    dec = "[" + ", ".join(repr(i / m.psi_bins) for i in range(m.psi_bins + 1)) + "]"
    pcols = ", ".join(m.psi_columns)
    la = ", ".join(f"abs({_corr('g.' + c, 'g.next_lr')})" for c in FEATS)
    nr = " + ".join(f"CAST(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) > {m.max_feature_null_rate} AS INTEGER)" for c in FEATS)
    return GOLD + f""",
pbase AS (SELECT symbol, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS rn,
                 count(*) OVER (PARTITION BY symbol) AS n, {pcols} FROM gold),
plong AS (SELECT symbol, rn, n, feature, value FROM (UNPIVOT pbase ON {pcols} INTO NAME feature VALUE value) WHERE value IS NOT NULL),
phalf AS (SELECT *, CASE WHEN rn < n // 2 THEN 'ref' ELSE 'cur' END AS half FROM plong),
psizes AS (SELECT symbol, feature, count(*) FILTER (WHERE half = 'ref') AS n_ref, count(*) FILTER (WHERE half = 'cur') AS n_cur
           FROM phalf GROUP BY symbol, feature),
pedges AS (SELECT symbol, feature, list_sort(list_distinct(quantile_cont(value, {dec}))) AS edges FROM phalf WHERE half = 'ref'
           GROUP BY symbol, feature),
pbin AS (SELECT p.symbol, p.feature, p.half,
                CASE WHEN p.value < e.edges[1] OR p.value > e.edges[len(e.edges)] THEN NULL
                     WHEN p.value = e.edges[len(e.edges)] THEN len(e.edges) - 2
                     ELSE len(list_filter(e.edges, lambda x: x <= p.value)) - 1 END AS bin
         FROM phalf p JOIN pedges e USING (symbol, feature)),
pcnt AS (SELECT symbol, feature, bin, count(*) FILTER (WHERE half = 'ref') AS c_ref, count(*) FILTER (WHERE half = 'cur') AS c_cur
         FROM pbin WHERE bin IS NOT NULL GROUP BY symbol, feature, bin),
pgrid AS (SELECT e.symbol, e.feature, s.n_ref, s.n_cur, len(e.edges) AS n_edges,
                 unnest(range(0, greatest(len(e.edges) - 1, 1))) AS bin
          FROM pedges e JOIN psizes s USING (symbol, feature) WHERE s.n_ref >= {m.psi_min_values} AND s.n_cur >= {m.psi_min_values}),
pfull AS (SELECT g.*, coalesce(c.c_ref, 0) AS c_ref, coalesce(c.c_cur, 0) AS c_cur
          FROM pgrid g LEFT JOIN pcnt c USING (symbol, feature, bin)),
pshare AS (SELECT *, CASE WHEN c_ref / n_ref = 0 THEN 1e-6 ELSE c_ref / n_ref END AS r,
                  CASE WHEN c_cur / n_cur = 0 THEN 1e-6 ELSE c_cur / n_cur END AS c FROM pfull),
psi AS (SELECT symbol, feature, CASE WHEN n_edges < 2 THEN 0.0 ELSE sum((c - r) * ln(c / r)) END AS psi, n_ref, n_cur
        FROM pshare GROUP BY symbol, feature, n_ref, n_cur, n_edges),
gq AS (SELECT *, datediff('day', lag(date) OVER (PARTITION BY symbol ORDER BY date), date) AS gap,
              lead(log_return_1d) OVER (PARTITION BY symbol ORDER BY date) AS next_lr FROM gold),
qs AS (SELECT g.symbol, count(*) AS n, avg(CASE WHEN g.target IS NULL THEN 1.0 ELSE 0.0 END) AS target_null,
              {_corr('g.close', 'g.target')} AS leak_corr, max(g.gap) AS max_gap, ({nr}) AS n_high_null,
              greatest({la}) AS max_la
       FROM gq g GROUP BY g.symbol),
qd AS (SELECT qs.*, coalesce((SELECT count(*) FROM psi WHERE psi.symbol = qs.symbol AND psi.psi > {m.psi_critical}), 0) AS n_drift FROM qs),
qrep AS (
  SELECT symbol, 'row_count' AS "check", n >= {min_rows(cfg)} AS passed, CAST(n AS DOUBLE) AS value, {min_rows(cfg)}.0 AS threshold, true AS hard FROM qd UNION ALL
  SELECT symbol, 'target_nulls', target_null <= {3.0 * h} / n, round(target_null * 100, 2), round({3.0 * h} / n * 100, 2), true FROM qd UNION ALL
  SELECT symbol, 'leakage_check', coalesce(abs(leak_corr) < {m.leakage_max_corr}, false), round(leak_corr, 4), {m.leakage_max_corr}, true FROM qd UNION ALL
  SELECT symbol, 'date_continuity', coalesce(max_gap <= {m.max_gap_days}, true), max_gap, {m.max_gap_days}, false FROM qd UNION ALL
  SELECT symbol, 'feature_nulls', n_high_null = 0, n_high_null, 0, false FROM qd UNION ALL
  SELECT symbol, 'distribution_drift', n_drift = 0, n_drift, {m.psi_critical}, false FROM qd UNION ALL
  SELECT symbol, 'lookahead_check', coalesce(max_la < {m.lookahead_max_corr}, true), max_la, {m.lookahead_max_corr}, false FROM qd),
qall AS (
  SELECT * FROM qrep UNION ALL
  SELECT symbol, 'overall', coalesce(bool_and(passed) FILTER (WHERE hard), false), NULL, NULL, true FROM qrep GROUP BY symbol)"""


def _corr(x, y):
    xm = f"(CASE WHEN {y} IS NOT NULL THEN {x} END)"
    ym = f"(CASE WHEN {x} IS NOT NULL THEN {y} END)"
    return S.div(f"covar_samp({xm}, {ym})", f"stddev_samp({xm}) * stddev_samp({ym})")


QSQL = quality_sql()
QCOLS = ["symbol", "check", "passed", "value", "threshold", "hard"]
QKINDS = kinds_for(QCOLS, bools=("passed", "hard"))


def report(spark, sf, checks=CHECKS):
    g = gold_table(spark, sf)
    return quality_report(g, feature_columns(g), CFG, checks=checks)


def _q(name, check, doc):
    @register(name, QSQL, f"SELECT * FROM qall WHERE \"check\" = '{check}'", QKINDS)
    def q(spark, sf):
        return report(spark, sf, [check])
    q.__doc__ = doc
    return q


_q("q1_row_count", "row_count", "Q1: row count >= lookback_years * 252 * min_row_fraction (hard).")
_q("q2_target_nulls", "target_nulls", "Q2: target null rate <= 3 * horizon / n (hard).")
_q("q3_leakage", "leakage_check", "Q3: |corr(close, target)| < 0.9; NULL fails (hard).")
_q("q4_date_gap", "date_continuity", "Q4: max gap between rows <= 5 days (soft).")
_q("q5_feature_nulls", "feature_nulls", "Q5: number of features with > 10 % NULLs (soft).")
_q("q6_drift", "distribution_drift", "Q6: number of PSI columns above 0.20 (soft).")
_q("q9_lookahead", "lookahead_check", "Q9: max |corr(feature, next-day log return)| < 0.95 (soft).")


@register("q7_psi", QSQL, "SELECT * FROM psi", kinds_for(["symbol", "feature", "psi", "n_ref", "n_cur"], ints=("n_ref", "n_cur")))
def q7_psi(spark, sf):
    """Q7: PSI of rsi, rvol_20d, gdd_cumulative, close: first vs second half of each series."""
    m = CFG.monitoring
    p = psi_long(gold_table(spark, sf), list(m.psi_columns), m.psi_bins, m.psi_min_values)
    return p.withColumnRenamed("column", "feature")


@register("q8_verdict", QSQL, "SELECT * FROM qall", QKINDS)
def q8_verdict(spark, sf):
    """Q8: every check row plus the overall verdict per symbol."""
    return report(spark, sf)
