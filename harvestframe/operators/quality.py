"""Q1-Q9 quality gate and Q7 Population Stability Index, per series, as aggregations.

Every check is one row ``(symbol, check, passed, value, threshold, hard)``; the
verdict (Q8) is ``bool_and(passed) FILTER (hard)`` per symbol.  Nothing is
collected: the report is a DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestframe.config import Config
from harvestframe.operators.stats import bin_index, corr, counted_values, decile_probs, percentiles_of_counts
from harvestframe.operators.chunking import neighbour, series_positions

KEY = "symbol"
# Tasks per (series, column) that bin values, and the place value of the second of two packed counts.
SALTS, PAIR = 16, 10 ** 14


def _row(check: str, passed, value, threshold, hard: bool):
    return F.struct(F.lit(check).alias("check"), passed.alias("passed"),
                    value.cast("double").alias("value"), threshold.cast("double").alias("threshold"),
                    F.lit(hard).alias("hard"))


def min_rows(cfg: Config) -> int:
    m = cfg.monitoring
    return int(m.lookback_years * 252 * m.min_row_fraction)


def psi_long(gold: DataFrame, columns: Sequence[str], n_bins: int = 10, min_values: int = 20,
             keys: Sequence[str] = (KEY,), order: str = "date") -> DataFrame:
    """Q7: (keys..., column, psi, n_ref, n_cur) for the first vs second half of each series.

    The halves are positional (``n // 2`` over all rows, before dropping NULLs);
    edges are the unique reference deciles; shares divide by the full half
    length; empty bins count 1e-6; columns with fewer than ``min_values`` values
    on either side are left out.
    """
    keys = list(keys)
    base = series_positions(gold.select(*keys, order, *columns), keys, order, pos="__rn", n="__n")
    long = base.unpivot([*keys, "__rn", "__n"], list(columns), "column", "value").where(F.col("value").isNotNull())
    long = long.withColumn("half", F.when(F.col("__rn") < F.floor(F.col("__n") / 2), "ref").otherwise("cur"))
    gk = [*keys, "column"]
    # each value's counts in both halves, as one number: the percentiles and the bins then read one shuffle
    pair = F.sum(F.when(F.col("half") == "ref", F.lit(1)).otherwise(F.lit(PAIR)).cast("decimal(28,0)"))
    values = counted_values(long, gk, "value", pair)
    c_ref, c_cur = (F.col("__c") % PAIR).cast("bigint"), F.expr(f"__c div {PAIR}").cast("bigint")
    edges = percentiles_of_counts(values, gk, decile_probs(n_bins), c_ref, out="edges")
    # salted by value: a column of one long series is binned by many tasks
    edges = edges.select(*gk, F.array_distinct("edges").alias("edges"),
                         F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("__salt"))
    binned = (values.select(*gk, "__v", c_ref.alias("c_ref"), c_cur.alias("c_cur"),
                            F.pmod(F.xxhash64("__v"), F.lit(SALTS)).alias("__salt"))
                    .join(edges, [*gk, "__salt"]).withColumn("bin", bin_index(F.col("edges"), F.col("__v"))))
    counts = [F.sum(F.when(F.col("bin") == i, F.col(c)).otherwise(0)).alias(f"{c}_{i}")
              for c in ("c_ref", "c_cur") for i in range(n_bins)]
    full = (binned.groupBy(*gk).agg(F.sum("c_ref").alias("n_ref"), F.sum("c_cur").alias("n_cur"),
                                    F.max(F.size("edges")).alias("n_edges"), *counts)
                  .where((F.col("n_ref") >= min_values) & (F.col("n_cur") >= min_values)))

    def term(i: int):
        r, c = F.col(f"c_ref_{i}") / F.col("n_ref"), F.col(f"c_cur_{i}") / F.col("n_cur")
        r, c = F.when(r == 0, F.lit(1e-6)).otherwise(r), F.when(c == 0, F.lit(1e-6)).otherwise(c)
        return F.when(F.col("n_edges") > i + 1, (c - r) * F.ln(c / r)).otherwise(F.lit(0.0))

    return full.select(*gk, reduce(lambda a, b: a + b, [term(i) for i in range(n_bins)]).alias("psi"), "n_ref", "n_cur")


CHECKS = ("row_count", "target_nulls", "leakage_check", "date_continuity", "feature_nulls", "distribution_drift",
          "lookahead_check", "overall")
HARD = ("row_count", "target_nulls", "leakage_check")


def quality_report(gold: DataFrame, feature_cols: Sequence[str], cfg: Config = Config(),
                   keys: Sequence[str] = (KEY,), checks: Sequence[str] = CHECKS) -> DataFrame:
    """Q1-Q6, Q9 per series plus the Q8 verdict row; only ``checks`` are computed.

    An input without rows fails: one ``row_count`` row and one ``overall`` row without a series.
    """
    m, f = cfg.monitoring, cfg.features
    keys, checks = list(keys), list(checks)
    wanted = set(checks) | (set(HARD) if "overall" in checks else set())
    mr = min_rows(cfg)
    high_null = [(F.avg(F.col(c).isNull().cast("double")) > m.max_feature_null_rate).cast("int") for c in feature_cols]
    aggs = {"n": F.count(F.lit(1)),
            "target_null": F.avg(F.col("target").isNull().cast("double")) if "target_nulls" in wanted else None,
            "leak_corr": corr("close", "target") if "leakage_check" in wanted else None}
    aggs |= {f"__null_{i}": c for i, c in enumerate(high_null)} if "feature_nulls" in wanted else {}
    s = gold.groupBy(*keys).agg(*[c.alias(k) for k, c in aggs.items() if c is not None])
    if "feature_nulls" in wanted:
        nulls = [F.col(f"__null_{i}") for i in range(len(high_null))]
        s = s.withColumn("n_high_null", sum(nulls, F.lit(0))).drop(*[f"__null_{i}" for i in range(len(high_null))])
    if wanted & {"date_continuity", "lookahead_check"}:
        # the next row's date and return by one positional equi-join of narrow rows (no whole-series window)
        near = series_positions(gold.select(*keys, "date", "log_return_1d"), keys, "date", pos="__pos", n="__len")
        near = neighbour(near, keys, ["date", "log_return_1d"], 1, pos="__pos", suffix="__next")
        if "date_continuity" in wanted:
            gaps = near.groupBy(*keys).agg(F.max(F.datediff("date__next", "date")).alias("max_gap"))
            s = s.join(gaps, keys, "left")
        if "lookahead_check" in wanted:
            # long format: the plan does not grow with the features, and (series, feature) groups aggregate partially
            wide = gold.select(*keys, "date", *[F.col(c).cast("double").alias(c) for c in feature_cols])
            wide = wide.join(near.select(*keys, "date", F.col("log_return_1d__next").alias("__next_lr")), [*keys, "date"]).drop("date")
            per_feature = (wide.unpivot([*keys, "__next_lr"], list(feature_cols), "feature", "value")
                           .groupBy(*keys, "feature").agg(F.abs(corr("value", "__next_lr")).alias("la")))
            s = s.join(per_feature.groupBy(*keys).agg(F.max("la").alias("max_la")), keys, "left")
    if "distribution_drift" in wanted:
        psi = psi_long(gold, [c for c in m.psi_columns if c in gold.columns], m.psi_bins, m.psi_min_values, keys)
        drift = psi.groupBy(*keys).agg(F.count_if(F.col("psi") > m.psi_critical).alias("n_drift"))
        s = s.join(drift, keys, "left").fillna(0, ["n_drift"])
    c, allowed_null = F.col, F.lit(3.0 * f.target_horizon_days) / F.col("n")
    rules = {  # passed, value, threshold
        "row_count": lambda: (c("n") >= mr, c("n"), F.lit(float(mr))),
        # reported as percentages (2 decimals) and the correlation to 4 decimals;
        # the decisions use the unrounded values
        "target_nulls": lambda: (c("target_null") <= allowed_null, F.round(c("target_null") * 100, 2), F.round(allowed_null * 100, 2)),
        "leakage_check": lambda: (F.coalesce(F.abs(c("leak_corr")) < m.leakage_max_corr, F.lit(False)), F.round(c("leak_corr"), 4),
                                  F.lit(m.leakage_max_corr)),
        "date_continuity": lambda: (F.coalesce(c("max_gap") <= m.max_gap_days, F.lit(True)), c("max_gap"), F.lit(float(m.max_gap_days))),
        "feature_nulls": lambda: (c("n_high_null") == 0, c("n_high_null"), F.lit(0.0)),
        "distribution_drift": lambda: (c("n_drift") == 0, c("n_drift"), F.lit(m.psi_critical)),
        "lookahead_check": lambda: (F.coalesce(c("max_la") < m.lookahead_max_corr, F.lit(True)), c("max_la"), F.lit(m.lookahead_max_corr)),
    }
    rows = [_row(k, *rules[k](), k in HARD) for k in checks if k in rules]
    if "overall" in checks:
        verdict = reduce(lambda a, b: a & b, [rules[k]()[0] for k in HARD])
        rows.append(_row("overall", F.coalesce(verdict, F.lit(False)), F.lit(None), F.lit(None), True))
    # One aggregate row per series -> one exploded row per check; nothing is recomputed.
    report = s.select(*keys, F.explode(F.array(*rows)).alias("x")).select(*keys, "x.*")
    failing = [k for k in ("row_count", "overall") if k in checks]
    if not failing:
        return report
    none = gold.agg(F.count(F.lit(1)).alias("__n")).where("__n = 0")
    empty = F.array(*[_row(k, F.lit(False), F.lit(0.0 if k == "row_count" else None), F.lit(float(mr) if k == "row_count" else None), True) for k in failing])
    return report.unionByName(none.select(F.explode(empty).alias("x")).select(
        *[F.lit(None).cast(report.schema[k].dataType).alias(k) for k in keys], "x.*"))
