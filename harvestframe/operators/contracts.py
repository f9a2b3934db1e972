"""V1-V5 data contracts compiled into one aggregation pass.

A contract is a list of rules.  Row rules are predicates that must hold on
every row (``count_if(NOT rule)`` failures); table rules are aggregate
predicates (uniqueness, non-null share, non-empty).  All rules of a contract
are evaluated in a single ``agg`` - one scan, partial aggregation, no collect
of rows - and every failure is reported together (lazy validation).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DataContractError(Exception):
    """Raised when a frame fails its contract; lists every failed rule."""


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    row_ok: Column | None = None          # must be true on every row (NULL counts as failure)
    failures: Column | None = None        # aggregate giving the failure count (table rules)


def not_null(c: str) -> Rule:
    return Rule(f"{c}_not_null", c, F.col(c).isNotNull())


def gt(c: str, v: float, nullable: bool = False) -> Rule:
    ok = F.col(c) > v
    return Rule(f"{c}_gt_{v:g}", c, (F.col(c).isNull() | ok) if nullable else ok)


def ge(c: str, v: float, nullable: bool = False) -> Rule:
    ok = F.col(c) >= v
    return Rule(f"{c}_ge_{v:g}", c, (F.col(c).isNull() | ok) if nullable else ok)


def between(c: str, lo: float, hi: float, nullable: bool = True) -> Rule:
    ok = F.col(c).between(lo, hi)
    return Rule(f"{c}_in_{lo:g}_{hi:g}", c, (F.col(c).isNull() | ok) if nullable else ok)


def isin(c: str, values: Sequence, nullable: bool = False) -> Rule:
    ok = F.col(c).isin(list(values))
    return Rule(f"{c}_in_set", c, (F.col(c).isNull() | ok) if nullable else ok)


def col_ge_col(a: str, b: str) -> Rule:
    return Rule(f"{a}_ge_{b}", a, F.col(a) >= F.col(b))


def unique(keys: Sequence[str]) -> Rule:
    """Table rule: no duplicate key (failures = rows beyond the distinct count)."""
    return Rule("unique_" + "_".join(keys), ",".join(keys),
                failures=F.count(F.lit(1)) - F.count_distinct(*[F.col(k) for k in keys]))


def min_non_null_share(c: str, share: float) -> Rule:
    return Rule(f"{c}_non_null_ge_{share:g}", c,
                failures=F.when(F.avg(F.col(c).isNotNull().cast("double")) < share, 1).otherwise(0))


def non_empty() -> Rule:
    return Rule("non_empty", "*", failures=F.when(F.count(F.lit(1)) == 0, 1).otherwise(0))


def required(df: DataFrame, cols: Sequence[str]) -> list[str]:
    return [c for c in cols if c not in df.columns]


def report(df: DataFrame, rules: Sequence[Rule], required_cols: Sequence[str] = ()) -> DataFrame:
    """(rule, column, failures, passed): one row per rule, from one aggregation."""
    missing = required(df, required_cols)
    rules = [r for r in rules if r.column in ("*",) or all(c in df.columns for c in r.column.split(","))]
    aggs = []
    for i, r in enumerate(rules):
        f = r.failures if r.failures is not None else F.count_if(~F.coalesce(r.row_ok, F.lit(False)))
        aggs.append(f.cast("bigint").alias(f"r{i}"))
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(r.name).alias("rule"), F.lit(r.column).alias("column"),
                     F.col(f"r{i}").alias("failures")) for i, r in enumerate(rules)]
    rows += [F.struct(F.lit(f"{c}_present").alias("rule"), F.lit(c).alias("column"),
                      F.lit(1).cast("bigint").alias("failures")) for c in missing]
    out = one.select(F.explode(F.array(*rows)).alias("x")).select("x.*")
    return out.withColumn("passed", F.col("failures") == 0)


def cast_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """The frame with the contract's types; a value that does not fit fails the query (ANSI casts)."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items() if c in df.columns})


def validate(df: DataFrame, rules: Sequence[Rule], layer: str, required_cols: Sequence[str] = (),
             types: dict[str, str] | None = None) -> DataFrame:
    """V1: cast to the contract's types and run it; raise ``DataContractError`` listing every failure,
    else return the cast frame."""
    df = cast_types(df, types or {})
    bad = [r for r in report(df, rules, required_cols).collect() if not r["passed"]]  # one row per rule
    if bad:
        lines = "\n".join(f"  {r['rule']} [{r['column']}]: {r['failures']} failures" for r in bad)
        raise DataContractError(f"{layer} breaks {len(bad)} rules of its contract:\n{lines}")
    return df


# Fixed contract values that must equal the reference's.
WEATHER_DATATYPES = ("TMAX", "TMIN", "PRCP", "SNOW")


def bronze_weather_rules() -> list[Rule]:
    """V2."""
    return [not_null("date"), not_null("datatype"), isin("datatype", WEATHER_DATATYPES),
            not_null("station_id"), not_null("region"), non_empty()]


def bronze_futures_rules() -> list[Rule]:
    """V3 (reference column names are capitalised; ours are normalised to lower case)."""
    o, h, l, c, v = "open", "high", "low", "close", "volume"
    return [not_null("date"), gt(o, 0), gt(h, 0), gt(l, 0), gt(c, 0), ge(v, 0),
            not_null("ticker"), not_null("label"), col_ge_col(h, l), col_ge_col(h, o)]


SILVER_REQUIRED = ("date", "day_of_week", "open", "high", "low", "close", "volume", "returns_1d", "log_return_1d",
                   "wheat_close", "crude_close", "usd_close", "tmax_f", "tmin_f", "prcp_in")


SILVER_TYPES = {"date": "date", "day_of_week": "int", "month": "int", **{c: "double" for c in (
    "open", "high", "low", "close", "volume", "returns_1d", "log_return_1d", "high_low_pct", "tmax_f", "tmin_f", "prcp_in", "snow_mm",
    "wheat_close", "crude_close", "usd_close")}}


def silver_rules(keys: Sequence[str] = ("symbol", "date")) -> list[Rule]:
    """V4; "dates ascending" has no meaning on an unordered table: key uniqueness replaces it."""
    return [not_null("date"), isin("day_of_week", range(7)), gt("open", 0), gt("high", 0), gt("low", 0),
            gt("close", 0), ge("volume", 0), ge("prcp_in", 0, nullable=True), unique(keys),
            col_ge_col("high", "low"), min_non_null_share("close", 0.95)]


GOLD_REQUIRED = ("date", "close", "rsi", "bb_pct_b", "gdd_cumulative", "target")


GOLD_TYPES = {"date": "date", **{c: "double" for c in ("close", "rsi", "bb_pct_b", "gdd_cumulative", "target")}}


def gold_rules(keys: Sequence[str] = ("symbol", "date")) -> list[Rule]:
    """V5."""
    return [not_null("date"), gt("close", 0), between("rsi", 0, 100), ge("gdd_cumulative", 0, nullable=True),
            unique(keys), min_non_null_share("target", 0.80)]
