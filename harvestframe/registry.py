"""Registered queries (one per SURVEY section-2 operator) and their DuckDB oracle SQL.

Each query takes (spark, sf_dir) and returns a DataFrame over the driver tables;
outputs pass through ``checks.normalize.normalize`` and the SQL through
``sql_normalized`` with the same column kinds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from harvestframe.checks.normalize import normalize, sql_normalized
from harvestframe.config import Config
from harvestframe.plans.gold import gold_columns

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
# The same queries without the oracle normalisation (what a user runs; used by bench.py).
RAW: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

GOLD_INTS = {"day_of_week", "month", "heat_stress_flag", "vol_regime", "is_planting", "is_pollination",
             "is_harvest", "is_growing_season", "days_to_wasde", "wasde_week", "is_monday", "target_horizon"}
STRS = {"symbol", "region", "datatype", "station_id", "label", "ticker", "check", "message", "feature",
        "role", "rule", "column", "direction", "source", "ingest_date", "metric", "level", "severity", "name"}


def kinds_for(cols: Sequence[str], ints=(), dates=("date",), strs=None, bools=()) -> list[tuple[str, str]]:
    ints, dates, bools = set(ints) | GOLD_INTS, set(dates), set(bools)
    strs = STRS if strs is None else set(strs)
    out = []
    for c in cols:
        if c in dates:
            out.append((c, "t"))
        elif c in bools:
            out.append((c, "b"))
        elif c in strs:
            out.append((c, "s"))
        elif c in ints:
            out.append((c, "i"))
        else:
            out.append((c, "d"))
    return out


def register(name: str, sql_with: str | None = None, select: str | None = None,
             cols: Sequence[tuple[str, str]] | None = None):
    """Register a Spark query; optional oracle = ``WITH <sql_with> <select>`` normalised by ``cols``."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return normalize(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        RAW[name] = fn
        if select is not None and cols is not None:
            inner = f"({select}) AS q"
            body = sql_normalized(inner, cols)
            ORACLE[name] = (f"WITH RECURSIVE {sql_with.strip()}\n{body}" if sql_with else body)
        return fn
    return deco


CFG = Config()
GOLD_COLS = gold_columns(CFG)
