"""Reshapes and dedupes: A1 long->wide pivot, A2 station mean, J2 label pivot, T4 dedupe, T5 union."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestframe.functions.numeric import nan_to_null


def pivot_first_non_null(df: DataFrame, index: Sequence[str], pivot_col: str, values: Sequence[str],
                         value_col: str = "value", order_cols: Sequence[str] | None = None) -> DataFrame:
    """A1: ``pivot_table(aggfunc="first")``: first non-null value per cell.

    "First" is by ``order_cols`` (ingest order) when given, the smallest of equals;
    without them the value is deterministic (the smallest) since Spark has no file order.  Cells with only
    NULLs are NULL and an index group whose every value is NULL disappears.
    Explicit pivot values avoid the extra job that discovers them.
    """
    v = nan_to_null(value_col)
    src = df.where(v.isNotNull())
    agg = F.min_by(value_col, F.struct(*order_cols, value_col)) if order_cols else F.min(value_col)
    return src.groupBy(*index).pivot(pivot_col, list(values)).agg(agg)


def dedupe_keep(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str] | None,
                keep: str = "first") -> DataFrame:
    """T4: one row per key, the earliest (``first``) or latest (``last``) by ``order_cols``.

    An aggregate, ``min_by``/``max_by`` of the whole row by the ordering struct, so
    duplicates collapse map-side (partial aggregation) before the shuffle.  Without
    order columns, pandas' file order has no Spark equivalent and the row is chosen by
    the remaining columns, to stay deterministic.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    order = [*(order_cols or ()), *[c for c in others if c not in (order_cols or ())]]  # ties: by the other columns
    pick = F.min_by if keep == "first" else F.max_by
    best = df.groupBy(*keys).agg(pick(F.struct(*others), F.struct(*order)).alias("__row"))
    return best.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in others]).select(*df.columns)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` as it is; running it fails if a key repeats.  One row per key stays, so it costs a partial aggregate."""
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    one = df.groupBy(*keys).agg(F.first(F.struct(*others)).alias("__row"), F.count(F.lit(1)).alias("__n"))
    message = F.concat(F.lit(f"repeated key ({', '.join(keys)}) and no ingest order: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    row = F.when(F.col("__n") == 1, F.col("__row")).otherwise(F.raise_error(message))
    return one.select(*keys, row.alias("__row")).select(*keys, *[F.col(f"__row.{c}").alias(c) for c in others]).select(*df.columns)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """T5: vertical concatenation by column name; missing columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def pivot_labels(bars: DataFrame, labels: Sequence[tuple[str, str]], value: str = "close",
                 key: str = "symbol", on: str = "date", prefilter: bool = True) -> DataFrame:
    """Full outer join of several label series on date == one pivot of label -> value.

    ``prefilter=False`` keeps the input's plan unchanged below the pivot, so when the
    same bars also feed the spine Spark reuses their shuffle instead of re-reading the
    source (other symbols map to no label and only add days whose closes are all NULL,
    harmless under the spine's left join)."""
    sym_to_label = F.create_map(*[x for lab, sym in labels for x in (F.lit(sym), F.lit(lab))])
    src = bars.where(F.col(key).isin([s for _, s in labels])) if prefilter else bars
    src = src.select(on, sym_to_label[F.col(key)].alias("__label"), value)
    out = src.groupBy(on).pivot("__label", [lab for lab, _ in labels]).agg(F.max(value))
    return out.select(on, *[F.col(lab).alias(f"{lab}_close") for lab, _ in labels])
