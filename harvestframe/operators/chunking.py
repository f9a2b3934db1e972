"""Split a long (hot) series into row chunks with halos, so one series runs as many tasks.

A window partitioned by the series key puts a whole series in one task.  When one
series can hold a large share of all rows, the series is cut instead:

1. ``with_positions``: the global 0-based position of every row in its series,
   computed in parallel - counts per (series, time bucket), offsets by a running
   sum over the (few) buckets of each series, then ``row_number`` inside each
   (series, bucket).
2. ``with_halo``: chunk = position div C.  A row is copied, as a non-home row, into
   the following chunks whose first ``back`` rows of lookback it falls in, and into
   the preceding chunk whose last ``ahead`` rows of look-ahead it falls in.  Windows
   then run on ``partitionBy(series, chunk)``; only home rows are kept afterwards.
   Any feature whose lookback is at most ``back`` rows (and look-ahead at most
   ``ahead``) is exact.
3. ``running_sum_with_carry``: unbounded running sums (OBV, seasonal GDD) are exact
   for any length: a running sum inside each chunk plus the total of the earlier
   chunks (a running sum over per-chunk totals, one row per chunk).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

POS, CHUNK, HOME = "__pos", "__chunk", "__home"


def with_positions(df: DataFrame, keys: Sequence[str], order: str, bucket: Column,
                   length: str | None = None) -> DataFrame:
    """Adds ``__pos`` (and the series length as ``length`` when given) in one counting pass."""
    keys = list(keys)
    d = df.withColumn("__bucket", bucket)
    counts = d.groupBy(*keys, "__bucket").agg(F.count(F.lit(1)).alias("__cnt"))
    w = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    extra = [F.sum("__cnt").over(Window.partitionBy(*keys)).alias(length)] if length else []
    offs = counts.select(*keys, "__bucket", F.coalesce(F.sum("__cnt").over(w), F.lit(0)).alias("__off"), *extra)
    d = d.join(offs, [*keys, "__bucket"])
    wr = Window.partitionBy(*keys, "__bucket").orderBy(order)
    return d.withColumn(POS, F.col("__off") + F.row_number().over(wr) - 1).drop("__bucket", "__off")


def with_halo(df: DataFrame, chunk_rows: int, back: int, ahead: int) -> DataFrame:
    """Explode each row into its home chunk plus the neighbour chunks that need it."""
    c = F.lit(chunk_rows)
    p = F.col(POS)
    home = F.floor(p / c)
    lo = F.greatest(F.floor((p - F.lit(ahead)) / c), F.lit(0))
    hi = F.floor((p + F.lit(back)) / c)
    out = df.withColumn("__home_chunk", home).withColumn(CHUNK, F.explode(F.sequence(lo, hi)))
    return out.withColumn(HOME, F.col(CHUNK) == F.col("__home_chunk")).drop("__home_chunk")


def running_sum_with_carry(df: DataFrame, value: str, out: str, keys: Sequence[str], order: str,
                           chunk: str = CHUNK, keep_null: bool = False) -> DataFrame:
    """Exact series-wide running sum of ``value`` over home rows split in chunks."""
    keys = list(keys)
    local = F.sum(value).over(Window.partitionBy(*keys, chunk).orderBy(order)
                              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    df = df.withColumn("__local", local)
    totals = df.groupBy(*keys, chunk).agg(F.sum(value).alias("__tot"))
    wc = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*keys, chunk, F.coalesce(F.sum("__tot").over(wc), F.lit(0.0)).alias("__carry"))
    df = df.join(carry, [*keys, chunk], "left")
    total = F.coalesce(F.col("__local"), F.lit(0.0)) + F.col("__carry")
    res = F.when(F.col(value).isNotNull(), total) if keep_null else total
    return df.withColumn(out, res).drop("__local", "__carry")


def series_positions(df: DataFrame, keys: Sequence[str], order: str, bucket: str = "year",
                     pos: str = "pos", n: str = "n") -> DataFrame:
    """0-based position and series length without a whole-series window:
    ``with_positions`` plus the series length from a partial aggregate."""
    d = with_positions(df, keys, order, F.date_trunc(bucket, F.col(order)), length=n)
    return d.withColumnRenamed(POS, pos)


def fill_forward(df: DataFrame, keys: Sequence[str], order: str, cols: dict[str, str], bucket: str = "year") -> DataFrame:
    """Forward fills (column -> new column) without a whole-series window: inside each (series, time
    bucket), and before its first value the last value of the buckets before (one row per bucket)."""
    keys = list(keys)
    d = df.withColumn("__bucket", F.date_trunc(bucket, F.col(order)))
    last = d.groupBy(*keys, "__bucket").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(out) for c, out in cols.items()])
    before = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(*keys, "__bucket", *[F.last(out, ignorenulls=True).over(before).alias(f"__carry_{out}") for out in cols.values()])
    inside = Window.partitionBy(*keys, "__bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.join(carry, [*keys, "__bucket"])
    filled = {out: F.coalesce(F.last(c, ignorenulls=True).over(inside), F.col(f"__carry_{out}")) for c, out in cols.items()}
    return d.withColumns(filled).drop("__bucket", *[f"__carry_{out}" for out in cols.values()])


def neighbour(df: DataFrame, keys: Sequence[str], cols: Sequence[str], offset: int, pos: str = "pos",
              suffix: str | None = None) -> DataFrame:
    """Values of ``cols`` from the row ``offset`` positions away (lag for offset < 0,
    lead for offset > 0) by an equi-join on (keys, position): no whole-series window,
    and a position key cannot be skewed."""
    keys = list(keys)
    suffix = suffix or (f"_lag{-offset}" if offset < 0 else f"_lead{offset}")
    other = df.select(*keys, (F.col(pos) - F.lit(offset)).alias(pos), *[F.col(c).alias(c + suffix) for c in cols])
    return df.join(other, [*keys, pos], "left")
