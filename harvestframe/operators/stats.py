"""A3-A11 aggregations: null rates, table stats, correlation, exact percentiles, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestframe.functions.numeric import div


def null_rates(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """A3: (keys..., column, null_rate) from one aggregation, unpivoted."""
    aggs = [F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols]
    wide = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    return wide.unpivot(list(keys), list(cols), "column", "null_rate")


def corr(x, y) -> Column:
    """Pearson correlation on complete pairs; NULL (not an error) for a constant side."""
    x, y = F.col(x) if isinstance(x, str) else x, F.col(y) if isinstance(y, str) else y
    xm, ym = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return div(F.covar_samp(xm, ym), F.stddev_samp(xm) * F.stddev_samp(ym))


def decile_probs(n_bins: int = 10) -> list[float]:
    return [i / n_bins for i in range(n_bins + 1)]


def bin_index(edges: Column, v: Column) -> Column:
    """Numpy.histogram bin of ``v`` for ascending ``edges``: half-open bins, last bin
    closed, NULL when out of range."""
    nb = F.size(edges) - 1
    idx = F.size(F.filter(edges, lambda e: e <= v)) - 1
    return (F.when(v < F.element_at(edges, 1), None)
            .when(v > F.element_at(edges, -1), None)
            .when(v == F.element_at(edges, -1), nb - 1)
            .otherwise(idx))


def cumulative_buckets(v: Column, edges: Sequence[float]) -> list[Column]:
    """L3: Prometheus-style cumulative bucket counts ``sum(v <= edge)`` plus +Inf."""
    out = [F.sum((v <= F.lit(float(e))).cast("bigint")).alias(f"le_{str(e).replace('-', 'm').replace('.', 'p')}")
           for e in edges]
    return out + [F.count(v).alias("le_inf")]


def value_bucket(v: Column, per_e: int = 65536) -> Column:
    """A whole number that never falls as ``v`` rises: logarithmic buckets, a share 1/per_e of the value wide.

    The infinities and NaN (above all others, as in Spark's order) take the outermost buckets.
    """
    x = F.when(v == 0, F.lit(0.0)).otherwise(F.signum(v) * (F.ln(F.abs(v)) + F.lit(800.0)) * F.lit(float(per_e)))
    edge = F.lit(float(1 << 52))
    # coalesce: a column that cannot be NULL puts no extra filter below the shared shuffle
    return F.coalesce(F.floor(F.least(F.greatest(x, -edge), edge)), F.lit(0).cast("bigint"))


def counted_values(df: DataFrame, keys: Sequence[str], value: str, count: Column | None = None) -> DataFrame:
    """(keys..., __v, __c): each group's distinct values and how often they occur, counted before the shuffle."""
    count = F.count(F.lit(1)) if count is None else count
    v = df.withColumn("__v", F.col(value).cast("double")).where(F.col("__v").isNotNull())
    for k in keys:
        v = v.where(F.col(k).isNotNull())
    return v.groupBy(*keys, "__v").agg(count.alias("__c"))


def percentiles_of_counts(values: DataFrame, keys: Sequence[str], probs: Sequence[float], count: Column | None = None,
                          out: str = "q", per_e: int = 65536) -> DataFrame:
    """(keys..., out): exact percentiles with linear interpolation (numpy's default) of counted values.

    1. a histogram per group over ``value_bucket``: merged by addition, a row per bucket in use;
    2. its running count gives each bucket's first rank, and so the buckets that hold the ranks
       numpy needs (floor and ceil of (n-1)p);
    3. only the values of those buckets are put in order, each bucket by itself, and the rows at
       the ranks taken.

    All probabilities and groups at once, without a job of its own. ``values`` is read twice from
    one shuffle. A task orders one bucket: the distinct values within a share 1/``per_e`` of each other.
    """
    keys = list(keys)
    b = values.withColumn("__c", F.col("__c") if count is None else count).where("__c > 0")
    b = b.select(*keys, "__v", "__c", value_bucket(F.col("__v"), per_e).alias("__b"))
    w = Window.partitionBy(*keys)
    upto = w.orderBy("__b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = b.groupBy(*keys, "__b").agg(F.sum("__c").alias("__cnt")).select(
        *keys, "__b", (F.sum("__cnt").over(upto) - F.col("__cnt")).alias("__off"),
        F.sum("__cnt").over(upto).alias("__end"), F.sum("__cnt").over(w).alias("__n"))
    h = [(F.col("__n") - 1) * F.lit(float(p)) for p in probs]
    ranks = F.array_distinct(F.array(*[F.struct(F.lit(i).alias("i"), (x - F.floor(x)).alias("frac"), r(x).alias("r"))
                                       for i, x in enumerate(h) for r in (F.floor, F.ceil)]))
    need = hist.select(*keys, "__b", "__off", F.filter(
        ranks, lambda s: (s["r"] >= F.col("__off")) & (s["r"] < F.col("__end"))).alias("__need")).where(F.size("__need") > 0)
    inside = Window.partitionBy(*keys, "__b").orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = b.join(need, [*keys, "__b"]).withColumn("__upto", F.col("__off") + F.sum("__c").over(inside))
    # a rank lies among the equal values of one row
    hits = F.filter("__need", lambda s: (s["r"] < F.col("__upto")) & (s["r"] >= F.col("__upto") - F.col("__c")))
    hits = rows.select(*keys, "__v", F.explode(hits).alias("__s"))
    at = hits.groupBy(*keys).agg(F.collect_list(F.struct("__s.i", "__s.frac", F.col("__v").alias("v"))).alias("__at"))
    own = F.transform(F.array(*[F.lit(i) for i in range(len(probs))]), lambda i: F.filter("__at", lambda s: s["i"] == i))

    def between(a: Column) -> Column:
        lo, hi = F.array_min(F.transform(a, lambda s: s["v"])), F.array_max(F.transform(a, lambda s: s["v"]))
        return F.when(lo == hi, lo).otherwise(lo + (hi - lo) * a[0]["frac"])

    return at.select(*keys, F.transform(own, between).alias(out))


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], out: str = "q",
                      per_e: int = 65536) -> DataFrame:
    """(keys..., out): exact percentiles per group with linear interpolation; NULLs and rows with a NULL key are left out."""
    return percentiles_of_counts(counted_values(df, keys, value), keys, probs, out=out, per_e=per_e)
