"""M6: permutation importance as one distributed scoring pass.

A feature matters as much as the error grows when its values are dealt anew within their series. The
dealing is a permutation of row positions in closed form, so a row's donor is found by one equi-join on
(series, position), whatever the length of a series: no sort, no shuffle by a random rank. Every (row,
donor) pair then yields one row per feature, with that feature taken from the donor, and all of them are
scored at once; errors are summed per (feature, repeat) before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestframe.session import written

#: Prime multipliers, one per repeat in turn, beyond the length of any series: a product modulo n is a permutation.
PRIMES = (2147483647, 1000000007, 998244353, 1000000009, 2147483629)
#: How far repeats are shifted from one another.
STEP = 7919


def donor_position(pos: Column, n: Column, repeat: Column) -> Column:
    """A permutation of 0..n-1 for each repeat."""
    prime = F.element_at(F.array(*[F.lit(p).cast("long") for p in PRIMES]), (repeat % len(PRIMES) + 1).cast("int"))
    return (prime * pos + 1 + (repeat * STEP) % F.greatest(n - 1, F.lit(1))) % n


def linear_scorer(weights: Sequence[float]) -> Callable[[DataFrame], DataFrame]:
    """A scorer that adds ``prediction`` = the weighted sum of the array ``features``."""
    w = F.array(*[F.lit(float(x)) for x in weights])
    total = F.aggregate(F.zip_with("features", w, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return lambda df: df.withColumn("prediction", total)


def model_scorer(model) -> Callable[[DataFrame], DataFrame]:
    """A scorer with a fitted Spark ML model."""
    return lambda df: model.transform(df.withColumn("features", array_to_vector("features")))


def permutation_importance(rows: DataFrame, feature_cols: Sequence[str], score: Callable[[DataFrame], DataFrame], repeats: int = 5,
                           keys: Sequence[str] = ("symbol",), label: str = "target") -> DataFrame:
    """(feature, importance, spread, rank): the mean growth of the absolute error over the repeats, and its deviation.

    ``rows`` has the keys, the 0-based position ``pos`` in the series, its length ``n``, the label and the
    features, all without nulls; ``score`` adds ``prediction`` from the array ``features``.
    """
    keys, count = list(keys), len(feature_cols)
    base = rows.select(*keys, F.col("pos").cast("long").alias("pos"), F.col("n").cast("long").alias("n"), F.col(label).cast("double").alias("label"),
                       F.array(*[F.col(c).cast("double") for c in feature_cols]).alias("own"))
    base = written(base, "importance-rows")
    donors = base.select(*keys, F.col("pos").alias("donor"), F.col("own").alias("other"))
    asked = base.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    pairs = asked.withColumn("donor", donor_position(F.col("pos"), F.col("n"), F.col("repeat"))).join(donors, [*keys, "donor"])
    # the first repeat also scores the rows as they are, as feature -1
    first = F.when(F.col("repeat") == 0, -1).otherwise(0)
    each = pairs.withColumn("nth", F.explode(F.sequence(first, F.lit(count - 1))))
    each = each.withColumn("features", F.transform("own", lambda x, i: F.when(i == F.col("nth"), F.get("other", i)).otherwise(x)))
    errors = score(each.select("nth", "repeat", "label", "features")).groupBy("nth", "repeat").agg(F.avg(F.abs(F.col("label") - F.col("prediction"))).alias("mae"))
    # one row per feature and repeat from here on
    whole = Window.partitionBy(F.lit(0))
    grown = errors.withColumn("grown", F.col("mae") - F.max(F.when(F.col("nth") == -1, F.col("mae"))).over(whole)).where("nth >= 0")
    out = grown.groupBy("nth").agg(F.avg("grown").alias("importance"), F.stddev_samp("grown").alias("spread"))
    name = F.element_at(F.array(*map(F.lit, feature_cols)), F.col("nth") + 1)
    ranked = Window.partitionBy(F.lit(0)).orderBy(F.desc("importance"), "feature")
    return out.select(name.alias("feature"), "importance", "spread").withColumn("rank", F.row_number().over(ranked))
