"""Sharding along a Hilbert curve, in DataFrame functions only.

Metadata dimensions are quantised to ``BITS`` bits each, a document's place is the index of its cell
on the Hilbert curve through all dimensions, and the sorted documents are cut into runs of near
equal bytes. Neighbours on the curve are neighbours in every dimension, so each shard covers short
ranges of all of them, and ``manifest`` lets a reader skip shards by any of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import read_table, stage

SHARDS, BITS = 8, 5
#: (column, kind) of the dimensions of documents. category: hash bucket; size: octave of the bytes; linear: equal steps from least to most.
DOCUMENT_DIMS = (("source", "category"), ("lang", "category"), ("text", "size"), ("doc_id", "linear"))
_KEY = ("__h", "__id", "__crc", "__size")


def quantised(docs: DataFrame, dims, bits: int = BITS) -> list[Column]:
    """A coordinate from 0 to 2**bits - 1 per dimension; null is 0."""
    top, out = (1 << bits) - 1, []
    linear = [c for c, kind in dims if kind == "linear"]
    ends = docs.agg(*[f(F.col(f"`{c}`")).cast("double") for c in linear for f in (F.min, F.max)]).first() if linear else ()
    for c, kind in dims:
        value = F.col(f"`{c}`")
        if kind == "category":
            x = F.crc32(value.cast("string").cast("binary")) % top + 1
        elif kind == "size":
            x = F.least(F.floor(F.log2(F.octet_length(value) + 1)), F.lit(top))
        else:
            low, high = ends[2 * linear.index(c)], ends[2 * linear.index(c) + 1]
            step = ((high - low) or 1.0) if low is not None else 1.0
            x = F.least(F.floor((value.cast("double") - F.lit(low or 0.0)) / step * (top + 1)), F.lit(top))
        out.append(F.coalesce(x, F.lit(0)).cast("long"))
    return out


def with_curve_index(docs: DataFrame, dims, bits: int = BITS) -> DataFrame:
    """``docs`` with ``__h``, the index of the row's cell on the Hilbert curve.

    Skilling's transform: undo the turns of the curve bit by bit, Gray-decode, interleave the bits.
    """
    n = len(dims)
    names = [f"__x{i}" for i in range(n)]
    df = docs.withColumns(dict(zip(names, quantised(docs, dims, bits))))
    x = [F.col(c) for c in names]
    for q in range(bits - 1, 0, -1):
        low = (1 << q) - 1
        for i in range(n):
            turned = x[i].bitwiseAND(F.lit(1 << q)) != 0
            swap = x[0].bitwiseXOR(x[i]).bitwiseAND(F.lit(low))
            new = {names[0]: F.when(turned, x[0].bitwiseXOR(F.lit(low))).otherwise(x[0].bitwiseXOR(swap))}
            if i:
                new[names[i]] = F.when(turned, x[i]).otherwise(x[i].bitwiseXOR(swap))
            df = df.withColumns(new)
    for i in range(1, n):
        df = df.withColumn(names[i], x[i].bitwiseXOR(x[i - 1]))
    flips = F.lit(0).cast("long")
    for q in range(bits - 1, 0, -1):
        flips = flips.bitwiseXOR(F.when(x[-1].bitwiseAND(F.lit(1 << q)) != 0, F.lit((1 << q) - 1)).otherwise(F.lit(0)).cast("long"))
    df = df.withColumn("__flips", flips)
    index = F.lit(0).cast("long")
    for b in range(bits - 1, -1, -1):
        for c in x:
            bit = F.shiftright(c.bitwiseXOR(F.col("__flips")), b).bitwiseAND(F.lit(1))
            index = index * 2 + bit
    return df.withColumn("__h", index).drop(*names, "__flips")


def _keyed(docs: DataFrame, dims, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with the sort key: curve index, id, text CRC and size."""
    text = F.col(f"`{text_col}`")
    return (with_curve_index(docs, dims).withColumn("__id", F.col(f"`{id_col}`"))
            .withColumn("__crc", F.crc32(F.coalesce(text, F.lit("")).cast("binary")))
            .withColumn("__size", F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1))


def shard_positions(docs: DataFrame, n_shards: int = SHARDS, dims=DOCUMENT_DIMS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``__h, __id, __crc, __size, __shard, __slot`` of every row of ``docs``.

    Rows are range-sorted by the key and written, with their partition's number; a running sum inside
    each partition plus the sums of the partitions before give every row its bytes before it, and the
    middle byte of a row tells the shard. No task sees more than a range partition. Ties in the key
    are interchangeable rows. Null texts have size 1; an empty table gives no rows.
    """
    rows = _keyed(docs, dims, id_col, text_col).select(*_KEY)
    rows = stage(rows.repartitionByRange(*_KEY).sortWithinPartitions(*_KEY).withColumn("__part", F.spark_partition_id()), "shard-order")
    parts = rows.groupBy("__part").agg(F.sum("__size").alias("bytes"), F.count("*").alias("n"))
    before = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    offsets = parts.select(F.col("__part").alias("part"), F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"), F.sum("bytes").over(every).alias("total"))
    offsets = stage(offsets, "shard-offsets")
    inside = Window.partitionBy("__part").orderBy(*_KEY).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("upto", F.sum("__size").over(inside)).withColumn("nth", F.row_number().over(inside))
    placed = placed.join(offsets, F.col("__part") == F.col("part"))
    middle = (2 * (F.col("bytes_before") + F.col("upto")) - F.col("__size")).cast("decimal(38,0)")
    shard = F.least(F.floor(middle * n_shards / (2 * F.col("total"))), F.lit(n_shards - 1)).cast("int")
    placed = stage(placed.select(*_KEY, shard.alias("__shard"), (F.col("n_before") + F.col("nth") - 1).alias("rank")), "shard-places")
    first = placed.groupBy("__shard").agg(F.min("rank").alias("first")).withColumnRenamed("__shard", "shard")
    return placed.join(F.broadcast(first), F.col("__shard") == F.col("shard")).select(*_KEY, "__shard", (F.col("rank") - F.col("first")).alias("__slot"))


def sharded(docs: DataFrame, n_shards: int = SHARDS, dims=DOCUMENT_DIMS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` in curve order with the columns ``shard`` and ``hilbert`` (replacing any of that name).

    The cuts are the keys of the first rows of the shards, at most ``n_shards`` of them; rows with
    equal keys share a shard. Partitions are ranges of the curve, sorted.
    """
    places = shard_positions(docs, n_shards, dims, id_col, text_col)
    cuts = places.where("__slot = 0 and __shard > 0").select("__shard", *_KEY).orderBy("__shard").collect()
    keyed = _keyed(docs, dims, id_col, text_col)
    types = dict(keyed.dtypes)
    key = F.struct(*[F.col(k) for k in _KEY])
    shard = F.lit(0)
    for cut in cuts:
        at = F.struct(*[F.lit(cut[k]).cast(types[k]).alias(k) for k in _KEY])
        shard = F.when(key >= at, F.lit(cut["__shard"])).otherwise(shard)
    ordered = keyed.repartitionByRange(*_KEY).sortWithinPartitions(*_KEY)
    kept = [c for c in docs.columns if c.lower() not in ("shard", "hilbert")]
    return ordered.select(*[F.col(f"`{c}`") for c in kept], shard.cast("int").alias("shard"), F.col("__h").alias("hilbert"))


def manifest(shards: DataFrame, columns: list[str]) -> DataFrame:
    """One row per shard: rows, and least and most of each column, for skipping shards."""
    ends = [f(F.col(f"`{c}`")).alias(f"{n}_{c}") for c in columns for f, n in ((F.min, "min"), (F.max, "max"))]
    return shards.groupBy("shard").agg(F.count("*").alias("n_rows"), *ends)


def op1_shard_hilbert(spark, sf_dir: str) -> DataFrame:
    """Contract query over all ``documents``; law ``bytes``, and no groups are held together."""
    places = shard_positions(read_table(spark, sf_dir, "documents"))
    return places.select(F.col("__id").alias("doc_id"), F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"), F.lit("bytes").alias("law"),
                         F.col("__shard").alias("shard"), F.col("__slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.col("__h").alias("hilbert"))
