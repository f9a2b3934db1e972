"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source with rate r = target / size of the source gets floor(r) copies and one more
with a fractional probability. Words, not documents, are what the targets count, so the two sides of
a pair trade probability in words: what one gains in words the other loses, until a side is integral,
and the direction is drawn once, so that no expected value changes. Among documents of one
probability, all but a few, the largest open one is paired with the bundle of all smaller ones, which
share their side's change; either the document ends at 0 or 1, or the whole bundle does. So the words
taken per source stay at the target until one document is left, which is one of the smallest unless a
document outweighs all that are smaller. What the classes leave is paired one with one. The last
document is drawn.

The reduction is a tree. A leaf is a (source, block) group of about ``LEAF`` documents; each leaf
leaves at most one document, and every further level joins the residuals of ``FAN`` groups, until a
source has one group. A source that holds most rows has that many more leaves.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, read_table, row_key, stage, unused

WEIGHTS = (1.0, 2.0, 3.0)
MAX_REPEAT = 3
LEAF, FAN = 2000, 256
SEED = 20240607


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, one row per source.

    Sources in order of code points, null last, take the weights in turn. The targets share the sum
    of all sizes by weight; a target stops at ``max_repeat`` times its source, and the excess is
    shared again: target = min(cap, level * weight), where the level follows from running sums over
    the sources by cap / weight. The table has one row per source, a list as long as that of the
    weights, and only that is put in one order.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    t = (sizes.withColumn("weight", weight).withColumn("cap", (max_repeat * F.col("source_size")).cast("double"))
         .withColumn("point", F.col("cap") / F.col("weight")))
    before = everything.orderBy("point", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    full = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0.0))
    t = (t.withColumn("all", F.sum(F.col("source_size").cast("double")).over(everything)).withColumn("weights", F.sum("weight").over(everything))
         .withColumn("capped", F.col("point") * (F.col("weights") - full("weight")) <= F.col("all") - full("cap")))
    taken = lambda c: F.coalesce(F.sum(F.when(F.col("capped"), F.col(c))).over(everything), F.lit(0.0))
    level = F.try_divide(F.col("all") - taken("cap"), F.col("weights") - taken("weight"))
    return t.select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(level * F.col("weight")).alias("target"))


def _uniform(key: np.ndarray, level: int) -> np.ndarray:
    """Numbers in [0, 1) from 64-bit keys, another series for each level."""
    x = key.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2.0**53


def settle(size: np.ndarray, p: float, draw: np.ndarray) -> np.ndarray:
    """Probabilities of documents that all start at ``p``, after pairing; all but one at most are 0 or 1. Sizes descend.

    The bundle behind a document has one probability throughout, so a pair costs the same however
    many documents the bundle has, and every document keeps its mean.
    """
    words, out = size.astype(float), np.zeros(len(size))
    behind = np.cumsum(words[::-1])[::-1] - words
    for i in range(len(words)):
        room, have = (1 - p) * behind[i], p * behind[i]
        to_doc, to_rest = min((1 - p) * words[i], have), min(p * words[i], room)
        if to_doc + to_rest <= 0:  # nothing behind
            out[i] = p
            break
        if draw[i] * (to_doc + to_rest) < to_rest:  # with this chance the document gains, so that its mean stays
            out[i] = 1.0 if to_doc < have else p + to_doc / words[i]
            p = p - to_doc / behind[i] if to_doc < have else 0.0
        else:
            out[i] = 0.0 if to_rest < room else p - to_rest / words[i]
            p = p + to_rest / behind[i] if to_rest < room else 1.0
        if not 0.0 < p < 1.0:
            out[i + 1:] = round(p)
            break
    return out


def pivot(size: np.ndarray, p: np.ndarray, draw: np.ndarray) -> int:
    """Pair documents one with one, in order, changing ``p`` until all but one are 0 or 1; that one's place (-1: none)."""
    open_ = -1
    for b in np.flatnonzero((p > 0) & (p < 1)).tolist():
        if open_ < 0:
            open_ = b
            continue
        a = open_
        to_a, to_b = min((1 - p[a]) * size[a], p[b] * size[b]), min((1 - p[b]) * size[b], p[a] * size[a])
        gains, loses, moved = (a, b, to_a) if draw[b] * (to_a + to_b) < to_b else (b, a, to_b)
        full, spent = moved == (1 - p[gains]) * size[gains], moved == p[loses] * size[loses]
        p[gains] = 1.0 if full else p[gains] + moved / size[gains]
        p[loses] = 0.0 if spent else p[loses] - moved / size[loses]
        open_ = next((k for k in (a, b) if 0.0 < p[k] < 1.0), -1)
    return open_


def rounded(size: np.ndarray, p: np.ndarray, draw: np.ndarray, again: np.ndarray) -> tuple[np.ndarray, int]:
    """All but one of ``p`` at 0 or 1, and that one's place (-1: none): classes of one probability first, then what they leave."""
    p = np.array(p, float)
    for value in np.unique(p[(p > 0) & (p < 1)]).tolist():
        at = np.flatnonzero(p == value)
        p[at] = settle(size[at], value, draw[at])
    return p, pivot(size, p, again)


def _level(rows: DataFrame, level: int, last: bool) -> DataFrame:
    """One level of the tree: ``p`` of every row at 0 or 1, but for one ``open`` row per group."""

    def reduce(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "key", "row"], ascending=[False, True, True])
        key = group["key"].to_numpy(np.int64)
        p, at = rounded(group["size"].to_numpy(), group["p"].to_numpy(), _uniform(key, 3 * level), _uniform(key, 3 * level + 1))
        if at >= 0 and last:
            p[at], at = float(_uniform(key[at:at + 1], 3 * level + 2)[0] < p[at]), -1
        group["p"], group["open"] = p, np.arange(len(p)) == at
        return group

    return rows.groupBy("source", "block").applyInPandas(reduce, rows.schema)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """The mix, one row per distinct row of ``docs``.

    ``row`` (SHA-256 of all columns), ``doc_id``, ``source``, ``size`` (words; null text: 0),
    ``source_size``, ``target``, ``times`` (how often the row occurs) and ``copies`` (of all those
    together). The draws depend on the rows alone, so reruns agree. A null source is a source. Rows
    without words get copies at the rate too, and take no words. An empty table gives no rows.
    """
    spark = docs.sparkSession
    units = (docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), n_words(F.col(f"`{text_col}`")).alias("size"),
                         row_key(docs).alias("row"))
             .groupBy("source", "doc_id", "size", "row").agg(F.count("*").alias("times")))
    units = stage(units, "mix-units")
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("source_size"), F.count("*").alias("units"))
    sizes = stage(sizes, "mix-sizes")
    targets = (source_targets(sizes.select("source", "source_size"), weights, max_repeat)
               .join(sizes.select(F.col("source").alias("s"), "units"), F.col("source").eqNullSafe(F.col("s")))
               .select("s", "source_size", "target", F.ceil(F.col("units") / LEAF).alias("blocks")))
    targets = stage(targets, "mix-targets")
    most = targets.agg(F.max("blocks")).first()[0]
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0)) * F.col("times")
    rows = units.join(targets, F.col("source").eqNullSafe(F.col("s"))).select(
        "source", "doc_id", "row", F.xxhash64(F.lit(SEED), "row").alias("key"), "size", "times", "source_size", "target", F.floor(rate).alias("sure"), (rate - F.floor(rate)).alias("p"),
        F.pmod(F.xxhash64("row"), F.col("blocks")).cast("long").alias("block"), F.lit(False).alias("open"))
    # Rows without words move no words: each is drawn for itself.
    alone = F.when(F.col("size") == 0, (F.pmod(F.col("key"), F.lit(1 << 20)) < F.col("p") * (1 << 20)).cast("double")).otherwise(F.col("p"))
    rows, done, level, blocks = rows.withColumn("p", alone), None, 0, most or 1
    while True:
        out = stage(_level(rows, level, last=blocks == 1), "mix-level")
        settled = out.where("not open")
        done = settled if done is None else done.unionByName(settled)
        if blocks == 1:
            break
        rows = out.where("open").withColumn("block", F.floor(F.col("block") / FAN)).withColumn("open", F.lit(False))
        level, blocks = level + 1, -(-blocks // FAN)
    return done.select("row", "doc_id", "source", "size", "source_size", "target", "times", (F.col("sure") + F.col("p").cast("long")).alias("copies"))


def take_mix(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix takes them: rows of 0 copies go, others stand as often as they have copies.

    Rows are known by the SHA-256 of all columns with their nulls, so only equal rows count as one;
    they are interchangeable. Columns may have any name.
    """
    row, copies = unused(docs, "row"), unused(docs, "copies")
    units = mix(docs).where("copies > 0").select(F.col("row").alias(row), F.col("copies").alias(copies))
    once = docs.withColumn(row, row_key(docs)).join(units, row).dropDuplicates([row])
    again = once.withColumn(row, F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"`{copies}`"))))
    return again.select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_mix_sources(spark, sf_dir: str) -> DataFrame:
    """Contract query over all ``documents``."""
    rows = mix(read_table(spark, sf_dir, "documents")).withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    copies = F.expr("copies div times") + (F.col("nth") <= F.col("copies") % F.col("times")).cast("long")
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies"))
