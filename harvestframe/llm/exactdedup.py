"""Exact dedup against a minimal perfect hash over the distinct digests of earlier texts.

The index of a corpus is two tables. ``slots`` has one row per distinct digest: slot number, full
digest and the locator of the text that stays. ``functions`` has one row per bucket of digests: a
small minimal perfect hash (levels of bit arrays; a digest takes the first level where it is alone
at its place, and its slot is the rank of that bit). A digest that is not in the index also gets
some slot or none, so a lookup counts only when the slot's full digest equals it byte for byte.

Buckets are cut from the number of digests, so a function is built and used by one task each, on a
bounded number of digests; a bucket with many digests to look up is dealt over several tasks. All of
this runs on distinct digests, counted before the shuffle; texts are hashed where they are read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import read_table, stage, unused

#: Characters that texts may differ in: [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
#: Digests to a bucket, on average, and bits to a digest in each level of its function.
BUCKET, BITS_PER_KEY = 8192, 2
#: A group of more than 1 / HOT of all rows is joined by broadcast: there are fewer than HOT of them.
HOT = 1000

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def text_digest(text: Column) -> Column:
    """SHA-256 of the text without white space, 32 bytes; a null text counts as the empty one."""
    return F.unhex(F.sha2(F.translate(F.coalesce(text, F.lit("")), SPACES, ""), 256))


def _places(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Place of each digest (a row of four 64-bit words) in a level of ``size`` bits."""
    x = words[:, level % 4] ^ (words[:, (level + 1) % 4] >> np.uint64(level % 61)) ^ np.uint64(0x9E3779B97F4A7C15 * (level + 1) % 2**64)
    for shift, factor in ((30, _MIX[0]), (27, _MIX[1])):
        x = (x ^ (x >> np.uint64(shift))) * factor
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


def _words(digests) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<u8").reshape(-1, 4)


def build_function(digests: list[bytes]) -> tuple[list[int], bytes]:
    """Level sizes and the bits of all levels, one bit set per digest. Digests are distinct."""
    words, sizes, levels = _words(digests), [], []
    while len(words):
        size = max(8, BITS_PER_KEY * len(words))
        at = _places(words, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        levels.append(alone)
        words = words[~alone[at]]
    return sizes, np.packbits(np.concatenate(levels)).tobytes() if levels else b""


def evaluate(sizes: list[int], bits: bytes, digests: list[bytes]) -> np.ndarray:
    """Slot of each digest, counted from 0 in this function; -1 for a digest that meets no set bit."""
    out = np.full(len(digests), -1, np.int64)
    if not len(digests) or not len(sizes):
        return out
    flat = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(np.int64)
    rank = np.cumsum(flat) - flat
    words, open_, start = _words(digests), np.arange(len(digests)), 0
    for level, size in enumerate(sizes):
        at = start + _places(words[open_], level, size)
        hit = flat[at] == 1
        out[open_[hit]] = rank[at[hit]]
        open_, start = open_[~hit], start + size
    return out


class Index(NamedTuple):
    """``slots``: slot, digest, n_rows, winner. ``functions``: bucket, offset, sizes, bits. ``buckets``: how many."""

    slots: DataFrame
    functions: DataFrame
    buckets: int


def _bucket(digest: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(buckets))


def digest_groups(rows: DataFrame) -> DataFrame:
    """``(digest, n_rows, winner)``: of each digest the number of rows and the least ``rank``."""
    return rows.groupBy("digest").agg(F.count("*").alias("n_rows"), F.min("rank").alias("winner"))


def build_index(groups: DataFrame, bucket: int = BUCKET) -> Index:
    """The index over ``(digest, n_rows, winner)``, one row per distinct digest, as two written tables."""
    groups = stage(groups, "mph-groups")
    buckets = -(-groups.count() // bucket) or 1
    keyed = groups.withColumn("bucket", _bucket(F.col("digest"), buckets))
    counts = stage(keyed.groupBy("bucket").agg(F.count("*").alias("n")), "mph-counts")
    # one row per bucket of thousands of digests; offsets by a running sum over those
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes, bits = build_function(pdf["digest"].tolist())
        return pd.DataFrame({"bucket": pdf["bucket"].iloc[:1].tolist(), "sizes": [sizes], "bits": [bits]})

    built = keyed.select("bucket", "digest").groupBy("bucket").applyInPandas(build, "bucket long, sizes array<long>, bits binary")
    functions = stage(built.join(offsets, "bucket"), "mph-functions")
    index = Index(groups, functions, buckets)
    slots = find_slots(index, groups.select("digest"), bucket).join(groups, "digest")
    return Index(stage(slots.select("slot", "digest", "n_rows", "winner"), "mph-slots"), functions, buckets)


def find_slots(index: Index, digests: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``(digest, slot)`` of distinct digests by the functions alone; a null slot meets no set bit."""
    share = -(-digests.count() // (index.buckets * bucket)) or 1  # tasks to a bucket
    asked = digests.select("digest", _bucket(F.col("digest"), index.buckets).alias("bucket"),
                           F.pmod(F.xxhash64(F.lit(1), "digest"), F.lit(share)).alias("part"))
    functions = index.functions.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(share - 1).cast("long"))))

    def look(asked: pd.DataFrame, function: pd.DataFrame) -> pd.DataFrame:
        slot = np.full(len(asked), -1, np.int64)
        if len(function) and len(asked):
            f = function.iloc[0]
            slot = evaluate([int(s) for s in f["sizes"]], f["bits"], asked["digest"].tolist())
            slot[slot >= 0] += int(f["offset"])
        return pd.DataFrame({"digest": asked["digest"], "slot": slot})

    found = (asked.groupBy("bucket", "part").cogroup(functions.groupBy("bucket", "part"))
             .applyInPandas(look, "digest binary, slot long"))
    return found.select("digest", F.when(F.col("slot") >= 0, F.col("slot")).alias("slot"))


def look_up(index: Index, groups: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``groups`` with ``slot``, ``seen_rows`` and ``seen_winner`` of an equal digest in the index, else nulls."""
    found = find_slots(index, groups.select("digest"), bucket)
    held = index.slots.select(F.col("slot").alias("s"), F.col("digest").alias("held"), F.col("n_rows").alias("seen_rows"),
                              F.col("winner").alias("seen_winner"))
    same = (F.col("slot") == F.col("s")) & (F.col("digest") == F.col("held"))  # the bytes decide
    checked = found.join(held, same, "left").select("digest", F.col("s").alias("slot"), "seen_rows", "seen_winner")
    return groups.join(checked, "digest")


def rank_of(text: Column, id_: Column, tie: Column) -> Column:
    """Order of equal texts: most code points first, then smallest id (null last), then ``tie``."""
    return F.struct((-F.length(F.coalesce(text, F.lit("")))).alias("shorter"), id_.isNull().alias("no_id"), id_.alias("id"), tie.alias("tie"))


def _with_groups(rows: DataFrame, groups: DataFrame, n_rows: int) -> DataFrame:
    """``rows`` joined with their groups; groups of more than 1 / HOT of all rows go by broadcast, below HOT of them."""
    hot = F.col("n_rows") * HOT > n_rows
    far, near = groups.where(~hot), groups.where(hot)
    big = F.broadcast(stage(near, "mph-hot"))
    cold = rows.join(big.select("digest"), "digest", "left_anti")
    return rows.join(big, "digest").unionByName(cold.join(far, "digest"))


def exact_groups(docs: DataFrame, earlier: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, digest, keep_id, group_size, kept, in_index)``, one row per row of ``docs``.

    Rows where ``earlier`` holds make up the index; the others are looked up in it, and those that
    are not in it are grouped among themselves. Of equal texts the row of most code points stays, in
    whichever part it is, then that of the smallest id. A null text is the empty text; a null id
    comes last and is a null ``keep_id`` if it wins. Of rows equal in text, length and id one stays.
    Other columns, of any name, are not read. An empty table gives no rows. ``in_index`` says
    whether the digest is one of the index.
    """
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    rows = docs.select(F.coalesce(earlier, F.lit(False)).alias("earlier"), text_digest(text).alias("digest"),
                       rank_of(text, id_, F.struct(F.xxhash64(text).alias("hash"), F.monotonically_increasing_id().alias("row"))).alias("rank"))
    rows = stage(rows, "mph-digests")
    index = build_index(digest_groups(rows.where("earlier")))
    asked = stage(look_up(index, stage(digest_groups(rows.where("not earlier")), "mph-asked")), "mph-found")
    # repeats join the group of their slot; digests that are in no slot are groups of their own
    repeats = asked.where("slot is not null").select(F.col("slot").alias("s"), F.col("n_rows").alias("more"), F.col("winner").alias("other"))
    old = index.slots.join(repeats, F.col("slot") == F.col("s"), "left").select(
        "digest", (F.col("n_rows") + F.coalesce("more", F.lit(0))).alias("n_rows"), F.least("winner", "other").alias("winner"), F.lit(True).alias("in_index"))
    new = asked.where("slot is null").select("digest", "n_rows", "winner", F.lit(False).alias("in_index"))
    groups = stage(old.unionByName(new), "mph-all-groups")
    joined = _with_groups(rows.select("digest", "rank"), groups, rows.count())
    return joined.select(F.col("rank.id").alias("id"), "digest", F.col("winner.id").alias("keep_id"), F.col("n_rows").alias("group_size"),
                         (F.col("rank.tie.row") == F.col("winner.tie.row")).alias("kept"), "in_index")


def new_texts(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is not in ``index``, one row (by the same order) of each.

    All columns stay as they are; ``docs`` is written to the shared folder once, with its digests.
    """
    digest, rank = unused(docs, "digest"), unused(docs, "rank")
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    tie = F.struct(F.xxhash64(text).alias("hash"), F.monotonically_increasing_id().alias("row"))
    keyed = stage(docs.withColumns({digest: text_digest(text), rank: rank_of(text, id_, tie)}), "mph-docs")
    groups = stage(digest_groups(keyed.select(F.col(digest).alias("digest"), F.col(rank).alias("rank"))), "mph-asked")
    first = look_up(index, groups).where("slot is null").select(F.col("winner.tie.row").alias(rank))
    kept = keyed.withColumn(rank, F.col(f"`{rank}`.tie.row")).join(stage(first, "mph-kept"), rank, "left_semi")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def op11_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query over all ``documents``: half of them, by a hash of their id, stand for the earlier corpus."""
    docs = read_table(spark, sf_dir, "documents")
    groups = exact_groups(docs, F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    return groups.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE_OP11 = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
     g AS (SELECT *, first_value(doc_id) OVER w AS keep_id, row_number() OVER w = 1 AS kept FROM d
           WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size, kept, text_sha256 FROM g"""
