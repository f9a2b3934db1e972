"""Benchmark decontamination: size-partitioned MinHash containment search with exact verification.

An item of q shingles inside a document of thousands has a Jaccard similarity near 0, so whole
documents are the wrong domain. Items are partitioned by size into classes of up to 16, 32, 64, ...
shingles (from 8, 4, 2 or 1 on if there are items so short), and a document is searched for a class
with bound u through windows of 2u shingles, one from every 16th (8th, ...) shingle on; any u
shingles in a row lie within one. A window that holds 80 % of an
item then has a Jaccard similarity of at least 0.19 with it, and ``HASHES`` bands of one row meet
with a probability of 1 - (1 - 0.19)**64 > 0.999998. Windows of a class are minima of those of the
class below, so each shingle is hashed once for all classes. Every candidate is verified by the
exact containment of the item's shingles in the whole document.

The items are the query set. They go to the tasks in blocks of a bounded size, one pass over the
documents a block; documents are never joined, shuffled or cut short.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, small_batches, utf8

SHINGLE, THRESHOLD_PERCENT, HASHES, BASE = 5, 80, 64, 16
#: Most items and most bytes of items that one pass carries to the tasks, on average.
BLOCK_ITEMS, BLOCK_BYTES = 4096, 8 << 20
#: Words hashed at once; longer documents are hashed in overlapping stretches.
STRETCH = 1 << 17
_LOOKUP = 1 << 20
_RADIX = 0x9E3779B97F4A7C15


def shingles(words: list[bytes]) -> set[bytes]:
    """All runs of five words; of fewer words the whole sequence, of none nothing."""
    if len(words) < SHINGLE:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i:i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)}


def normal_words(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _Powers:
    """Powers of the radix and of its inverse modulo 2**64, as far as asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 1 << 20)
            self.up, self.down = (np.cumprod(np.append(np.uint64(1), np.full(n - 1, base, np.uint64))) for base in (_RADIX, pow(_RADIX, -1, 1 << 64)))
        return self.up, self.down


def shingle_hashes(units: list[list[bytes]], powers: _Powers) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the shingles of all units (non-empty lists of words), and how many each unit has.

    A polynomial prefix sum over the bytes of all units gives the hash of any run of bytes at once.
    """
    data = np.frombuffer(b" ".join([b" ".join(u) for u in units]), np.uint8)
    up, down = powers.upto(len(data) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(data.astype(np.uint64) * up[: len(data)])))
    gaps = np.flatnonzero(data == 32)
    starts, ends = np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(data)]))
    sizes = np.array([len(u) for u in units])
    counts = np.maximum(sizes - SHINGLE + 1, 1)
    first = np.cumsum(sizes) - sizes
    at = np.arange(counts.sum()) + np.repeat(first - (np.cumsum(counts) - counts), counts)
    last = at + np.repeat(np.minimum(sizes, SHINGLE), counts) - 1
    begin = starts[at]
    return _mixed((sums[ends[last]] - sums[begin]) * down[begin]), counts


def _factors() -> np.ndarray:
    """Odd factors; x -> factor * x permutes 64-bit integers."""
    return _mixed(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)


class Searcher:
    """A block of items, ready to be looked for in documents."""

    def __init__(self, items: list[tuple[int, bytes | None]]) -> None:
        self.powers, self.factors = _Powers(), _factors()
        self.items = [(i, s) for i, t in items if (s := shingles(normal_words(t)))]
        bounds = [(len(s) - 1).bit_length() for _, s in self.items]  # log2 of each item's class
        self.base = min([BASE, *(1 << b for b in bounds)])
        by_class: dict[int, list[int]] = {}
        for k, b in enumerate(bounds):
            by_class.setdefault(b - self.base.bit_length() + 1, []).append(k)
        self.classes = {}
        for level, members in by_class.items():
            values, owners = [], []
            for k in members:
                hashes, _ = shingle_hashes([x.split() for x in self.items[k][1]], self.powers)
                values += [int((hashes * f).min()) for f in self.factors]
                owners += [k] * HASHES
            values = np.array(values, np.uint64)
            order = np.argsort(values, kind="stable")
            lookup = np.zeros(_LOOKUP, bool)
            lookup[(values & np.uint64(_LOOKUP - 1)).astype(np.int64)] = True
            self.classes[level] = (values[order], np.array(owners)[order], lookup)
        self.levels = max(self.classes, default=-1) + 1

    def candidates(self, units: list[list[bytes]]) -> set[tuple[int, int]]:
        """(unit, item) pairs whose MinHashes meet in some window."""
        hashes, counts = shingle_hashes(units, self.powers)
        blocks = -(-counts // self.base)
        unit = np.repeat(np.arange(len(units)), blocks)
        nth = np.arange(len(unit)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        cuts = np.repeat(np.cumsum(counts) - counts, blocks) + nth * self.base
        least = np.stack([np.minimum.reduceat(hashes * f, cuts) for f in self.factors])
        found: set[tuple[int, int]] = set()
        step = 1
        for level in range(self.levels):
            if step < len(unit):  # windows twice as long, from every block on
                grown = np.minimum(least[:, :-step], least[:, step:])
                least[:, :-step] = np.where(unit[:-step] == unit[step:], grown, least[:, :-step])
            step *= 2
            if level not in self.classes:
                continue
            values, owners, lookup = self.classes[level]
            flat = least.ravel()
            hit = np.flatnonzero(lookup[(flat & np.uint64(_LOOKUP - 1)).astype(np.int64)])
            low, high = np.searchsorted(values, flat[hit]), np.searchsorted(values, flat[hit], "right")
            for h, a, b in zip(hit[low < high] % len(unit), low[low < high], high[low < high]):
                found.update((int(unit[h]), int(k)) for k in owners[a:b])
        return found

    def search(self, texts: list[bytes | None]) -> list[tuple[int, int, int, int]]:
        """(text, item, shared shingles, shingles of the item) for all items that a text contains."""
        out: list[tuple[int, int, int, int]] = []
        overlap = (self.base << self.levels) + SHINGLE
        most = max(STRETCH * self.base // BASE, 1)
        units: list[list[bytes]] = []
        owner: list[int] = []
        kept: dict[int, list[bytes]] = {}
        size = 0

        def flush() -> None:
            nonlocal size
            if units:
                pairs = {(owner[u], k) for u, k in self.candidates(units)}
                out.extend(self.verified(kept, pairs))
            units.clear(), owner.clear(), kept.clear()
            size = 0

        for n, text in enumerate(texts):
            words = normal_words(text)
            if not words or not self.items:
                continue
            kept[n] = words
            for a in range(0, max(len(words) - overlap, 1), most):
                units.append(words[a:a + most + overlap])
                owner.append(n)
            size += len(words)
            if size >= most:
                flush()
        flush()
        return out

    def verified(self, texts: dict[int, list[bytes]], pairs: set[tuple[int, int]]) -> Iterator[tuple[int, int, int, int]]:
        by_text: dict[int, list[int]] = {}
        for n, k in pairs:
            by_text.setdefault(n, []).append(k)
        for n, items in sorted(by_text.items()):
            wanted = set().union(*(self.items[k][1] for k in items))
            words = texts[n]
            width = min(SHINGLE, len(words))
            there = {s for i in range(len(words) - width + 1) if (s := b" ".join(words[i:i + width])) in wanted}
            for k in sorted(items):
                item, parts = self.items[k]
                if 100 * (shared := len(parts & there)) >= THRESHOLD_PERCENT * len(parts):
                    yield n, item, shared, len(parts)


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, bytes | None]]]:
    """The distinct items in blocks of bounded size, each collected when its turn comes."""
    items = benchmark.select(F.col(f"`{id_col}`").alias("item_id"), F.col(f"`{text_col}`").cast("binary").alias("text")).distinct()
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(-(-n // BLOCK_ITEMS), -(-size // BLOCK_BYTES), 1)
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        if part:
            yield [(r["item_id"], None if r["text"] is None else bytes(r["text"])) for r in part]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(doc_id, item_id, shared, item_shingles)``: items of which a document holds 80 % or more.

    Words are cut at ASCII white space and ASCII letters lower-cased; a shingle is five words, or the
    whole of a shorter text. Null and empty texts contain nothing and are in nothing. Ids are
    returned as they are, null too. Repeated documents give repeated rows, equal items count once.
    An empty table on either side gives no rows. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    schema = "doc_id bigint, item_id bigint, shared bigint, item_shingles bigint"
    found = docs.sparkSession.createDataFrame([], schema)
    for block in _blocks(benchmark, item_col, item_text_col):

        def look(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(block)
            for batch in batches:
                ids, hits = batch.column(0), searcher.search(utf8(batch.column(1)))
                cols = list(zip(*hits)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(cols[0], pa.int64())), *[pa.array(c, pa.int64()) for c in cols[1:]]],
                                                 ["doc_id", "item_id", "shared", "item_shingles"])

        found = found.unionByName(rows.mapInArrow(look, schema))
    return found


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item of ``benchmark`` to 80 % or more."""
    small_batches(docs.sparkSession)
    place = docs.columns.index(text_col)
    for block in _blocks(benchmark, "item_id", "text"):

        def keep(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(block)
            for batch in batches:
                mask = np.ones(batch.num_rows, bool)
                mask[[h[0] for h in searcher.search(utf8(batch.column(place)))]] = False
                yield batch.filter(pa.array(mask))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs


def op5_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """All (document, item) pairs over all ``documents`` and all items of ``benchmark``."""
    found = contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.withColumn("containment", F.col("shared") / F.col("item_shingles"))


_WORDS = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
ORACLE_OP5 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
     ds AS (SELECT DISTINCT r, doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0),
     b AS (SELECT DISTINCT item_id, text FROM benchmark),
     q AS (SELECT row_number() OVER () AS k, item_id, {_WORDS} AS w FROM b),
     qs AS (SELECT DISTINCT k, item_id, array_to_string(w[i:i + 4], ' ') AS s FROM q, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0),
     n AS (SELECT k, count(*) AS item_shingles FROM qs GROUP BY k),
     hit AS (SELECT r, k, any_value(doc_id) AS doc_id, any_value(item_id) AS item_id, count(*) AS shared FROM ds JOIN qs USING (s) GROUP BY r, k)
SELECT doc_id, item_id, shared, item_shingles, shared / item_shingles AS containment
FROM hit JOIN n USING (k) WHERE 100 * shared >= 80 * item_shingles"""
