"""Source divergence audit by chunk factorization.

Texts are cut at white space into chunks. A task counts chunks per document and packs a block of
documents into one row per (language, chunk): the documents that hold it and how often. Rows are
dealt by chunk, so every distinct chunk meets in one place and is cut into terms once; the terms take
the place of the chunk. Rows are dealt again by term; there the blocks' document lists are merged,
which counts a document once however many chunks gave it the term, and occurrences are added up.

A block keeps its documents in order of source, and a document's place is ``source number * SPAN +
rank``; the list of places is stored as variable-length gaps, a byte or two a document. So what is
shuffled is one row per block and distinct chunk, never one per document and chunk, and no chunk or
term has more rows than there are blocks.

From the counts per (language, term, source) follow integer probabilities and divergences. Pairs of
sources are compared in bounded blocks of terms and tiles of sources, each a small matrix.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import read_table, small_batches, stage, utf8

#: A term: a run of ASCII letters and of anything beyond ASCII.
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
#: The same as a pattern on characters, as the contract states it.
TERM_CHARS = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS, TOP_TERMS, UNIT = 3, 200, 1_000_000_000
#: Most documents of one source in a block, documents and bytes of text in a block.
SPAN, BLOCK_DOCS, BLOCK_BYTES = 4096, 16384, 32 << 20
#: Terms and sources to a side of the matrices that compare pairs of sources.
TERM_BLOCK, TILE = 4096, 256
#: Rows of an Arrow batch that a task sends.
ROWS = 20_000


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative integers as bytes of 7 bits, low ones first, the high bit set but in the last; and the lengths."""
    values = values.astype(np.uint64)
    length = np.ones(len(values), np.int64)
    for k in range(1, 10):
        length += values >= np.uint64(1 << (7 * k))
    at = np.cumsum(length) - length
    out = np.zeros(int(length.sum()), np.uint8)
    for k in range(int(length.max(initial=0))):
        more = length > k
        part = (values[more] >> np.uint64(7 * k)) & np.uint64(127)
        out[at[more] + k] = part.astype(np.uint8) | np.where(length[more] > k + 1, 128, 0).astype(np.uint8)
    return out, length


def unpack(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The integers of ``pack`` and the place after the last byte of each."""
    ends = np.flatnonzero(data < 128) + 1
    if not len(ends):
        return np.zeros(0, np.int64), ends
    start = np.append(0, ends[:-1])
    shift = (np.arange(len(data)) - np.repeat(start, ends - start)) * 7
    return np.add.reduceat((data & 127).astype(np.int64) << shift, start), ends


def _binary(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.append(0, np.cumsum(lengths)).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])


class Block:
    """The documents of one language that a task has read since the last flush."""

    def __init__(self) -> None:
        self.chunks: defaultdict[bytes, int] = defaultdict()
        self.chunks.default_factory = self.chunks.__len__
        self.chunk: list[int] = []
        self.count: list[int] = []
        self.place: list[int] = []
        self.width: list[int] = []
        self.ranks: Counter = Counter()
        self.bytes = 0

    def add(self, source: int, text: bytes) -> None:
        found = Counter(text.split())  # splits at ASCII white space alone
        ids = self.chunks
        self.chunk.extend([ids[c] for c in found])
        self.count.extend(found.values())
        self.place.append(source * SPAN + self.ranks[source])
        self.width.append(len(found))
        self.ranks[source] += 1
        self.bytes += len(text)

    def full(self, source: int) -> bool:
        return len(self.place) >= BLOCK_DOCS or self.bytes >= BLOCK_BYTES or self.ranks[source] >= SPAN

    def rows(self, lang: str, number: int) -> Iterator[pa.RecordBatch]:
        """One row per chunk: ``places`` are gaps * 2 plus 1 where the chunk occurs more than once; ``counts`` has those counts."""
        chunk, count = np.array(self.chunk, np.int64), np.array(self.count, np.int64)
        place = np.repeat(np.array(self.place, np.int64), self.width)
        order = np.lexsort((place, chunk))
        chunk, count, place = chunk[order], count[order], place[order]
        first = np.append(True, chunk[1:] != chunk[:-1]) if len(chunk) else np.zeros(0, bool)
        gap = place - np.where(first, 0, np.append(0, place[:-1]))
        data, length = pack(gap * 2 + (count > 1))
        many, many_length = pack(count[count > 1])
        starts = np.flatnonzero(first)
        lengths = np.add.reduceat(length, starts) if len(starts) else starts
        per_entry = np.zeros(len(count), np.int64)
        per_entry[count > 1] = many_length
        many_lengths = np.add.reduceat(per_entry, starts) if len(starts) else starts
        names = list(self.chunks)
        table = pa.table({"lang": pa.array([lang] * len(names), pa.string()), "chunk": pa.array(names, pa.binary()),
                          "block": pa.array(np.full(len(names), number)), "places": _binary(data, lengths), "counts": _binary(many, many_lengths)})
        yield from table.to_batches(max_chunksize=ROWS)


def chunk_rows(docs: DataFrame) -> DataFrame:
    """``(lang, chunk, block, places, counts)`` from ``(lang, number, text)``, ``number`` being that of the source."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, number = defaultdict(Block), TaskContext.get().partitionId() << 32
        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2))):
                block = blocks[lang]
                if block.full(source) or sum(b.bytes for b in blocks.values()) >= BLOCK_BYTES:
                    for name in [lang] if block.full(source) else list(blocks):
                        yield from blocks.pop(name).rows(name, number)
                        number += 1
                    block = blocks[lang]
                block.add(source, text)
        for name, block in blocks.items():
            yield from block.rows(name, number)
            number += 1

    return docs.select("lang", "number", "text").mapInArrow(read, "lang string, chunk binary, block bigint, places binary, counts binary")


def _starts(column: pa.Array) -> np.ndarray:
    """Where a value differs from the one before."""
    return np.append(True, pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)).astype(bool)


def _list(column: pa.Array) -> list:
    return column.to_numpy(zero_copy_only=False).tolist()


def term_rows(chunks: DataFrame) -> DataFrame:
    """``(lang, term, block, times, places, counts)``: each distinct chunk is cut once, where all its rows meet.

    Rows are dealt by chunk and come in order of chunks, so a chunk's rows follow one another.
    ``times`` is how often the term stands in the chunk. Chunks without a term go.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, found = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            first = _starts(batch.column(1))
            of_run, out, times = np.cumsum(first) - 1, [], []
            chunks = _list(batch.column(1).take(pa.array(np.flatnonzero(first))))
            many = np.zeros(len(chunks), np.int64)
            for i, chunk in enumerate(chunks):
                if chunk != last:  # the first one may go on from the batch before
                    last, found = chunk, TERM.findall(chunk.lower())  # bytes: A-Z alone are lower-cased
                    found = [(found[0], 1)] if len(found) == 1 else list(Counter(found).items())
                many[i] = len(found)
                for term, n in found:
                    out.append(term)
                    times.append(n)
            width = many[of_run]  # terms to a row
            at = pa.array(np.repeat(np.arange(len(of_run)), width))
            begin = np.cumsum(many) - many
            place = np.arange(len(at)) - np.repeat(np.cumsum(width) - width, width) + np.repeat(begin[of_run], width)
            lang, _, block, places, counts = (c.take(at) for c in batch.columns)
            yield pa.RecordBatch.from_arrays([lang, pa.array(out, pa.binary()).take(pa.array(place)), block, pa.array(np.array(times, np.int64)[place]), places, counts],
                                             ["lang", "term", "block", "times", "places", "counts"])

    dealt = chunks.repartition("chunk").sortWithinPartitions("chunk")
    return dealt.mapInArrow(cut, "lang string, term binary, block bigint, times bigint, places binary, counts binary")


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary array, and where each value ends."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets[1:] - offsets[0]


def _entries(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, place, occurrences)`` of all documents in the lists of ``rows``."""
    one = rows.combine_chunks()
    get = lambda c: one[c].chunk(0) if one[c].num_chunks else pa.array([], one[c].type)
    data, ends = _bytes(get("places"))
    tokens, token_ends = unpack(data)
    row = np.searchsorted(ends, token_ends)
    gap, many = tokens >> 1, (tokens & 1) == 1
    run = np.cumsum(gap)
    first = np.append(True, row[1:] != row[:-1]) if len(row) else np.zeros(0, bool)
    base = (run - gap)[first]
    place = run - np.repeat(base, np.diff(np.append(np.flatnonzero(first), len(row))))
    n = np.ones(len(row), np.int64)
    n[many] = unpack(_bytes(get("counts"))[0])[0]
    return row, place, n * get("times").to_numpy(zero_copy_only=False)[row]


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of the sorted ``keys`` starts."""
    if not len(keys[0]):
        return np.zeros(0, bool)
    return np.append(True, np.any([k[1:] != k[:-1] for k in keys], axis=0))


def _merged(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(key, source, documents, occurrences)`` of rows with ``key`` and ``block``, ordered by key and source."""
    row, place, n = _entries(rows)
    key, block = rows["key"].to_numpy()[row], rows["block"].to_numpy()[row]
    order = np.lexsort((place, block, key))
    key, block, place, n = key[order], block[order], place[order], n[order]
    start = np.flatnonzero(_runs(key, block, place))
    key, source, n = key[start], place[start] // SPAN, np.add.reduceat(n, start) if len(start) else n
    return _by_source(key, source, np.ones(len(start), np.int64), n)


def _by_source(key, source, docs, n):
    order = np.lexsort((source, key))
    key, source, docs, n = key[order], source[order], docs[order], n[order]
    start = np.flatnonzero(_runs(key, source))
    if not len(start):
        return key, source, docs, n
    return key[start], source[start], np.add.reduceat(docs, start), np.add.reduceat(n, start)


def term_counts(terms: DataFrame) -> DataFrame:
    """``(lang, term, number, docs, n, sources)``: distinct documents and occurrences of each term in its language.

    ``sources`` lists number, documents and occurrences of each source that has the term; ``number``
    is another for every row. Rows are dealt by term and come in order of term, language and block,
    so a task holds the rows of one (term, language, block) and one row of counts per source.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[tuple[bytes, str]] = []  # key of the counts is a place in this list
        held: pa.Table | None = None  # rows of the last block, which may go on in the next batch
        counts = tuple(np.zeros(0, np.int64) for _ in range(4))
        number = TaskContext.get().partitionId() << 32

        def flush(keep: int) -> Iterator[pa.RecordBatch]:
            """Send what is complete: all names but the last ``keep``."""
            nonlocal names, counts, number
            done = len(names) - keep
            if done <= 0:
                return
            key, source, docs, n = counts
            cut = np.searchsorted(key, done)
            ends = np.searchsorted(key[:cut], np.arange(done), side="right").astype(np.int64)
            starts = np.append(0, ends[:-1])
            of = pa.StructArray.from_arrays([pa.array(x[:cut]) for x in (source, docs, n)], ["source", "docs", "n"])
            add = lambda x: np.add.reduceat(x[:cut], starts)  # noqa: E731  every name has a source
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[1] for x in names[:done]], pa.string()), pa.array([x[0] for x in names[:done]], pa.binary()),
                 pa.array(number + np.arange(done)), pa.array(add(docs)), pa.array(add(n)),
                 pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), of)], ["lang", "term", "number", "docs", "n", "sources"])
            number += done
            names, counts = names[done:], (key[cut:] - done, source[cut:], docs[cut:], n[cut:])

        def take(rows: pa.Table) -> None:
            """Add whole blocks of rows to the counts; their names go on from the last one."""
            nonlocal counts
            rows = rows.combine_chunks()
            term, lang = rows["term"].chunk(0), rows["lang"].chunk(0)
            first = _starts(term) | _starts(lang)
            at = pa.array(np.flatnonzero(first))
            found = list(zip(_list(term.take(at)), _list(lang.take(at))))
            on = bool(names) and names[-1] == found[0]  # goes on from the rows before
            keys = np.cumsum(first) - 1 + len(names) - on
            names.extend(found[on:])
            fresh = _merged(rows.append_column("key", pa.array(keys)))
            counts = _by_source(*[np.append(a, b) for a, b in zip(counts, fresh)])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]) if held is not None else rows
            end = rows.slice(rows.num_rows - 1).to_pylist()[0]
            block = rows["block"].to_numpy()
            cut = rows.num_rows
            while cut and block[cut - 1] == end["block"] and rows["term"][cut - 1].as_py() == end["term"] and rows["lang"][cut - 1].as_py() == end["lang"]:
                cut -= 1
            held = rows.slice(cut)
            if cut:
                take(rows.slice(0, cut))
                yield from flush(keep=1)
        if held is not None:
            take(held)
            yield from flush(keep=0)

    dealt = terms.repartition("term").sortWithinPartitions("term", "lang", "block")
    return dealt.mapInArrow(merge, "lang string, term binary, number bigint, docs bigint, n bigint, "
                                   "sources array<struct<source:bigint,docs:bigint,n:bigint>>")


def numbered(names: DataFrame, name: str) -> DataFrame:
    """Distinct rows with ``number`` from 0 without gaps: a count per partition, then offsets over the partitions."""
    rows = stage(names.distinct().withColumn("id", F.monotonically_increasing_id()), name)
    part, rank = F.shiftright("id", 33), F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = (rows.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
               .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    return stage(rows.join(F.broadcast(offsets), part == F.col("part")).select(*names.columns, (F.col("offset") + rank).alias("number")), name)


def probability(n, total, terms):
    """``1 + floor(UNIT * (n + 1) / (total + terms))`` as a column, exact: the product needs more than 64 bits."""
    return F.lit(1).cast("long") + F.expr(f"(cast({UNIT} as decimal(10,0)) * cast({n} + 1 as decimal(20,0))) div cast({total} + {terms} as decimal(20,0))")


def excess(p, q):
    """``floor((p - q)^2 / q)`` of probabilities, which stay below 2^31, so the square fits 64 bits."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def _probabilities(n: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    if n.size and int(n.max()) >= (1 << 63) // UNIT - 1:
        return np.array([1 + UNIT * (int(a) + 1) // (int(t) + terms) for a, t in np.broadcast(n, total)], np.int64).reshape(n.shape)
    return 1 + UNIT * (n + 1) // (total + terms)


def divergences(mine: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Sum over terms of ``excess`` for each row of ``mine`` (p) against each of ``other`` (q)."""
    return np.array([((p[None] - other) ** 2 // other).sum(axis=1) for p in mine], np.int64).reshape(len(mine), len(other))


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
          min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how far each source of a language is from the others, and by which terms.

    A language keeps the terms of at least ``min_docs`` of its documents. Part ``pair`` has a row for
    every ordered pair of sources of a language, ``value`` summed over all kept terms (0 without
    any); part ``term`` the ``top`` kept terms that a source uses more than its language, by value.
    Nulls in text, language or source count as ''. A source without terms has pairs, no terms; an
    only source no pairs. Repeated rows are documents of their own. An empty table gives no rows.
    Other columns, of any name, are not read. Sums beyond 64 bits raise an error.
    """
    spark = docs.sparkSession
    small_batches(spark)
    clean = lambda c, name: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name)
    texts = docs.select(clean(lang_col, "lang"), clean(source_col, "source"), clean(text_col, "text"))
    groups = stage(texts.select("lang", "source").distinct(), "divergence-groups")
    sources = numbered(groups.select("source"), "divergence-sources")
    # Spark broadcasts the sources if their table is small enough, and shuffles otherwise
    texts = texts.join(sources, "source").select("lang", "number", "text")
    kept = stage(term_counts(term_rows(chunk_rows(texts))).where(F.col("docs") >= min_docs), "divergence-terms")

    each = kept.select("lang", "term", F.col("n").alias("lang_n"), F.explode("sources").alias("s")).select("lang", "term", "lang_n", F.col("s.source").alias("number"), F.col("s.n").alias("n"))
    of_lang = stage(kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("lang_total")), "divergence-langs")
    of_group = each.groupBy("lang", "number").agg(F.sum("n").alias("total"))
    none = F.lit(0).cast("long")
    table = (groups.join(sources, "source").join(of_lang, "lang", "left").join(of_group, ["lang", "number"], "left")
             .select("lang", "source", "number", F.coalesce("terms", none).alias("terms"), F.coalesce("lang_total", none).alias("lang_total"),
                     F.coalesce("total", none).alias("total")))
    table = stage(table, "divergence-table")

    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(by_value))
    p_q = (each.join(table, ["lang", "number"])
           .withColumns({"p": probability("n", "total", "terms"), "q": probability("lang_n", "lang_total", "terms")}).where("p > q"))
    terms = ranked(p_q.select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), excess("p", "q").alias("value")))
    pairs = ranked(_pairs(kept, table))
    return pairs.unionByName(terms.where(F.col("rank") <= top))


def _pairs(kept: DataFrame, table: DataFrame) -> DataFrame:
    """``(lang, source, part, item, value)`` of all ordered pairs of sources of a language."""
    sizes = table.groupBy("lang").agg(F.count("*").alias("n_sources"), F.max("terms").alias("terms"))
    cuts = stage(sizes.select("lang", F.greatest(F.lit(1), F.ceil(F.col("terms") / TERM_BLOCK)).alias("blocks"),
                              F.ceil(F.col("n_sources") / TILE).alias("tiles")), "divergence-cuts")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    sides = F.explode(F.array_distinct(F.array("i", "j")))
    # a cell: one block of terms, one pair of tiles of sources
    cells = cuts.withColumn("block", every("blocks")).withColumn("i", every("tiles")).withColumn("j", every("tiles")).where("i <= j").drop("blocks", "tiles")
    block, tile = F.pmod(F.xxhash64("number"), F.col("blocks")), lambda c: F.pmod(c, F.col("tiles"))
    own = (table.join(cuts, "lang").select("lang", tile(F.col("number")).alias("tile"), F.struct("number", "source", "total").alias("s"), "terms")
           .groupBy("lang", "tile").agg(F.collect_list("s").alias("s"), F.max("terms").alias("terms")))  # about TILE sources
    placed = kept.join(cuts, "lang").withColumn("block", block)
    held = placed.groupBy("lang", "block").agg(F.count("*").alias("held"))
    heads = (cells.join(held, ["lang", "block"], "left").withColumn("held", F.coalesce("held", F.lit(0).cast("long")))
             .withColumn("tile", sides).join(own, ["lang", "tile"]))
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    entries = (placed.withColumn("i", parts).withColumn("j", parts).where("i <= j")
               .withColumn("sources", F.filter("sources", lambda s: F.pmod(s.source, F.col("tiles")).isin(F.col("i"), F.col("j"))))
               .where(F.size("sources") > 0)
               .select("lang", "block", "i", "j", F.transform("sources", lambda s: s.source).alias("numbers"), F.transform("sources", lambda s: s.n).alias("counts")))

    def compare(heads: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        head = heads.iloc[0]
        i, j = int(head["i"]), int(head["j"])
        rows = [(int(t), s) for t, ss in zip(heads["tile"], heads["s"]) for s in ss]
        at = {int(s["number"]): k for k, (_, s) in enumerate(rows)}
        n = np.zeros((len(rows), len(entries)), np.int64)
        for k, (numbers, counts) in enumerate(zip(entries["numbers"], entries["counts"])):
            n[[at[int(x)] for x in numbers], k] = counts
        total = np.array([int(s["total"]) for _, s in rows])[:, None]
        terms, tiles = int(head["terms"]), np.array([t for t, _ in rows])
        names = np.array([s["source"] for _, s in rows], object)
        out = []
        for a, b in {(i, j), (j, i)}:
            mine, other = np.flatnonzero(tiles == a), np.flatnonzero(tiles == b)
            if terms:
                p = _probabilities(n, np.broadcast_to(total, n.shape), terms)
                value = divergences(p[mine], p[other])
                zero = _probabilities(np.zeros_like(total), total, terms)  # terms of this block that neither tile has
                value += (int(head["held"]) - len(entries)) * divergences(zero[mine], zero[other])
            else:
                value = np.zeros((len(mine), len(other)), np.int64)
            x, y = np.meshgrid(mine, other, indexing="ij")
            out.append(pd.DataFrame({"source": names[x.ravel()], "item": names[y.ravel()], "value": value.ravel()})[(x != y).ravel()])
        return pd.concat(out).assign(lang=head["lang"])[["lang", "source", "item", "value"]]

    keys = ["lang", "block", "i", "j"]
    found = heads.groupBy(*keys).cogroup(entries.groupBy(*keys)).applyInPandas(compare, "lang string, source string, item string, value long")
    return (found.groupBy("lang", "source", "item").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value"))
            .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))


def op13_source_divergence(spark, sf_dir: str) -> DataFrame:
    """Contract query over all ``documents``."""
    return audit(read_table(spark, sf_dir, "documents"))


ORACLE_OP13 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (SELECT rid, lang, source, translate(unnest(regexp_extract_all(text, '{TERM_CHARS}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS (SELECT lang, term, count(*)::HUGEINT AS n FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= {MIN_DOCS}),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM k GROUP BY lang),
c AS (SELECT w.lang, w.source, w.term, count(*)::HUGEINT AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
s AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY lang, source),
g AS (SELECT DISTINCT lang, source FROM d),
f AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + {UNIT}::HUGEINT * (coalesce(c.n, 0) + 1) // (coalesce(s.total, 0) + l.v) AS p,
             1 + {UNIT}::HUGEINT * (k.n + 1) // (l.total + l.v) AS q
      FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c USING (lang, source, term) LEFT JOIN s USING (lang, source)),
pr AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
       FROM f a JOIN f b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pr.value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pr ON pr.lang = a.lang AND pr.source = a.source AND pr.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM f WHERE n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r)
SELECT * FROM o WHERE part = 'pair' OR rank <= {TOP_TERMS}"""
