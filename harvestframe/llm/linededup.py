"""Line deduplication over overlapping three-line windows.

Lines that hold a word are taken in order, and each three in a row are hashed to 128 bits. A window
that occurs more than once anywhere has a first occurrence, by document id and place; the lines of
all its later occurrences are covered, and covered lines go. Windows are grouped by hash with a
partial minimum, so a passage in a third of all documents is one row per task before the shuffle.

A line that goes has an equal line earlier, in the first occurrence; as "earlier" ends somewhere,
the earliest copy of each line stays, also where windows overlap each other or themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import read_table, row_key, small_batches, stage, unused, utf8

LINES = 3


def worded(text: bytes) -> tuple[list[bytes], list[int]]:
    """All lines of a text, and the places of those that hold a word."""
    lines = text.split(b"\n")
    return lines, [i for i, x in enumerate(lines) if x.strip()]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        owner, nth, digests = [], [], []
        for n, text in enumerate(utf8(batch.column(2))):
            lines, places = worded(text or b"")
            held = [lines[i] for i in places]
            for k in range(len(held) - LINES + 1):
                owner.append(n)
                nth.append(k)
                digests.append(xxhash.xxh3_128_digest(b"\n".join(held[k:k + LINES])))
        halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        at = pa.array(owner, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(nth, pa.int64()),
                                          pa.array(np.ascontiguousarray(halves[:, 0])), pa.array(np.ascontiguousarray(halves[:, 1]))],
                                         ["id", "row", "nth", "h1", "h2"])


def later_windows(rows: DataFrame) -> DataFrame:
    """``(row, starts)``: per row of ``rows`` (id, row, text) the windows that are later occurrences."""
    kind = rows.schema["id"].dataType.simpleString()
    windows = stage(rows.mapInArrow(_windows, f"id {kind}, row binary, nth bigint, h1 bigint, h2 bigint"), "line-windows")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "row", "nth")
    repeated = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    repeated = repeated.select(F.col("h1").alias("r1"), F.col("h2").alias("r2"), "first")
    later = windows.join(repeated, (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2"))).where(place != F.col("first"))
    return later.groupBy("row").agg(F.collect_set("nth").alias("starts"))


_RESULT = "struct<text:string,n_lines:bigint,removed_lines:bigint>"


def _without(text: Column, starts: Column) -> Column:
    @arrow_udf(_RESULT)
    def of(texts: pa.Array, lists: pa.Array) -> pa.Array:
        out, n_lines, n_removed = [], [], []
        for text, begins in zip(utf8(texts), lists.to_pylist()):
            lines, places = worded(text) if text else ([], [])
            covered = {places[k + j] for k in begins or () for j in range(LINES)}
            out.append(text if not covered else b"\n".join([x for i, x in enumerate(lines) if i not in covered]))
            n_lines.append(len(places))
            n_removed.append(len(covered))
        return pa.StructArray.from_arrays([pa.array(out, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())],
                                          ["text", "n_lines", "removed_lines"])

    return of(text, starts)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the later occurrences of repeated three-line windows cut out of ``text_col``.

    Adds ``n_lines`` (lines with a word) and ``removed_lines``, replacing columns of these names.
    Lines are the parts between line feeds and compare byte for byte; lines without a word stay and
    belong to no window. A text of fewer than three worded lines is unchanged, a null text stays
    null, and a text of which all lines go is empty. Null ids come after all others; rows of one id
    are ordered by SHA-256 of id and text, and rows equal in both are one occurrence, cut alike. An
    empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    row, starts = unused(docs, "row"), unused(docs, "starts")
    keyed = docs.withColumn(row, row_key(docs.select(id_col, text_col)))
    cut = later_windows(keyed.select(F.col(f"`{id_col}`").alias("id"), F.col(row).alias("row"), F.col(f"`{text_col}`").alias("text")))
    cut = stage(cut, "line-cuts").select(F.col("row").alias(row), F.col("starts").alias(starts))
    # a shuffle join at every size: the cuts grow with the documents
    out = keyed.join(cut.hint("merge"), row, "left").withColumn(starts, _without(F.col(f"`{text_col}`"), F.col(starts)))
    new = {text_col: "text", "n_lines": "n_lines", "removed_lines": "removed_lines"}
    kept = [F.col(f"{starts}.{new[c]}").alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns]
    return out.select(*kept, *[F.col(f"{starts}.{c}").alias(c) for c in ("n_lines", "removed_lines") if c not in docs.columns])


def op10_line_dedup(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` with their new texts."""
    return dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE_OP10 = r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
     w AS (SELECT *, regexp_matches(line, '[^\x20\x09-\x0D]') AS worded FROM l),
     t AS (SELECT doc_id, i, line, lead(line, 1) OVER p AS l1, lead(line, 2) OVER p AS l2 FROM w WHERE worded WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
     f AS (SELECT doc_id, i, l2 IS NOT NULL AND row_number() OVER (PARTITION BY line, l1, l2 ORDER BY doc_id, i) > 1 AS later FROM t),
     c AS (SELECT doc_id, i, bool_or(later) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS covered FROM f)
SELECT w.doc_id, coalesce(string_agg(line, chr(10) ORDER BY w.i) FILTER (WHERE NOT coalesce(covered, false)), '') AS text,
       count(*) FILTER (WHERE worded) AS n_lines, count(*) FILTER (WHERE covered) AS removed_lines
FROM w LEFT JOIN c ON c.doc_id = w.doc_id AND c.i = w.i GROUP BY w.doc_id"""
