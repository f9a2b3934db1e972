"""Token ids in ORC files.

One row per document: ids as a list that ORC stores with its run-length encoding for integers, in
files of ascending document id. Row indexes (every ``ROW_INDEX`` rows) and a Bloom filter on the
document id let a reader skip stripes and row groups, and stripes are read in parallel.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import fresh_path, per_worker, read_table, small_batches, stage

TOKENIZER, END_ID = "byte_bpe_50k.json", 2
ROW_INDEX, STRIPE_BYTES = 1000, 16 << 20
#: Most pieces whose ids a worker keeps, and the longest of them.
KEPT_PIECES, KEPT_LENGTH = 700_000, 40
#: White space, in pairs or of other kinds than a single space or line feed between two other characters.
_UNEVEN = ("  ", " \n", "\n ", "\n\n", *"\t\r\x0b\x0c\x1c\x1d\x1e\x1f")
_WIDE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_SAFE_CUT = re.compile("(?<=[!-~])(?= [!-~])")


def _irregular(text: str) -> bool:
    return any(map(text.__contains__, _UNEVEN)) or text[:1] in (" ", "\n") or text[-1:] in (" ", "\n") or not text.isascii() and _WIDE.search(text) is not None


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next from U+0100."""
    out = {b: chr(b) for b in (*range(33, 127), *range(161, 173), *range(174, 256))}
    for b in range(256):
        out.setdefault(b, chr(256 + len(out) - 188))
    return out


class Encoder:
    """Ids of whole texts, equal to the library's, with the ids of short pieces kept.

    A byte-level BPE splits a text before it merges bytes, and a space between two characters that
    are not white space always starts a new piece, as does a line feed there, and as punctuation
    after a letter does. Cut at these places, the pieces have the ids that they have in the text.
    Texts that hold an added token go to the library whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.bare: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}
        self.newline = self.whole("\n")

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def piece(self, text: str, space: bool) -> bytes:
        """Ids of a piece without white space, after a space or not."""
        kept = self.spaced if space else self.bare
        if ids := kept.get(text):
            return ids
        last = text[-1:]
        if last in ".,;:!?" and text[:-1].isalpha():  # the usual end of a sentence or clause
            ids = self.piece(text[:-1], space) + self.piece(last, False)
        elif text.isalpha():  # one piece for the merges: the model alone will do
            if text.isascii():
                word = self.letters[32] + text if space else text
            else:
                word = (" " * space + text).encode().decode("latin-1").translate(self.letters)
            tokens = self.tokenizer.model.tokenize(word)
            ids = array("I", [t.id for t in tokens]).tobytes()
        else:
            core = text.rstrip(".,;:!?")
            if core != text and core and core[-1].isalpha():
                ids = self.piece(core, space) + self.piece(text[len(core):], False)
            else:
                ids = self.whole(" " * space + text)
        if len(text) <= KEPT_LENGTH and len(kept) < KEPT_PIECES:
            kept[text] = ids
        return ids

    def word(self, text: str) -> bytes:
        """Ids of a word after a space, or of a line feed and the word after it."""
        return self.newline + self.piece(text[1:], False) if text[:1] == "\n" else self.piece(text, True)

    def encode(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids; none for null or empty."""
        if not text:
            return b""
        if any(map(text.__contains__, self.added)):  # the library cuts these out before anything else
            return self.whole(text)
        if not _irregular(text):
            first, *rest = text.replace("\n", " \n").split(" ")
            return self.piece(first, False) + b"".join(map(self.word, rest))
        cut = _SAFE_CUT.split(text)  # all but the first start with a space
        return b"".join([self.whole(x) if _irregular(x[i > 0:]) or "\n" in x else self.piece(x[1:], True) if i else self.piece(x, False)
                         for i, x in enumerate(cut)])

    def encode_all(self, texts: pa.Array, end: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with ``end``, and how many each has. Distinct words of the batch are looked up once."""
        plain = [bool(t) and not any(map(t.__contains__, self.added)) and not _irregular(t) for t in texts.to_pylist()]
        regular = pc.if_else(pa.array(plain, pa.bool_()), pc.fill_null(texts, ""), "")
        words = pc.split_pattern(pc.replace_substring(regular, "\n", " \n"), " ")  # one word at least
        coded = words.flatten().dictionary_encode()
        at = words.offsets.to_numpy().astype(np.int64) - words.offsets[0].as_py()
        distinct, get = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self.spaced.get
        known = [get(w) or self.word(w) if w else b"" for w in distinct]
        index = coded.indices.to_numpy().astype(np.int64)
        # the first word of a text stands after no space; other texts are one word
        firsts = [distinct[i] for i in index[at[:-1]].tolist()]
        index[at[:-1]] = len(known) + np.arange(len(firsts))
        known += [self.piece(w, False) if ok else self.encode(t) for ok, w, t in zip(plain, firsts, _lazy(texts, plain))]
        table, length = np.frombuffer(b"".join(known) + end, np.int32), np.array([len(x) // 4 for x in known] + [len(end) // 4], np.int64)
        start = np.cumsum(length) - length
        index = np.insert(index, at[1:], len(known))  # the end id after each text
        sizes = length[index]
        ends = np.cumsum(sizes)
        ids = table[np.repeat(start[index] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.diff(np.append(0, ends[at[1:] + np.arange(len(firsts))]))


def _lazy(texts: pa.Array, plain: list[bool]) -> Iterator[str | None]:
    """The texts that are not plain; None for the others."""
    return (None if ok else texts[i].as_py() for i, ok in enumerate(plain))


def _encoder(tokenizer: str) -> Encoder:
    def build() -> Encoder:
        import public_tokenizers

        return Encoder(tokenizer if Path(tokenizer).is_absolute() else public_tokenizers.path(tokenizer))

    return per_worker(f"encoder {tokenizer}", build)


def write_tokens(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every row of ``docs`` and write ``part, doc_id, start, n_tokens, ids`` as ORC to ``path``.

    Files ascend by document id (null first, ties by text); ``start`` counts the ids before the row in
    its file. A null text is encoded as the empty one: the end id alone. Repeated rows are repeated.
    ``tokenizer`` is a file of the public tokenizers or an absolute path; executors open it.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    end = array("I", [end_id]).tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, total = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, sizes = encoder.encode_all(batch.column(1), end)
            ends = np.cumsum(sizes)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(sizes), part, np.int32)), batch.column(0), pa.array(total + ends - sizes),
                                              pa.array(sizes), lists], ["part", "doc_id", "start", "n_tokens", "ids"])
            total += int(sizes.sum())

    (rows.mapInArrow(encode, "part int, doc_id bigint, start bigint, n_tokens bigint, ids array<int>").write
     .option("compression", "zstd").option("orc.stripe.size", STRIPE_BYTES).option("orc.row.index.stride", ROW_INDEX)
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", 0.01).orc(path))


_SCHEMA = "part int, doc_id bigint, start bigint, n_tokens bigint, ids array<int>"


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids`` from the files; ``start`` counts all ids of the files before, too."""
    rows = spark.read.schema(_SCHEMA).orc(path)
    sums = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # reads two columns
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(sums.select(F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")), "tokens-offsets")
    return rows.join(F.broadcast(offsets), F.col("part") == F.col("p")).select("doc_id", (F.col("offset") + F.col("start")).alias("start"), "ids")


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """``doc_id, ids`` of some documents; stripes and row groups without them are skipped."""
    return spark.read.schema(_SCHEMA).orc(path).where(F.col("doc_id").isin(doc_ids)).select("doc_id", "ids")


def ids_crc32(ids: Column) -> Column:
    @arrow_udf("bigint")
    def of(lists: pa.Array) -> pa.Array:
        data, ends = lists.values.to_numpy(zero_copy_only=False).astype("<u4"), lists.offsets.to_numpy()
        return pa.array([zlib.crc32(data[a:b].tobytes()) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.int64())

    return of(ids)


def op4_token_orc(spark, sf_dir: str) -> DataFrame:
    """Contract query over all ``documents``: written, then read back."""
    path = fresh_path(spark, "tokens-orc")
    write_tokens(read_table(spark, sf_dir, "documents"), path)
    return read_tokens(spark, path).select("doc_id", "start", F.size("ids").cast("long").alias("n_tokens"), ids_crc32(F.col("ids")).alias("ids_crc32"))
