import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from harvestframe.llm import divergence as D

UNIT = 10 ** 9


def test_packed_numbers():
    rng = np.random.default_rng(2)
    for values in ([], [0], [127, 128, 0, 16383, 16384], (2 ** rng.uniform(0, 62, 5000)).astype(np.int64)):
        data, length = D.pack(np.array(values, np.int64))
        back, ends = D.unpack(data)
        assert back.tolist() == list(values) and ends.tolist() == np.cumsum(length).tolist()


def terms_of(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(D.TERM_CHARS, text or "")]


def brute(docs, min_docs=3, top=200):
    docs = [(t or "", lang or "", source or "") for _, t, lang, source, *_ in docs]
    df, n, by = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for t, lang, source in docs:
        words = Counter(terms_of(t))
        df[lang].update(words.keys())
        n[lang].update(words)
        by[lang, source].update(words)
        by[lang, source] += Counter()
    groups, out = {(lang, s) for _, lang, s in docs}, []
    for lang, source in groups:
        kept = [w for w, c in df[lang].items() if c >= min_docs]

        def prob(c):
            total = sum(c[w] for w in kept) + len(kept)
            return {w: 1 + UNIT * (c[w] + 1) // total for w in kept}

        mine, lang_p, pairs = prob(by[lang, source]), prob(n[lang]), []
        for other in [s for k, s in groups if k == lang and s != source]:
            q = prob(by[lang, other])
            pairs.append((-sum((mine[w] - q[w]) ** 2 // q[w] for w in kept), other.encode()))
        used = [(-((mine[w] - lang_p[w]) ** 2 // lang_p[w]), w.encode()) for w in kept if by[lang, source][w] and mine[w] > lang_p[w]]
        for part, rows in (("pair", sorted(pairs)), ("term", sorted(used)[:top])):
            out += [(lang, source, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(rows)]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_audit_equals_brute_force(spark, docs, df):
    assert result(D.audit(df)) == brute(docs)
    assert result(D.audit(df, min_docs=1, top=5)) == brute(docs, 1, 5)
    assert result(D.audit(df, min_docs=10 ** 6)) == brute(docs, 10 ** 6)


def test_small_blocks_and_tiles(spark, to_frame, monkeypatch):
    """Many blocks of documents, batches, blocks of terms and tiles of sources give the same result."""
    words = ["Word", "word,", "word-word", "(été)", "x1y2", "don't", " gap", "a\x85b", "_", "42", "A" * 300]
    docs = [(i, " ".join(words[(i * k) % len(words)] + "abcdefg"[k % 7] * (i % 3) for k in range(i % 40)), ["en", "de", None][i % 3], f"s{i % 9}" if i % 11 else None, 0)
            for i in range(150)]
    docs += [(i, "word word Word", "en", "s1", 0) for i in range(150, 200)] + [(999, "only here", "xx", "lone", 1)]
    want = brute(docs)
    for name, value in (("SPAN", 4), ("BLOCK_DOCS", 7), ("BLOCK_BYTES", 900), ("TERM_BLOCK", 3), ("TILE", 2), ("ROWS", 5)):
        monkeypatch.setattr(D, name, value)
    held = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    monkeypatch.setattr(D, "small_batches", lambda s: s.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3"))
    try:
        assert result(D.audit(to_frame(docs))) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)


def test_counts_of_terms(spark, to_frame):
    docs = [(1, "a A, (a)", "en", "x", 0), (2, "b a", "en", "y", 0), (3, "a", "de", "x", 0), (4, None, "en", "x", 0)]
    texts = to_frame(docs).select("lang", F.when(F.col("source") == "x", 0).otherwise(1).cast("long").alias("number"), F.coalesce("text", F.lit("")).alias("text"))
    got = {(r.lang, bytes(r.term)): (r.docs, r.n, sorted(tuple(s) for s in r.sources)) for r in D.term_counts(D.term_rows(D.chunk_rows(texts))).collect()}
    assert got == {("en", b"a"): (2, 4, [(0, 1, 3), (1, 1, 1)]), ("en", b"b"): (1, 1, [(1, 1, 1)]), ("de", b"a"): (1, 1, [(0, 1, 1)])}


def test_exact_beyond_64_bits(spark):
    row = spark.sql("select 30000000000L as n, 90000000000L as total, 5L as terms")
    assert row.select(D.probability("n", "total", "terms")).first()[0] == 1 + UNIT * 30000000001 // 90000000005
    n, total = np.array([[30000000000, 0]]), np.array([[90000000000, 90000000000]])
    assert D._probabilities(n, total, 5).tolist() == [[1 + UNIT * 30000000001 // 90000000005, 1 + UNIT // 90000000005]]


@pytest.mark.parametrize("text", [None, "", "1 2 -- 3"])
def test_no_terms(spark, to_frame, nothing, text):
    assert D.audit(nothing).count() == 0
    docs = [(1, text, "en", "a", 0), (2, text, "en", "b", 0), (3, text, "fr", "a", 0)]
    assert result(D.audit(to_frame(docs))) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
