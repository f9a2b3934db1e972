import hashlib
import os
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from harvestframe.llm import exactdedup as X


def digests(n, salt=""):
    return [hashlib.sha256(f"{salt}{i}".encode()).digest() for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 2, 7, 1000, 20000])
def test_function_is_minimal_and_perfect(n):
    keys = digests(n)
    sizes, bits = X.build_function(keys)
    assert sorted(X.evaluate(sizes, bits, keys).tolist()) == list(range(n))
    assert len(bits) <= 1 + n and sum(sizes) <= 8 * len(sizes) + 5 * n  # a few bits a digest
    strange = X.evaluate(sizes, bits, digests(500, "other"))
    assert ((strange >= -1) & (strange < max(n, 1))).all()


def brute(docs):
    groups = defaultdict(list)
    for i, (id_, text, *_) in enumerate(docs):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append(i)
    out = []
    for key, rows in groups.items():
        first = min(rows, key=lambda i: (-len(docs[i][1] or ""), docs[i][0] is None, docs[i][0] or 0))
        out += [(docs[i][0], docs[first][0], len(rows), hashlib.sha256(key.encode()).hexdigest()) for i in rows]
    return sorted(out, key=str)


@pytest.mark.parametrize("share", [0, 1, 2])
def test_groups_equal_brute_force(spark, docs, df, share):
    """Nothing, half and all of the rows as the earlier corpus give the same groups."""
    earlier = F.pmod(F.xxhash64("doc_id"), F.lit(2)) < share
    got = X.exact_groups(df, earlier).select("id", "keep_id", "group_size", F.lower(F.hex("digest")).alias("h"), "kept", "in_index").collect()
    assert sorted([tuple(r)[:4] for r in got], key=str) == brute(docs)
    kept = defaultdict(int)
    for r in got:
        kept[r.h] += r.kept
        assert not r.kept or r.id == r.keep_id
    assert set(kept.values()) == {1}


def test_small_buckets_and_hot_groups(spark, to_frame, monkeypatch):
    """Many buckets, each looked up by several tasks, and groups beyond the broadcast share."""
    monkeypatch.setattr(X, "HOT", 5)
    docs = [(i, f"text {i % 400}" if i % 3 else " the same\n", "en", "s", 1) for i in range(1500)]
    rows = X.text_digest(F.col("text"))
    frame = to_frame(docs)
    index = X.build_index(X.digest_groups(frame.where("doc_id < 300").select(rows.alias("digest"), F.struct("doc_id").alias("rank"))), bucket=16)
    slots = sorted(r.slot for r in index.slots.select("slot").collect())
    assert index.buckets > 5 and slots == list(range(len(slots)))
    asked = X.digest_groups(frame.select(rows.alias("digest"), F.struct("doc_id").alias("rank")))
    found = X.look_up(index, asked, bucket=16).collect()
    known = {r.digest for r in index.slots.collect()}
    assert len(found) == len({r.digest for r in found}) == asked.count()
    assert all((r.slot is not None) == (r.digest in known) for r in found)
    got = X.exact_groups(frame, F.col("doc_id") < 300).select("id", "keep_id", "group_size", F.lower(F.hex("digest"))).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(docs)


def test_new_texts_against_an_index(spark, docs, df):
    index = X.build_index(X.digest_groups(df.where("doc_id < 20").select(X.text_digest(F.col("text")).alias("digest"), F.struct("doc_id").alias("rank"))))
    squeeze = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    seen = {squeeze(d[1]) for d in docs if d[0] is not None and d[0] < 20}
    got = X.new_texts(df.withColumn("digest", F.lit("d")).withColumn("rank", F.lit("r")), index)
    rows = got.collect()
    assert got.columns == [*df.columns, "digest", "rank"] and {(r.digest, r["rank"]) for r in rows} <= {("d", "r")}
    assert sorted(squeeze(r.text) for r in rows) == sorted({squeeze(d[1]) for d in docs} - seen)


def test_nothing_and_random_bytes(spark, nothing):
    assert X.exact_groups(nothing, F.lit(True)).count() == X.exact_groups(nothing, F.lit(False)).count() == 0
    rng = np.random.default_rng(3)
    keys = list({rng.bytes(32) for _ in range(3000)} | {os.urandom(32)})
    sizes, bits = X.build_function(keys)
    assert len(set(X.evaluate(sizes, bits, keys).tolist())) == len(keys)
