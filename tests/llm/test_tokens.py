import random
import zlib
from array import array

import pytest

from harvestframe.llm import tokens as T
from harvestframe.llm.common import fresh_path

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def encoder():
    return T.Encoder(public_tokenizers.path(T.TOKENIZER))


def test_pieces_equal_whole_texts(encoder, docs):
    rng = random.Random(1)
    parts = [*"ab Z'\n\t 9.,!?\r\x0b\x1c", chr(0xE9), chr(0x3000), chr(0x85), chr(0x200D), chr(0x1F600), "'s", "don't", " the ", " \n", "ing,", "<|endoftext|>", " 12,5 ", "word.", "(x)"]
    texts = [d[1] or "" for d in docs] + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(5000)]
    for t in texts:
        assert encoder.encode(t) == encoder.whole(t), repr(t)


def test_added_tokens_as_the_plain_call(encoder):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path(T.TOKENIZER))
    rng = random.Random(2)
    parts = ["a", " ", "\n", "word.", "  ", *encoder.added, *encoder.added, encoder.added[0][:-1]]
    texts = ["a <|endoftext|> b", *["".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) for _ in range(2000)]]
    for t in texts:
        assert list(array("I", encoder.encode(t))) == plain.encode(t, add_special_tokens=False).ids, repr(t)
    assert 50256 in array("I", encoder.encode(texts[0]))


def test_round_trip(spark, df, docs, encoder):
    path = fresh_path(spark, "test-tokens")
    T.write_tokens(df, path)
    rows = sorted(T.read_tokens(spark, path).collect(), key=lambda r: r.start)
    ordered = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] is not None, (d[1] or "").encode()))
    start = 0
    for r, d in zip(rows, ordered, strict=True):
        ids = encoder.tokenizer.encode(d[1] or "", add_special_tokens=False).ids + [2]
        assert (r.doc_id, r.start, r.ids) == (d[0], start, ids)
        start += len(ids)
    crc = dict(T.read_tokens(spark, path).where("doc_id = 5").select("doc_id", T.ids_crc32(T.F.col("ids"))).collect())
    assert crc[5] == zlib.crc32(array("I", encoder.tokenizer.encode(docs[5][1], add_special_tokens=False).ids + [2]).tobytes())
    found = T.lookup(spark, path, [5, 2])
    assert sorted(r.doc_id for r in found.collect()) == [2, 2, 2, 2, 5]
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().toString()


def test_empty(spark, nothing):
    path = fresh_path(spark, "test-tokens")
    T.write_tokens(nothing, path)
    assert T.read_tokens(spark, path).count() == 0
