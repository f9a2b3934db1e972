import random

from harvestframe.llm import decontam as D


def brute(docs, items):
    out = []
    for i, text in docs:
        there = D.shingles(D.normal_words(text and text.encode()))
        for k, t in set(items):
            parts = D.shingles(D.normal_words(t and t.encode()))
            shared = len(parts & there)
            if parts and 100 * shared >= 80 * len(parts):
                out.append((i, k, shared, len(parts)))
    return sorted(out, key=str)


def words(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n)]


def make(seed=11):
    rng = random.Random(seed)
    items = [(i, " ".join(words(rng, n))) for i, n in enumerate([5, 6, 9, 14, 20, 21, 36, 37, 60, 68, 69, 140, 3, 1, 500])]
    items += [(50, None), (51, ""), (52, " \n"), items[3], (53, items[3][1])]
    docs = []
    for i in range(60):
        body = words(rng, rng.choice([0, 4, 30, 300, 2500]))
        for _ in range(rng.choice([0, 1, 1, 2])):
            item = (items[rng.randrange(15)][1]).split()
            if rng.random() < 0.4 and len(item) > 8:  # near copies: a word changed, a part left out
                item[rng.randrange(len(item))] = "other"
                item = item[: rng.randint(int(0.7 * len(item)), len(item))]
            at = rng.randint(0, len(body))
            body[at:at] = item
        docs.append((i, rng.choice([" ", "\n", "  ", "\t"]).join(body).upper()))
    halves = items[8][1].split()  # an item scattered over a long document
    docs.append((70, " ".join([*halves[:40], *words(rng, 3000), *halves[36:]])))
    docs += [(71, None), (72, ""), (73, items[12][1]), (74, items[12][1] + " more words here now"), docs[1], docs[1], (None, items[5][1])]
    return docs, items


def test_equal_to_brute_force(spark):
    docs, items = make()
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id bigint, text string, item_id string").repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute(docs, items)
    assert sorted(map(tuple, D.contaminated(frame, bench).collect()), key=str) == want and len(want) > 30
    dirty = {d for d, *_ in want}
    kept = D.clean(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(str(r[0]) for r in kept.collect()) == sorted(str(d[0]) for d in docs if d[0] not in dirty)


def test_stretches_and_blocks_change_nothing(spark, monkeypatch):
    docs, items = make(12)
    want = brute(docs, items)
    monkeypatch.setattr(D, "STRETCH", 256)
    searcher = D.Searcher([(k, t and t.encode()) for k, t in set(items)])
    got = [(docs[n][0], k, a, b) for n, k, a, b in searcher.search([t and t.encode() for _, t in docs])]
    assert sorted(got, key=str) == want
    monkeypatch.setattr(D, "BLOCK_ITEMS", 5)
    frame, bench = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert len(list(D._blocks(bench, "item_id", "text"))) > 2
    assert sorted(map(tuple, D.contaminated(frame, bench).collect()), key=str) == want


def test_recall_of_partial_copies():
    """Items of any size, 80 % of their shingles in a row within a long document, are found."""
    rng, missed = random.Random(2), 0
    for trial in range(150):
        item = words(rng, rng.randint(10, 120))
        n = -(-80 * (len(item) - 4) // 100) + 4
        doc = words(rng, rng.randint(0, 2000))
        at = rng.randint(0, len(doc))
        doc[at:at] = item[:n]
        missed += not D.Searcher([(1, " ".join(item).encode())]).search([" ".join(doc).encode()])
    assert missed == 0


def test_empty(spark, nothing, df):
    bench = spark.createDataFrame([(1, "some item of a few words")], "item_id bigint, text string")
    assert D.contaminated(nothing, bench).count() == 0 and D.clean(nothing, bench).count() == 0
    assert D.contaminated(df, bench.limit(0)).count() == 0 and D.clean(df, bench.limit(0)).count() == df.count()
