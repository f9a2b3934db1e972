import collections
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from harvestframe.llm import mixing as M
from harvestframe.llm.common import row_key


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: float(i % 3 + 1) for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > 3 * sizes[s]]
        if not over:
            target.update({s: left * weight[s] / total for s in free})
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
        left -= sum(target[s] for s in over)
        free -= set(over)
    return target


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def sizes_of(docs):
    out = collections.Counter()
    for d in docs:
        out[d[3]] += n_words(d[1])
    return out


def test_mix_of_documents(spark, df, docs):
    rows = [r.asDict() for r in M.mix(df).collect()]
    sizes, target = sizes_of(docs), brute_targets(sizes_of(docs))
    assert sum(r["times"] for r in rows) == len(docs)
    taken, largest = collections.Counter(), collections.Counter()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - target[r["source"]]) < 1e-6 * (1 + r["target"])
        rate = r["target"] / r["source_size"] * r["times"]
        assert int(rate + 1e-9) <= r["copies"] + 1e-9 and r["copies"] <= -(-rate // 1) + 1e-9
        taken[r["source"]] += r["size"] * r["copies"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in sizes)
    again = M.mix(df.repartition(5)).select("row", "copies").collect()
    assert sorted(map(tuple, again)) == sorted((r["row"], r["copies"]) for r in rows)


def test_take_mix(df, docs):
    out = M.take_mix(df)
    assert out.columns == df.columns
    got = collections.Counter(r[0] for r in out.collect())
    want = collections.Counter()
    for r in M.mix(df).collect():
        want[r.doc_id] += r.copies
    assert got == +want


def test_targets_cap_and_reshare(spark):
    for sizes in ({"a": 10, "b": 1000, "c": 5, None: 400, "": 0, "\U0001f600": 7, "z": 90}, {"x": 0, "y": 0}, {"only": 12}):
        rows = M.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")).collect()
        want = brute_targets(sizes)
        assert {r.source for r in rows} == set(want) and all(abs(r.target - want[r.source]) < 1e-9 * (1 + r.target) for r in rows)


def test_many_leaves_meet_the_target(spark, monkeypatch):
    monkeypatch.setattr(M, "LEAF", 20)
    monkeypatch.setattr(M, "FAN", 4)
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('w ', cast(1 + id * 7919 % 400 AS int)) AS text", "if(id % 3 = 0, 'big', concat('s', id % 5)) AS source")
    rows = M.mix(docs).groupBy("source").agg({"target": "max", "*": "count"}).count()
    assert rows == 6
    got = {r[0]: (r[1], r[2]) for r in M.mix(docs).selectExpr("source", "target", "size * copies AS t").groupBy("source").agg({"target": "max", "t": "sum"}).collect()}
    assert all(abs(a - b) <= 0.01 * max(a, b) for a, b in got.values())


@pytest.mark.parametrize("n", [1, 2, 3, 8, 200])
def test_rounding_keeps_mass_and_inclusion_rates(n):
    rng = np.random.default_rng(n)
    size = np.sort(rng.integers(1, 100, n))[::-1]
    p = np.full(n, 0.3) if n % 2 == 0 else rng.random(n)
    p[3::4] = 0.7
    runs = 6000 if n < 100 else 1500
    mean, left = np.zeros(n), []
    for _ in range(runs):
        q, at = M.rounded(size, p, rng.random(n), rng.random(n))
        assert abs(q @ size - p @ size) < 1e-6 * size.sum()
        assert all(x in (0.0, 1.0) or i == at for i, x in enumerate(q))
        if at >= 0:
            left.append(size[at])
            q[at] = rng.random() < q[at]
        mean += q / runs
    assert (np.abs(mean - p) <= 4 * np.sqrt(p * (1 - p) / runs) + 1e-9).all()
    if n == 200:
        assert np.mean(left) <= 20  # mostly a small one of each class is left over


def test_inclusion_rates_of_the_operator(spark):
    """Sources of three unequal documents each: every document is taken at its source's rate."""
    docs = [(s * 3 + k, f"s{s} " + "w " * (n - 1), f"{s:04d}") for s in range(900) for k, n in enumerate((7, 5, 3))]
    rows = M.mix(spark.createDataFrame(docs, "doc_id bigint, text string, source string")).collect()
    rate = {r.source: r.target / r.source_size for r in rows}
    assert {round(x, 9) for x in rate.values()} == {0.5, 1.0, 1.5}
    for size in (7, 5, 3):
        for want in (0.5, 1.5):
            copies = [r.copies for r in rows if r.size == size and abs(rate[r.source] - want) < 1e-9]
            assert len(copies) == 300 and abs(np.mean(copies) - want) < 3.5 * 0.5 / 300 ** 0.5
    taken = collections.Counter()
    for r in rows:
        taken[r.source] += r.size * r.copies
    assert abs(sum(taken.values()) - 900 * 15) <= 4 * 7 * 900 ** 0.5


def test_rows_that_differ_in_nulls_alone(spark):
    """A null in one column or the other makes two rows; every name is allowed; maps are compared too."""
    docs = [(1, "a b c", None, "en", "r", "c", 1), (1, "a b c", "en", None, "r", "c", 1), (1, "a b c", "en", "en", None, "c", 1), (1, "a b c", "en", "en", "r", None, 1)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, row string, copies string, __again int")
    df = df.withColumn("more", F.create_map(F.lit("k"), F.col("lang")))
    assert len({r.row for r in M.mix(df).collect()}) == 4
    want = collections.Counter({r.row: r.copies for r in M.mix(df).collect()})
    got = collections.Counter(bytes(r[0]) for r in M.take_mix(df).select(row_key(df)).collect())
    assert got == +collections.Counter({bytes(k): v for k, v in want.items()})
    assert M.take_mix(df).columns == df.columns


def test_empty(nothing):
    assert M.mix(nothing).count() == 0 and M.take_mix(nothing).count() == 0
