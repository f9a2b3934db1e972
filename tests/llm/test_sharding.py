import zlib

import pytest
from pyspark.sql import functions as F

from harvestframe.llm import sharding as S


def test_positions(df, docs):
    rows = S.shard_positions(df).collect()
    assert sorted(((r["__id"] is None, r["__id"] or 0, r["__size"], r["__crc"]) for r in rows)) == sorted(
        (d[0] is None, d[0] or 0, len((d[1] or "").encode()) + 1, zlib.crc32((d[1] or "").encode())) for d in docs)
    slots, sizes = {}, {}
    for r in rows:
        slots.setdefault(r["__shard"], []).append(r["__slot"])
        sizes[r["__shard"]] = sizes.get(r["__shard"], 0) + r["__size"]
    assert set(slots) <= set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_curve = sorted(rows, key=lambda r: (r["__shard"], r["__slot"]))
    assert [r["__h"] for r in by_curve] == sorted(r["__h"] for r in rows)


def test_bytes_are_near_equal(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "repeat('x', cast(id * 37 % 900 AS int)) AS text", "concat('l', id % 3) AS lang", "if(id % 3 = 0, 'hot', concat('s', id % 40)) AS source")
    sizes = [r[0] for r in S.shard_positions(docs).groupBy("__shard").agg(F.sum("__size")).select("sum(__size)").collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 2 * 901


@pytest.mark.parametrize("n,bits", [(2, 3), (3, 2), (4, 2)])
def test_curve_visits_neighbours(spark, n, bits):
    """Every cell once, and each step moves by one in one dimension."""
    side = 1 << bits
    cells = spark.range(side**n).select(*[((F.col("id") / side**i).cast("long") % side).alias(f"c{i}") for i in range(n)])
    # a linear dimension over 0 .. side-1 puts each value into a cell of its own
    path = [tuple(r) for r in S.with_curve_index(cells, [(f"c{i}", "linear") for i in range(n)], bits).orderBy("__h").select(*[f"c{i}" for i in range(n)], "__h").collect()]
    assert [p[-1] for p in path] == list(range(side**n))
    assert all(sum(abs(a - b) for a, b in zip(p[:-1], q[:-1])) == 1 for p, q in zip(path, path[1:]))


def test_sharded_rows_and_manifest(df, docs):
    out = S.sharded(df)
    assert set(out.columns) == set(df.columns) | {"hilbert"}
    rows = out.collect()
    assert len(rows) == len(docs) and {type(r["shard"]) for r in rows} == {int}
    ends = {r["shard"]: r for r in S.manifest(out, ["hilbert", "doc_id"]).collect()}
    order = sorted(ends)
    assert all(ends[a]["max_hilbert"] <= ends[b]["min_hilbert"] for a, b in zip(order, order[1:]))
    assert sum(r["n_rows"] for r in ends.values()) == len(docs)


def test_empty(nothing):
    assert S.shard_positions(nothing).count() == 0 and S.sharded(nothing).count() == 0
