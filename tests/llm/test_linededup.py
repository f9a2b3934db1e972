import collections

from harvestframe.llm import linededup as L


def brute(docs):
    """New text of each document, in the order of ids."""
    seen, out = {}, []
    keys = sorted({(d[0] is None, d[0] or 0, d[1]) for d in docs if d[1] is not None}, key=lambda k: (k[0], k[1], ORDER(k)))
    new = {}
    for key in keys:
        lines = key[2].split("\n")
        held = [i for i, x in enumerate(lines) if x.strip(" \t\n\v\f\r")]
        gone = set()
        for k in range(len(held) - 2):
            window = tuple(lines[i] for i in held[k:k + 3])
            if seen.setdefault(window, (key, k)) != (key, k):
                gone.update(held[k:k + 3])
        new[key] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(held), len(gone))
    for d in docs:
        out.append((d[0], *(new[d[0] is None, d[0] or 0, d[1]] if d[1] is not None else (None, 0, 0))))
    return out


ORDER = None


def test_equal_to_brute_force(spark, df, docs):
    global ORDER
    hashes = {(r[0], r[1]): r[2] for r in df.selectExpr("doc_id", "text", "xxhash64(doc_id, text)").collect()}
    ORDER = lambda k: hashes[None if k[0] else k[1], k[2]]
    out = L.dedup_lines(df)
    assert set(out.columns) == set(df.columns) | {"removed_lines"}
    got = collections.Counter(map(tuple, out.select("doc_id", "text", "n_lines", "removed_lines").collect()))
    want = collections.Counter(brute(docs))
    assert got == want and sum(w[3] > 0 for w in want) > 5


def test_overlaps_leave_the_earliest_copy(to_frame):
    docs = [(0, "a\nb\nc\nd", "", "", 0), (1, "a\nb\nc\nd\ne", "", "", 0), (2, "x\nx\nx\nx\nx", "", "", 0), (3, "p\n\na\nb\n \nc\nq", "", "", 0), (4, "a\nb", "", "", 0)]
    got = dict(L.dedup_lines(to_frame(docs)).select("doc_id", "text").collect())
    assert got == {0: "a\nb\nc\nd", 1: "e", 2: "x", 3: "p\n\n \nq", 4: "a\nb"}


def test_empty(nothing):
    assert L.dedup_lines(nothing).count() == 0
