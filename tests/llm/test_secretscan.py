import hashlib
import math
import random
import re

from pyspark.sql import functions as F

from harvestframe.llm import secretscan as S

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)


def brute_base(text):
    text = text or ""
    spans = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(spans + [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def brute_p(token, symbols):
    v, n, k = [symbols.index(c) for c in token], len(token), len(symbols)
    phi = lambda z: 0.5 * math.erfc(z / math.sqrt(2))
    chi = (k / n * sum(v.count(x) ** 2 for x in set(v)) - n - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n)
    high = [2 * x >= k for x in v]
    runs, h = 1 + sum(a != b for a, b in zip(high, high[1:])), sum(high)
    mean = 1 + 2 * h * (n - h) / n
    z = (runs - mean) / math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
    m = sum(v) / n
    var = sum((x - m) ** 2 for x in v)
    r = ((sum((a - m) * (b - m) for a, b in zip(v, v[1:])) / var if var else 1.0) + 1 / n) * math.sqrt(n)
    half = -sum(math.log(max(p, 1e-300)) for p in (phi(chi), min(1, 2 * phi(abs(z))), min(1, 2 * phi(abs(r)))))
    return math.exp(-half) * (1 + half + half * half / 2)


def noise(rng, symbols, n):
    return "".join(rng.choice(symbols) for _ in range(n))


def test_base_spans(df, docs, spark):
    extra = ["token=token=abcdefg", 'API_KEY"  :"abcdef', "secret: token: abcdefgh password=x1", "AKIA" + "A" * 15, "AKIA" + "A" * 16 + "AKIA" * 9, "é\U0001f600 passwd = é TOKEN=a.b-c/d_e+f= \U0001f600 " + "ab" * 12,
             " ".join("token=abcdef%d" % i for i in range(1500)), "\n".join(["0123456789abcdef" * 3] * 700), "x" * 200_000 + " secret=abcdefgh"]
    texts = [d[1] for d in docs] + extra
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for i, base in S.secret_spans(frame).select("doc_id", "base").collect():
        assert [(s.start, s.rank, s.kind, s.end) for s in base] == brute_base(texts[i]), texts[i][:80]


def test_battery_against_exact_formulas(spark):
    rng = random.Random(3)
    tokens = [noise(rng, symbols, n) for _, _, symbols in S.ALPHABETS for n in (20, 33, 64, 300)] + ["a1" * 15, "0" * 40, "user_name_of_the_last_login_1", "abcdefghijklmnopqrstuvwxyz0123456789"]
    rows = spark.createDataFrame([(t, s) for t in tokens for _, p, s in S.ALPHABETS if re.fullmatch(p, t)], "t string, s string")
    for t, s, p in rows.select("t", "s", S.p_random(F.col("t"), F.col("s"))).collect():
        assert abs(p - brute_p(t, s)) < 1e-4 * max(1, abs(math.log10(max(p, 1e-300)))), (t, s)


def test_noise_is_claimed_and_names_are_not(spark):
    rng = random.Random(9)
    names = ["error", "handler", "request", "user", "profile", "message", "payload", "index", "table", "column", "service", "version"]
    docs, secret = [], {}
    for i in range(300):
        key = noise(rng, S.ALPHABETS[6][2], rng.randint(36, 48))
        name = "_".join(rng.choice(names) for _ in range(5)) + "_1"
        docs.append((i, f"see {name} and {key if i % 2 else name + '2'} there"))
        secret[i] = key if i % 2 else None
    docs += [(1000, None), (1001, ""), docs[1], docs[1]]
    rows = S.secret_spans(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    texts = dict(docs)
    found = [[texts[r.doc_id][s.start:s.end] for s in r.found] for r in rows]
    hits = sum(secret.get(r.doc_id) is not None and f == [secret[r.doc_id]] for r, f in zip(rows, found))
    wrong = sum(secret.get(r.doc_id) is None and bool(f) for r, f in zip(rows, found))
    assert len(rows) == len(docs) and hits >= 0.9 * 152 and wrong <= 0.1 * hits


def test_thin_strata_of_noise_are_claimed(spark):
    rng = random.Random(11)
    symbols = {a: s for a, _, s in S.ALPHABETS}
    for size, least in ((1, 0.9), (3, 0.9), (10, 0.9), (100, 0.85), (1000, 0.95)):
        share = []
        for _ in range(200):
            ps = [rng.random() for _ in range(size)]
            counts = [sum(int(p * S.BINS) == b for p in ps) for b in range(S.BINS)]
            cut = S.cuts_of({("hex_upper", 6): counts}).get(("hex_upper", 6), 2.0)
            share.append(sum(p >= cut for p in ps) / size)
        assert sum(share) / len(share) >= least, size
    crowd = [5000] + [50] * 30 + [0] * (S.BINS - 31)
    assert S.cuts_of({("base32", 5): [0] * 60 + [1] + [0] * 39, ("base32", 6): crowd}) == {("base32", 5): S.THIN_CUT}
    keys = [noise(rng, symbols[a], length) for a, length, k in (("hex_upper", 64, 1), ("base32", 40, 3), ("base62", 90, 10)) for _ in range(k)]
    docs = spark.createDataFrame([(i, f"see {k} there") for i, k in enumerate(keys)], "doc_id bigint, text string")
    hits = sum([(s.start, s.end) for s in r.found] == [(4, 4 + len(keys[r.doc_id]))] for r in S.secret_spans(docs).collect())
    assert hits >= 13


def test_copies_do_not_move_the_cuts(spark):
    rng = random.Random(13)
    ps = [rng.random() for _ in range(1000)]
    names = [rng.random() ** 12 for _ in range(2000)] + ps[:100]

    def cut(tokens):
        rows = [([("base62", 5, i, p)],) for i, p in tokens]
        return S.cuts(spark.createDataFrame(rows, "tokens array<struct<alphabet:string,length_class:int,hash:bigint,p:double>>"))

    for ps, p, copies in ((ps, 0.45, 300), (names, 0.95, 5000)):
        once = list(enumerate([*ps, p]))
        assert cut(once) == cut(once + once[-1:] * copies) != {}
    key, other = noise(rng, S.ALPHABETS[5][2], 40), noise(rng, S.ALPHABETS[5][2], 40)
    docs = spark.createDataFrame([(i, f"see {key if i else other} there") for i in range(50)], "doc_id bigint, text string")
    rows = S.random_candidates(F.col("text"))
    assert len({t.hash for r in docs.select(rows.alias("tokens")).collect() for t in r.tokens}) == 2


def test_keys_in_paths_and_keys_without_digits(spark):
    rng = random.Random(17)
    url, b64, b62 = S.ALPHABETS[7][2], S.ALPHABETS[6][2], S.ALPHABETS[5][2]
    given = {"com/my-app/hooks/Zk3Qv9+Xr1Tb7Lw2Pd8Nc4": "Zk3Qv9+Xr1Tb7Lw2Pd8Nc4", "path/to_file/9f8A7bC6d5E4f3A2b1C0d9E8==": "9f8A7bC6d5E4f3A2b1C0d9E8=="}
    rows = spark.createDataFrame([(t,) for t in given], "text string")
    for r in rows.select("text", S.random_candidates(F.col("text")).alias("tokens")).collect():
        assert given[r.text] in [r.text[t.start:t.end] for t in r.tokens]
    texts = {}
    for symbols, n in ((url, 40), (b64, 48), (b62[10:], 24)):
        key = noise(rng, symbols, n)
        texts[f"é my-app/{key}" if symbols is not b64 else f"some_name-{key}"] = key
    texts[key] = key  # letters only, by itself
    texts["my-app/some_name/handlers/index"] = texts["-" * 30 + "/+_"] = None
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    spans = {r.doc_id: r.found for r in S.secret_spans(docs).collect()}
    for i, (text, key) in enumerate(texts.items()):
        found = [text[s.start:s.end] for s in spans[i]]
        assert any(f in key or key in f for f in found) if key else not found, (text, found)
        assert all(a.end <= b.start for a, b in zip(spans[i], spans[i][1:]))


def test_query_digest(spark, df, docs):
    rows = S.secret_spans(df).select("doc_id", S._written(F.col("base")).alias("w")).collect()
    want = sorted(str((d[0], ",".join(f"{k}:{a}:{b}" for a, _, k, b in brute_base(d[1])))) for d in docs)
    assert sorted(str(tuple(r)) for r in rows) == want
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(F.lit("").cast("binary"), 256)).first()[0]


def test_empty(nothing):
    assert S.secret_spans(nothing).count() == 0
