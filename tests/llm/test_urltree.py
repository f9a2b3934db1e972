import collections
import random

from harvestframe.llm import urltree as U


def brute_parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    end = min((tail.find(c) for c in "?#" if c in tail), default=len(tail))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), tail[:end]


def brute_rule(host, path):
    fits = [(len(h + p), h + p, a) for a, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def brute(urls):
    rows = []
    for u in urls:
        host, path = brute_parse(u)
        rule, action = brute_rule(host, path)
        core = path[1:] if path.startswith("/") else path
        core = core[:-1] if core.endswith("/") else core
        rows.append([host, path, rule, action, {"block": 1, "allow": 0}.get(action), core.split("/"), ""])
    for d in range(max(len(r[5]) for r in rows)):
        branch = collections.defaultdict(lambda: [0, 0, 0])
        node = collections.defaultdict(lambda: [0, 0, 0])
        for r in rows:
            if len(r[5]) > d:
                for c in (branch[r[0], r[6], r[5][d]], node[r[0], r[6]]):
                    c[0] += 1
                    c[1] += r[4] == 1
                    c[2] += r[4] == 0

        def literal(key):
            n, *own = branch[key]
            big, *whole = node[key[:2]]
            if n < U.MIN_PAGES:
                return False
            if n == big:
                return True
            for a, b in zip(own, whole):
                pooled = b / big
                spread = (pooled * (1 - pooled) * (1 / n + 1 / (big - n))) ** 0.5
                if spread > 0 and abs(a / n - (b - a) / (big - n)) >= U.MIN_Z * spread:
                    return True
            return False

        for r in [r for r in rows if len(r[5]) > d]:
            r.append("/" + (r[5][d] if literal((r[0], r[6], r[5][d])) else "*"))
        for r in rows:
            r[6] += r.pop() if len(r) > 7 else ""
    t, h = collections.defaultdict(lambda: [0, 0, 0]), collections.defaultdict(lambda: [0, 0])
    for r in rows:
        for c in (t[r[0], r[6]],):
            c[0] += 1
            c[1] += r[4] == 1
            c[2] += r[4] is not None
        h[r[0]][0] += r[4] == 1
        h[r[0]][1] += r[4] is not None
    labelled = sum(x[1] for x in h.values())
    share = sum(x[0] for x in h.values()) / labelled if labelled else 0.0
    out = []
    for host, path, rule, action, _, _, template in rows:
        n, b, lab = t[host, template]
        prior = (h[host][0] + U.SMOOTHING * share) / (h[host][1] + U.SMOOTHING)
        bad = (b + U.SMOOTHING * prior) / (lab + U.SMOOTHING) >= U.REJECT and lab >= U.LABELLED * n
        out.append((host, path, rule, action or ("block" if bad else "allow"), template))
    return out


def make():
    rng = random.Random(4)
    urls = [None, "", "no scheme", "http://", "HTTPS://WWW.Example.NET", "http://x.example.net/en", "http://x.example.net/en/1?q=/de/", "http://org/fr/", "http://a.org/fr/x#y", "ftp://É.Org/fr/1",
            "http://example.com/de/9", "http://notexample.com/de/9", "http://a.net/" + "d/" * 30, "http://q.example.com/" + "z" * 5000]
    for host, n in (("big.example.com", 400), ("mid.example.com", 60), ("b.org", 80), ("c.example.net", 90)):
        for _ in range(n):
            lang = rng.choice(["de", "de", "en", "fr", "es"])
            urls.append(f"http://{host}/{lang}/{rng.randint(0, 10**6)}{rng.choice(['', '/', '.html'])}")
    deep = "/".join("abcdefghij")
    urls += [f"http://deep.example.com/{lang}/{deep}/{lang}{i % 3}" for lang in ("de", "en") for i in range(30)]  # differs beyond eight segments
    urls += [f"http://broad.example.com/{'de' if i < 8 else 'en'}/{i}" for i in range(700)]  # a branch of 1 % of its node
    urls += [f"http://few.example.com/{'de' if i % 10 else 'xx' + str(i)}/{i}" for i in range(60)]
    urls += [f"http://few{i}.example.com/{lang}/{i}" for i in range(3) for lang in ("de", "de", "de", "de", "en")]
    return urls + urls[20:25] * 3


def test_equal_to_brute_force(spark):
    urls = make()
    pages = spark.createDataFrame([(i, u, "h", "t", "r") for i, u in enumerate(urls)], "page_id bigint, url string, host string, template string, rule string").repartition(3)
    rows = sorted(U.judged_urls(pages).collect(), key=lambda r: r.page_id)
    want = brute(urls)
    for r, w, u in zip(rows, want, urls, strict=True):
        assert (r.host, r.path, r.rule, r.verdict, r.template) == w, u
    assert any(w[2] is None and w[3] == "block" for w in want), "no page is rejected by its template"


def test_empty(spark):
    assert U.judged_urls(spark.createDataFrame([], "page_id bigint, url string")).count() == 0
