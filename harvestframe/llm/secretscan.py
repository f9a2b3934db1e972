"""Secret scans: patterns, and a battery of randomness tests, in DataFrame functions only.

Tokens of 20 characters or more get the smallest alphabet that holds them (hex, base32, ...); runs
that no alphabet holds, as of a key in a path, are split at their separators. Tokens get three tests of the hypothesis that they are uniform noise in it: chi-squared over the symbols, runs
above and below the middle of the alphabet, and serial correlation of neighbours. Fisher's rule
combines the three. Short structured tokens pass such tests by chance more often than long ones, so
the cut is set per stratum of alphabet and length: noise has uniform p-values, hence twice the
tokens above 0.5 estimate how many are noise, and the cut is the least p at which the estimated
share of other tokens among those claimed stays within ``FALSE_SHARE``. Strata too thin for that
take a cut of their neighbours, or the level that noise of their length passes.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read_table, stage

#: kind: pattern, group of the value, least length of the value.
BASE = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
#: What finds a text that may hold the kind; for runs of one class the least length is part of it.
_PROBE = {"assign": BASE["assign"][0], "access": "AKIA[A-Z0-9]{16}", "hex": "[0-9a-f]{24}"}
TOKEN, TOKEN_PROBE = r"[A-Za-z0-9+/_-]{20,}={0,2}", r"[A-Za-z0-9+/_-]{20}"
FOUND = "random"
_LOWER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Alphabets, smallest first: name, pattern, symbols in order.
ALPHABETS = (
    ("hex", "[0-9a-f]+", _DIGITS + _LOWER[:6]),
    ("hex_upper", "[0-9A-F]+", _DIGITS + _LOWER[:6].upper()),
    ("base32", "[A-Z2-7]+", _LOWER.upper() + "234567"),
    ("base36", "[0-9a-z]+", _DIGITS + _LOWER),
    ("base36_upper", "[0-9A-Z]+", _DIGITS + _LOWER.upper()),
    ("base62", "[0-9A-Za-z]+", _DIGITS + _LOWER.upper() + _LOWER),
    ("base64", "[0-9A-Za-z+/]+", _LOWER.upper() + _LOWER + _DIGITS + "+/"),
    ("base64url", "[0-9A-Za-z_-]+", _LOWER.upper() + _LOWER + _DIGITS + "-_"),
)
#: Separators that a part of a run may hold, if the run fits no alphabet: all that fit one.
PARTS, PLAIN = ("+/", "+", "/", "_-", "_", "-", ""), " plain"
FALSE_SHARE, BINS = 0.1, 100
#: Least tokens of a stratum that sets its own cut. Noise falls below a p of 0.028, 0.007 and 0.0025 in
#: 5, 2 and 1 % of cases and below 0.075 in 10 % (simulated; alphabet and length hardly matter): the cut by
#: length class where there is nothing to estimate from, stricter for short tokens, and the highest of a thin stratum.
MIN_STRATUM, NULL_CUT, LONG_CUT, THIN_CUT = 100, {4: 0.028, 5: 0.007}, 0.0025, 0.075
_STRETCH = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda s, x: s + x)


def _ends(lengths: Column) -> Column:
    """Running sums of an array, over sums of stretches, so that long arrays take no quadratic time."""
    def sums(both: Column) -> Column:
        whole, parts = both["whole"], both["parts"]
        return F.transform(whole, lambda _, i: _total(F.slice(parts, F.lit(1), (i / _STRETCH).cast("int")))
                           + _total(F.slice(whole, (i / _STRETCH).cast("int") * _STRETCH + 1, i % _STRETCH + 1)))

    parts = let(lengths, lambda x: F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(x) / _STRETCH).cast("int") - 1, F.lit(0))),
                                               lambda b: _total(F.slice(x, b * _STRETCH + 1, F.lit(_STRETCH)))))
    return let(F.struct(lengths.alias("whole"), parts.alias("parts")), sums)


_NO_SPANS = "array<struct<start:bigint,end:bigint,value:string>>"


def matches(text: Column, pattern: str, probe: str, group: int) -> Column:
    """start, end and value of all matches, left to right; \\G makes each search begin where the last ended.

    The text before a match belongs to its piece, so that lengths give the places, in code points.
    """
    whole = f"(?s)\\G(.*?)({pattern})"
    at = lambda g: F.regexp_extract_all(text, F.lit(whole), F.lit(g))
    pieces = F.struct(at(0).alias("piece"), at(2).alias("match"), at(2 + group).alias("value"))

    def placed(m: Column) -> Column:
        lengths = F.transform(m["piece"], lambda x: F.length(x).cast("long"))
        return F.zip_with(F.arrays_zip(_ends(lengths).alias("end"), m["match"].alias("match")), m["value"],
                          lambda e, v: F.struct((e["end"] - F.length(e["match"])).alias("start"), e["end"].alias("end"), v.alias("value")))

    return F.when(F.rlike(text, F.lit(probe)), let(pieces, placed)).otherwise(F.array().cast(_NO_SPANS))


def base_spans(text: Column) -> Column:
    """rank, kind, start, end of the base matches that are long enough."""
    kinds = []
    for rank, (kind, (pattern, group, least)) in enumerate(BASE.items()):
        run = pattern if group else pattern[:-1] + f"{{{least - (len('AKIA') if kind == 'access' else 0)},}}"
        long_enough = F.filter(matches(text, run, _PROBE[kind], group), lambda m: F.length(m["value"]) >= least)
        kinds.append(F.transform(long_enough, lambda m: _span(m, rank, kind)))  # noqa: B023
    return F.concat(*kinds)


def _span(m: Column, rank: int, kind: str) -> Column:
    return F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), m["end"].alias("end"))


def _upper_tail(z: Column) -> Column:
    """1 - Phi(z) by Hastings' rational approximation (error below 1e-7)."""
    def tail(x: Column) -> Column:
        t = 1 / (1 + 0.2316419 * x)
        poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        return F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * poly

    return let(z, lambda v: let(tail(F.abs(v)), lambda p: F.when(v >= 0, p).otherwise(1 - p)))


def _two_sided(z: Column) -> Column:
    return F.least(2 * _upper_tail(F.abs(z)), F.lit(1.0))


def p_random(token: Column, symbols: Column) -> Column:
    """How well a token agrees with uniform noise over ``symbols``: Fisher's combination of three tests."""
    k = F.length(symbols).cast("double")

    def tests(v: Column) -> Column:
        n = F.size(v).cast("double")
        nth = lambda i: F.element_at(v, i)
        squares = F.aggregate(F.array_distinct(v), F.lit(0.0), lambda s, x: let(F.size(F.filter(v, lambda y: y == x)), lambda c: s + c.cast("double") * c))
        chi = (k / n * squares - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
        high = F.aggregate(v, F.lit(0.0), lambda s, x: s + (x * 2 >= k).cast("int"))
        places = F.sequence(F.lit(1), F.size(v) - 1)
        runs = F.aggregate(places, F.lit(1.0), lambda s, i: s + ((nth(i) * 2 >= k) != (nth(i + 1) * 2 >= k)).cast("int"))
        mean_runs = 1 + 2 * high * (n - high) / n
        sd_runs = F.sqrt(F.greatest((mean_runs - 1) * (mean_runs - 2) / (n - 1), F.lit(1e-9)))
        mean = F.aggregate(v, F.lit(0.0), lambda s, x: s + x) / n

        def serial(m: Column) -> Column:
            var = F.aggregate(v, F.lit(0.0), lambda s, x: s + (x - m) * (x - m))
            cov = F.aggregate(places, F.lit(0.0), lambda s, i: s + (nth(i) - m) * (nth(i + 1) - m))
            return (F.coalesce(F.try_divide(cov, var), F.lit(1.0)) + 1 / n) * F.sqrt(n)

        ps = F.array(_upper_tail(chi), _two_sided((runs - mean_runs) / sd_runs), _two_sided(let(mean, serial)))
        half = F.aggregate(ps, F.lit(0.0), lambda s, p: s - F.ln(F.greatest(p, F.lit(1e-300))))
        return let(half, lambda h: F.exp(-h) * (1 + h + h * h / 2))  # chi-squared of 6 degrees at 2h

    places = F.transform(F.split(token, ""), lambda c: (F.call_function("locate", c, symbols) - 1).cast("double"))
    return let(places, tests)


def random_candidates(text: Column) -> Column:
    """start, end, part, alphabet, length class, hash and p of the tokens.

    A run that fits an alphabet is one token. In another, the tokens are the longest parts of 20
    characters or more of each class in ``PARTS``; these can overlap. Tokens without a letter or
    without a digit are strata of their own, named by the alphabet and ``PLAIN``.
    """
    def judged(m: Column) -> Column:
        token = m["value"]
        name = symbols = F.lit(None).cast("string")
        for alphabet, pattern, letters in reversed(ALPHABETS):
            fits = F.rlike(token, F.lit(f"^{pattern}$"))
            name, symbols = F.when(fits, F.lit(alphabet)).otherwise(name), F.when(fits, F.lit(letters)).otherwise(symbols)
        mixed = F.rlike(token, F.lit("[0-9]")) & F.rlike(token, F.lit("[A-Za-z]"))
        return F.struct(m["start"].alias("start"), m["end"].alias("end"), m["part"].alias("part"), F.concat(name, F.when(mixed, "").otherwise(PLAIN)).alias("alphabet"),
                        F.floor(F.log2(F.length(token))).cast("int").alias("length_class"), F.xxhash64(token).alias("hash"),
                        let(symbols, lambda known: p_random(token, known)).alias("p"))  # known: not chosen again for each character

    def tokens(m: Column) -> Column:
        def of(token: Column) -> Column:
            piece = lambda start, end, value, part: F.struct(start.alias("start"), end.alias("end"), value.alias("value"), F.lit(part).alias("part"))
            pieces = F.array_distinct(F.concat(*[matches(token, f"[0-9A-Za-z{c}]{{20,}}", f"[0-9A-Za-z{c}]{{20}}", 0) for c in PARTS]))
            end = lambda x: F.when(x["end"] == F.length(token), m["end"]).otherwise(m["start"] + x["end"])
            split = F.transform(pieces, lambda x: piece(m["start"] + x["start"], end(x), x["value"], True))
            whole = F.array(piece(m["start"], m["end"], token, False))
            return F.when(F.rlike(token, F.lit("[+/]")) & F.rlike(token, F.lit("[_-]")), split).otherwise(whole)

        return let(F.regexp_replace(m["value"], "=+$", ""), of)

    return F.transform(F.flatten(F.transform(matches(text, TOKEN, TOKEN_PROBE, 0), tokens)), judged)


def _apart(tokens: Column) -> Column:
    """Of tokens that overlap only the one with the highest p, of equal ones the first."""
    best = F.array_sort(F.transform(tokens, lambda t: F.struct((-t["p"]).alias("minus_p"), t["start"].alias("start"), t["end"].alias("end"))))
    none = F.array().cast("array<struct<minus_p:double,start:bigint,end:bigint>>")
    free = lambda kept, t: ~F.exists(kept, lambda k: (k["start"] < t["end"]) & (t["start"] < k["end"]))
    return F.aggregate(best, none, lambda kept, t: F.when(free(kept, t), F.concat(kept, F.array(t))).otherwise(kept))


def cut_of(counts: list[int]) -> float | None:
    """The least level at which the estimated share of other tokens among those claimed stays within ``FALSE_SHARE``."""
    noise, claimed, cut = 2 * sum(counts[BINS // 2:]), 0, None
    for i in range(BINS - 1, 0, -1):  # every level, whether or not its bin holds a token
        claimed += counts[i]
        if claimed and claimed - noise * (1 - i / BINS) <= FALSE_SHARE * claimed:
            cut = i / BINS
    return cut


def cuts_of(strata: dict[tuple[str, int], list[int]]) -> dict[tuple[str, int], float]:
    """Cut per (alphabet, length class) from counts per bin; strata that have none claim nothing.

    A stratum of fewer than ``MIN_STRATUM`` tokens cannot estimate its noise. It takes the cut of the
    neighbouring length classes, of its alphabet or else of all, but none above ``THIN_CUT``; where
    these are thin as well, the level of its length in ``NULL_CUT``.
    """
    out = {}
    for (alphabet, length), counts in strata.items():
        near = [(a, c) for (a, n), c in strata.items() if abs(n - length) <= 1 and a.endswith(PLAIN) == alphabet.endswith(PLAIN)]
        pools = [list(map(sum, zip(*cs))) for cs in ([c for a, c in near if a == alphabet], [c for _, c in near])]
        if sum(counts) >= MIN_STRATUM:
            cut = cut_of(counts)
        elif (pool := next((x for x in pools if sum(x) >= MIN_STRATUM), None)) is not None:
            cut = min(cut_of(pool) or THIN_CUT, THIN_CUT)
        else:
            cut = NULL_CUT.get(length, LONG_CUT)
        if cut is not None:
            out[alphabet, length] = cut
    return out


def cuts(candidates: DataFrame) -> dict[tuple[str, int], float]:
    """``cuts_of`` the distinct tokens, known by their hash: copies tell nothing more about a stratum."""
    distinct = (candidates.select(F.explode("tokens").alias("t"))
                .select("t.alphabet", "t.length_class", F.least(F.floor(F.col("t.p") * BINS), F.lit(BINS - 1)).cast("int").alias("bin"), "t.hash").distinct())
    binned = distinct.groupBy("alphabet", "length_class", "bin").agg(F.count("*").alias("n"))
    strata: dict[tuple[str, int], list[int]] = {}
    for r in binned.collect():  # at most BINS rows per alphabet and power of two of the length
        strata.setdefault((r["alphabet"], r["length_class"]), [0] * BINS)[r["bin"]] = r["n"]
    return cuts_of(strata)


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, found``: arrays of start, rank, kind, end by start, one row per input row.

    ``base`` are the pattern matches, ``found`` the tokens claimed by the tests that overlap none of
    those. Null and empty texts have no spans. Repeated rows are repeated, but a token counts once in its stratum;
    an empty table gives no rows. Other columns, of any name, are not read.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = stage(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.array_sort(base_spans(text)).alias("base"), random_candidates(text).alias("tokens")), "secrets")
    limits = cuts(rows)
    at = F.create_map(*[F.lit(x) for (a, n), cut in limits.items() for x in (f"{a} {n}", cut)]) if limits else F.create_map().cast("map<string,double>")
    claimed = F.filter("tokens", lambda t: t["p"] >= F.coalesce(F.try_element_at(at, F.concat_ws(" ", t["alphabet"], t["length_class"])), F.lit(2.0)))
    free = F.filter(claimed, lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    apart = let(free, lambda ts: F.concat(F.transform(F.filter(ts, lambda t: ~t["part"]), lambda t: _span(t, len(BASE), FOUND)),
                                          F.transform(_apart(F.filter(ts, lambda t: t["part"])), lambda t: _span(t, len(BASE), FOUND))))
    return rows.select("doc_id", "base", F.array_sort(apart).alias("found"))


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op9_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Contract query over all ``documents``."""
    rows = secret_spans(read_table(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.select("doc_id", *[n(k) for k in BASE], F.sha2(_written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                       _written(F.array_sort(F.concat("base", "found"))).alias("spans"))
