"""Quality rules: fixed base rules, then thresholds that adapt to each language and source.

Each document's ratios go into quantile sketches, one per (lang, source) and ratio. A sketch is a
table of counts in logarithmic bins of 2 % width: adding counts merges two sketches exactly, in any
order, so partial aggregation builds them and reruns agree. A group of fewer than ``MIN_GROUP``
documents uses the merged sketch of its language, and a small language that of all documents.
Fences are set from quantiles of the sketch and joined back on (lang, source): word length from the
quartiles, the shares of bad things from median and 90 % point, so that a tenth of bad documents in a
source does not move its fence.
"""

from __future__ import annotations

import math
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import read_table, small_batches, stage, utf8

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
MIN_GROUP = 100
GAMMA = 1.02
#: Bin of the value 0, below every bin of a positive double.
ZERO_BIN = -100_000
#: How far beyond its quantile a fence lies: so many times the spread, and at least the slack.
SPREAD = 3.0
SLACK = {"word_length": 2.0, "symbols": 0.1, "dup_lines": 0.35, "repeats": 0.25, "echoes": 0.1}
QUANTILES = {"q1": 0.25, "q2": 0.5, "q3": 0.75, "q9": 0.9}
TWO_SIDED = ("word_length",)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_echoes")
_COUNTS_TYPE = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">"


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """How many words lie in a window of ``width`` words that occurs twice or more (exact).

    Windows get ranks by doubling: equal ranks of length 2k are equal pairs of ranks of length k.
    """
    if len(words) <= width:
        return 0
    known: dict[bytes, int] = {}
    rank = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    step = 1
    while step < width:
        pairs = rank[:-step] * len(words) + rank[step:]
        distinct, rank = np.unique(pairs, return_inverse=True)
        if len(distinct) == len(pairs):
            return 0
        step *= 2
    starts = np.flatnonzero(np.bincount(rank)[rank] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    edges[starts] += 1
    edges[starts + width] -= 1
    return int(np.count_nonzero(np.cumsum(edges)[:-1]))


def counts(text: bytes | None) -> tuple[int, ...]:
    """``COUNTS`` of a text; all 0 for null. Lines count if they hold a word; an echo is a word equal to the one before."""
    if not text:
        return (0,) * len(COUNTS)
    words = text.split()
    space = sum(map(text.count, b" \t\n\v\f\r"))
    points = int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (len(words), points - space, sum(map(text.count, b"#*$%&|<>")), len(lines),
            len(lines) - len(set(lines)), repeated_words(words), sum(map(eq, words, words[1:])))


def counts_column(text: Column) -> Column:
    @arrow_udf(_COUNTS_TYPE)
    def of(texts: pa.Array) -> pa.Array:
        rows = np.array([counts(t) for t in utf8(texts)], np.int64).reshape(-1, len(COUNTS))
        return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in rows.T], list(COUNTS))

    return of(text)


def base_failed(q: Column) -> Column:
    return (q["n_words"] < MIN_WORDS) | (100 * q["n_repeat_words"] > MAX_REPEAT_PERCENT * q["n_words"])


def ratios(q: Column) -> dict[str, Column]:
    words, lines = F.greatest(q["n_words"], F.lit(1)), F.greatest(q["n_lines"], F.lit(1))
    return {"word_length": q["word_chars"] / words, "symbols": q["n_symbols"] / words,
            "dup_lines": q["n_dup_lines"] / lines, "repeats": q["n_repeat_words"] / words, "echoes": q["n_echoes"] / words}


def sketches(rows: DataFrame, q: Column) -> DataFrame:
    """``(lang, source, ratio, bin, n)`` over the documents that pass the base rules."""
    value = F.col("value")
    bin_ = F.when(value > 0, F.ceil(F.ln(value) / math.log(GAMMA))).otherwise(ZERO_BIN).cast("int")
    one_each = F.explode(F.array(*[F.struct(F.lit(k).alias("ratio"), v.cast("double").alias("value")) for k, v in ratios(q).items()]))
    return (rows.where(~base_failed(q)).select("lang", "source", one_each.alias("r")).select("lang", "source", "r.*")
            .groupBy("lang", "source", "ratio", bin_.alias("bin")).agg(F.count("*").alias("n")))


def quantiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """``by``, ratio, the number of documents and the ``QUANTILES``, from merged sketches."""
    merged = sketch.groupBy(*by, "ratio", "bin").agg(F.sum("n").alias("n"))
    key = Window.partitionBy(*by, "ratio")
    upto = key.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = merged.withColumn("upto", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(key))
    value = F.when(F.col("bin") == ZERO_BIN, 0.0).otherwise(2 * F.pow(F.lit(GAMMA), F.col("bin")) / (GAMMA + 1))
    at = lambda share: F.min(F.when(F.col("upto") >= share * F.col("total"), value))
    return ranked.groupBy(*by, "ratio").agg(F.first("total").alias("total"), *[at(share).alias(c) for c, share in QUANTILES.items()])


def fences(sketch: DataFrame) -> DataFrame:
    """One row per (lang, source): the lowest and highest value kept, for each ratio."""
    levels = [quantiles(sketch, by) for by in (["lang", "source"], ["lang"], [])]
    own, lang, whole = (x.select(*x.columns[:x.columns.index("ratio")], F.col("ratio").alias(f"ratio{i}"), F.struct("total", *QUANTILES).alias(f"s{i}")) for i, x in enumerate(levels))
    lang = lang.withColumnRenamed("lang", "lang1")
    both = (own.join(lang, (F.col("lang").eqNullSafe(F.col("lang1"))) & (F.col("ratio0") == F.col("ratio1")), "left")
            .join(whole, F.col("ratio0") == F.col("ratio2"), "left"))
    s = (F.when(F.col("s0.total") >= MIN_GROUP, F.col("s0")).when(F.col("s1.total") >= MIN_GROUP, F.col("s1")).otherwise(F.col("s2")))
    slack = F.create_map(*[F.lit(x) for kv in SLACK.items() for x in kv])[F.col("ratio0")]
    two = F.col("ratio0").isin(*TWO_SIDED)
    base = F.when(two, F.col("s.q3")).otherwise(F.col("s.q9"))
    far = F.greatest(SPREAD * (base - F.when(two, F.col("s.q1")).otherwise(F.col("s.q2"))), slack)
    limits = both.withColumn("s", s).select("lang", "source", F.col("ratio0").alias("ratio"), (F.col("s.q1") - far).alias("low"), (base + far).alias("high"))
    pick = lambda k, side: F.max(F.when(F.col("ratio") == k, F.col(side))).alias(f"{k}_{side}")
    return limits.groupBy("lang", "source").agg(*[pick(k, "high") for k in SLACK], *[pick(k, "low") for k in TWO_SIDED])


def judged(docs: DataFrame, counts: Column) -> DataFrame:
    """``docs`` (with lang and source) as the struct ``row``, with ``q`` (the struct ``counts`` of COUNTS), ``base_failed`` and ``kept``.

    A null text counts as empty and fails the base rules. Null lang and null source are groups of
    their own. Repeated rows are judged alike and all returned; an empty table gives no rows. Other
    columns may have any name. The input is written once to the shared folder, so Python reads the
    texts once.
    """
    small_batches(docs.sparkSession)
    rows = stage(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "lang", "source", counts.alias("q")), "quality-counts")
    q = F.col("q")
    limit = stage(fences(sketches(rows, q)), "quality-fences")
    limit = limit.withColumnsRenamed({"lang": "fence_lang", "source": "fence_source"})
    inside = F.lit(True)
    for k, v in ratios(q).items():
        inside &= v <= F.coalesce(F.col(f"{k}_high"), F.lit(math.inf))
        if k in TWO_SIDED:
            inside &= v >= F.coalesce(F.col(f"{k}_low"), F.lit(-math.inf))
    return (rows.join(limit, F.col("lang").eqNullSafe(F.col("fence_lang")) & F.col("source").eqNullSafe(F.col("fence_source")), "left")
            .select("row", "q", base_failed(q).alias("base_failed"), (~base_failed(q) & inside).alias("kept")))


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of ``docs``."""
    return judged(docs, counts_column(F.col(f"`{text_col}`"))).where("kept").select("row.*")


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Contract query over all ``documents``."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    counted = docs.select("doc_id", "lang", "source", counts_column(F.col("text")).alias("counts"))
    rows = judged(counted, F.col("counts"))
    return rows.select("row.doc_id", *[F.col(f"q.{c}").alias(c) for c in COUNTS if c not in ("n_lines", "n_echoes")], "base_failed", "kept")


def oracle_op8() -> str:
    """The same counts, sketches, fences and verdicts in SQL."""
    space = r"[\x20\x09-\x0D]"
    values = ", ".join(f"{{'ratio': '{k}', 'v': {v}}}" for k, v in {
        "word_length": "word_chars::DOUBLE / greatest(n_words, 1)", "symbols": "n_symbols::DOUBLE / greatest(n_words, 1)",
        "dup_lines": "n_dup_lines::DOUBLE / greatest(n_lines, 1)", "repeats": "n_repeat_words::DOUBLE / greatest(n_words, 1)",
        "echoes": "n_echoes::DOUBLE / greatest(n_words, 1)"}.items())

    def level(name: str, by: str) -> str:
        value = f"CASE WHEN bin = {ZERO_BIN} THEN 0.0::DOUBLE ELSE 2 * pow({GAMMA}::DOUBLE, bin) / {GAMMA + 1!r}::DOUBLE END"
        at = ", ".join(f"min({value}) FILTER (WHERE upto >= {q}::DOUBLE * total) AS {c}" for c, q in QUANTILES.items())
        return f"""
{name} AS (SELECT {by} ratio, any_value(total) AS total, {at} FROM (
             SELECT {by} ratio, bin, sum(n) OVER (PARTITION BY {by} ratio ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY {by} ratio) AS total
             FROM (SELECT {by} ratio, bin, sum(n) AS n FROM cells GROUP BY ALL)) GROUP BY ALL)"""

    pick = lambda c: f"CASE WHEN a.total >= {MIN_GROUP} THEN a.{c} WHEN b.total >= {MIN_GROUP} THEN b.{c} ELSE g.{c} END"
    slack = "CASE a.ratio " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in SLACK.items()) + " END"
    two = ", ".join(f"'{k}'" for k in TWO_SIDED)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t,
                  list_filter(string_split_regex(coalesce(text, ''), '{space}+'), lambda x: x <> '') AS w FROM documents),
     li AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
            FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
     u AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i, CASE WHEN i <= len(w) - 7 THEN array_to_string(w[i:i + 7], ' ') END AS s FROM d),
     f AS (SELECT r, i, word, s IS NOT NULL AND count(*) OVER (PARTITION BY r, s) > 1 AS again, lag(word) OVER (PARTITION BY r ORDER BY i) AS prior FROM u),
     c AS (SELECT r, i, word = prior AS echo, bool_or(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS covered FROM f),
     wc AS (SELECT r, count(*) FILTER (WHERE covered) AS n_repeat_words, count(*) FILTER (WHERE echo) AS n_echoes FROM c GROUP BY r),
     q AS (SELECT d.r, doc_id, lang, source, len(w) AS n_words, length(regexp_replace(t, '{space}+', '', 'g')) AS word_chars,
                  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
                  coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_echoes, 0) AS n_echoes
           FROM d LEFT JOIN li USING (r) LEFT JOIN wc USING (r)),
     j AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed, unnest([{values}]) AS x FROM q),
     cells AS (SELECT lang, source, x.ratio AS ratio, CASE WHEN x.v > 0 THEN ceil(ln(x.v) / {math.log(GAMMA)!r}::DOUBLE) ELSE {ZERO_BIN} END AS bin, count(*) AS n
               FROM j WHERE NOT base_failed GROUP BY ALL),{level('k0', 'lang, source,')},{level('k1', 'lang,')},{level('k2', '')},
     lim AS (SELECT a.lang, a.source, a.ratio, {', '.join(f'{pick(c)} AS {c}' for c in QUANTILES)}, {slack} AS slack
             FROM k0 a LEFT JOIN k1 b ON a.lang IS NOT DISTINCT FROM b.lang AND a.ratio = b.ratio LEFT JOIN k2 g ON a.ratio = g.ratio),
     v AS (SELECT j.r, coalesce(bool_and(CASE WHEN x.ratio IN ({two}) THEN x.v BETWEEN q1 - greatest({SPREAD} * (q3 - q1), slack::DOUBLE)
                                AND q3 + greatest({SPREAD} * (q3 - q1), slack::DOUBLE) ELSE x.v <= q9 + greatest({SPREAD} * (q9 - q2), slack::DOUBLE) END), true) AS inside
           FROM j LEFT JOIN lim ON j.lang IS NOT DISTINCT FROM lim.lang AND j.source IS NOT DISTINCT FROM lim.source AND x.ratio = lim.ratio GROUP BY j.r)
SELECT DISTINCT ON (j.r) doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND inside AS kept
FROM j JOIN v USING (r)"""


ORACLE_OP8 = oracle_op8()
