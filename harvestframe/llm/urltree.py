"""URL filters: rules, and for the other URLs a tree of path templates per host.

A tree node is a host and a template of the path so far. Of its next segments those stay literal
that are frequent at the node and whose labels differ from those of their siblings; rare segments
(ids, names) are variable, and frequent ones whose labels do not differ are merged: both become
``*``. Nodes of one depth are worked out together, from counts, so neither a host nor a node is ever
gathered. Below a node of fewer than ``MIN_PAGES`` pages nothing can stay literal, so levels end with
the deepest path that enough pages share, however deep single paths are. A template is rejected if its labelled purity, smoothed towards that of its host and of
all hosts, is high, and if enough of its pages are labelled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read_table, stage

#: (action, host, path); the rules also label the pages from which the templates learn.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Least pages of a literal segment; least z of a difference.
MIN_PAGES, MIN_Z = 5, 2.58
#: Weight of the smoothing in labelled pages; purity and labelled share that reject.
SMOOTHING, REJECT, LABELLED = 10.0, 0.8, 0.2
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (ASCII letters lower-cased) and path; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct of rule and action of the longest rule that fits (of equal ones that of the longer host, then block); else null."""
    best = F.lit(None).cast("struct<rule:string,action:string>")
    for action, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0] == "block")):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        best = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(action).alias("action"))).otherwise(best)
    return best


def segments(path: Column) -> Column:
    """The parts of a path between slashes, one at the end aside."""
    return F.split(F.regexp_replace(path, r"^/|/\z", ""), "/")


def _counts() -> list[Column]:
    return [F.count("*").alias("n"), F.count_if(F.col("label") == 1).alias("blocked"), F.count_if(F.col("label") == 0).alias("allowed")]


def _differs(part: str) -> Column:
    """Whether the share of ``part`` among a segment's pages differs from that among its siblings'."""
    n, rest = F.col("n"), F.col("all_n") - F.col("n")
    own, other = F.try_divide(F.col(part), n), F.try_divide(F.col(f"all_{part}") - F.col(part), rest)
    pooled = F.try_divide(F.col(f"all_{part}"), F.col("all_n"))
    spread = F.sqrt(pooled * (1 - pooled) * (1 / n + F.try_divide(F.lit(1), rest)))
    return F.coalesce(F.abs(own - other) >= MIN_Z * spread, F.lit(True)) & (F.coalesce(spread, F.lit(1.0)) > 0)


def literal_segments(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(h, t, s)`` that stay literal, and the nodes ``(h, t)`` of enough pages, from rows of host, template, segment, label."""
    branch = stage(rows.groupBy("host", "template", "segment").agg(*_counts()), "url-branches")
    node = branch.groupBy(F.col("host").alias("h"), F.col("template").alias("t")).agg(*[F.sum(c).alias(f"all_{c}") for c in ("n", "blocked", "allowed")])
    node = node.where(F.col("all_n") >= MIN_PAGES)
    both = branch.where(F.col("n") >= MIN_PAGES).join(node, (F.col("host") == F.col("h")) & (F.col("template") == F.col("t")))
    return both.where(_differs("blocked") | _differs("allowed")).select("h", "t", F.col("segment").alias("s")), node.select("h", "t")


def templates(rows: DataFrame) -> DataFrame:
    """``rows`` (host, path, label, more) with their ``template``."""
    names = rows.columns
    rows = stage(rows.select("*", segments(F.col("path")).alias("parts"), F.lit("").alias("template"), F.lit(True).alias("open")), "url-level")
    done, d = rows.where("not open"), 0
    while not rows.where("open").isEmpty():
        here = rows.where("open").withColumn("segment", F.get("parts", F.lit(d)))
        literal, big = literal_segments(here)
        literal, big = stage(literal, "url-literals"), big.select(F.col("h").alias("bh"), F.col("t").alias("bt"))
        at = (F.col("host") == F.col("h")) & (F.col("template") == F.col("t")) & (F.col("segment") == F.col("s"))
        node = (F.col("host") == F.col("bh")) & (F.col("template") == F.col("bt"))
        left = F.size("parts") - d  # parts from this one on
        rest = F.concat(F.lit("/"), F.when(F.col("bh").isNull(), F.concat(F.repeat(F.lit("*/"), left - 1), F.lit("*"))).otherwise(F.coalesce("s", F.lit("*"))))
        rows = stage(here.join(literal, at, "left").join(big, node, "left")
                     .select(*names, "parts", F.concat("template", rest).alias("template"), (F.col("bh").isNotNull() & (left > 1)).alias("open")), "url-level")
        done, d = done.unionByName(rows.where("not open")), d + 1
    return done.drop("parts", "open")


def rejected(rows: DataFrame) -> DataFrame:
    """``(host, template)`` whose smoothed labelled purity rejects them."""
    by_template = stage(rows.groupBy("host", "template").agg(*_counts()), "url-templates")
    by_host = by_template.groupBy(F.col("host").alias("h")).agg(F.sum("blocked").alias("host_blocked"), F.sum(F.col("blocked") + F.col("allowed")).alias("host_labelled"))
    share = by_template.agg(F.try_divide(F.sum("blocked"), F.sum(F.col("blocked") + F.col("allowed")))).first()[0] or 0.0
    host = (F.col("host_blocked") + SMOOTHING * share) / (F.col("host_labelled") + SMOOTHING)
    labelled = F.col("blocked") + F.col("allowed")
    purity = (F.col("blocked") + SMOOTHING * host) / (labelled + SMOOTHING)
    return (by_template.join(by_host, F.col("host") == F.col("h")).where((purity >= REJECT) & (labelled >= LABELLED * F.col("n")))
            .select(F.col("host").alias("h"), F.col("template").alias("t")))


def judged_urls(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, template``, one row per input row.

    A null URL, or one without ``://``, has an empty host and path, and is judged with the others of
    that host. Repeated rows count each and are judged alike; without any labelled page everything
    is allowed. An empty table gives no rows. Other columns, of any name, are not read.
    """
    host, path = host_and_path(F.col(f"`{url_col}`"))
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("ruled", matching_rule(F.col("host"), F.col("path"), rules))
    rows = rows.select("page_id", "host", "path", F.col("ruled.rule").alias("rule"), F.col("ruled.action").alias("action"),
                       F.when(F.col("ruled.action") == "block", 1).when(F.col("ruled.action") == "allow", 0).alias("label"))
    rows = templates(rows)
    bad = stage(rejected(rows), "url-rejected")
    out = rows.join(bad, (F.col("host") == F.col("h")) & (F.col("template") == F.col("t")), "left")
    verdict = F.coalesce("action", F.when(F.col("h").isNotNull(), "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template")


def op7_url_filter(spark, sf_dir: str) -> DataFrame:
    """Contract query over all ``pages``."""
    return judged_urls(read_table(spark, sf_dir, "pages"))


def oracle_op7(rules=RULES) -> str:
    """The same judgement in SQL, one recursion per depth."""
    lower = f"translate({{}}, '{_UPPER}', '{_LOWER}')"
    order = sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0] == "block"), reverse=True)
    when = "".join(f" WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h + p}'" for _, h, p in order)
    act = "".join(f" WHEN rule = '{h + p}' THEN '{a}'" for a, h, p in order)
    counts = "count(*) AS n, count(*) FILTER (WHERE label = 1) AS blocked, count(*) FILTER (WHERE label = 0) AS allowed"

    def differs(part: str) -> str:
        pooled = f"all_{part}::DOUBLE / all_n"
        spread = f"sqrt({pooled} * (1 - {pooled}) * (1.0::DOUBLE / n + 1.0::DOUBLE / (all_n - n)))"
        return f"(all_n = n OR ({spread} > 0 AND abs({part}::DOUBLE / n - (all_{part} - {part})::DOUBLE / (all_n - n)) >= {MIN_Z}::DOUBLE * {spread}))"

    levels = f"""
l AS (SELECT *, string_split(regexp_replace(path, '^/|/$', '', 'g'), '/') AS parts, '' AS template, 0 AS d FROM judged
      UNION ALL
      SELECT page_id, host, path, rule, action, label, parts,
             template || CASE WHEN len(parts) <= d THEN '' WHEN n >= {MIN_PAGES} AND ({differs('blocked')} OR {differs('allowed')}) THEN '/' || parts[d + 1] ELSE '/*' END, d + 1
      FROM (SELECT *, count(*) OVER b AS n, count(*) FILTER (WHERE label = 1) OVER b AS blocked, count(*) FILTER (WHERE label = 0) OVER b AS allowed,
                   count(*) OVER a AS all_n, count(*) FILTER (WHERE label = 1) OVER a AS all_blocked, count(*) FILTER (WHERE label = 0) OVER a AS all_allowed
            FROM l WINDOW a AS (PARTITION BY host, template, len(parts) > d), b AS (PARTITION BY host, template, len(parts) > d, parts[d + 1]))
      WHERE d < (SELECT max(len(string_split(path, '/'))) FROM judged)),
last AS (SELECT * FROM l WHERE d = (SELECT max(d) FROM l))"""
    k = f"{SMOOTHING}::DOUBLE"
    return f"""
WITH RECURSIVE u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
     h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
     parsed AS (SELECT page_id, {lower.format('raw')} AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
     ruled AS (SELECT *, CASE{when} END AS rule FROM parsed),
     acted AS (SELECT *, CASE{act} END AS action FROM ruled),
     judged AS (SELECT *, CASE action WHEN 'block' THEN 1 WHEN 'allow' THEN 0 END AS label FROM acted),{levels},
     t AS (SELECT host, template, {counts} FROM last GROUP BY host, template),
     hosts AS (SELECT host, sum(blocked) AS hb, sum(blocked + allowed) AS hl FROM t GROUP BY host),
     share AS (SELECT coalesce(sum(blocked)::DOUBLE / nullif(sum(blocked + allowed), 0), 0) AS s FROM t),
     bad AS (SELECT t.host, t.template FROM t JOIN hosts USING (host), share
             WHERE (blocked + {k} * ((hb + {k} * s) / (hl + {k}))) / (blocked + allowed + {k}) >= {REJECT}::DOUBLE AND blocked + allowed >= {LABELLED}::DOUBLE * n)
SELECT page_id, l.host, path, rule, coalesce(action, CASE WHEN bad.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, l.template
FROM last l LEFT JOIN bad ON bad.host = l.host AND bad.template = l.template"""


ORACLE_OP7 = oracle_op7()
