"""URL filters: longest-rule verdicts, and link-graph propagation for the rest.

Rules name a host (with all its subdomains) and a path prefix; the longest rule
that fits decides. Pages without a rule get the verdict of their host, which
comes from the host graph of their links:

* trust: personalised PageRank along the links, seeded by the pages that an
  allow rule admits;
* distrust: the same on reversed links, seeded by the pages that a block rule
  rejects, so hosts that link to blocked ones gather it.

Hosts that are only linked to count as one page, which a rule for the whole host
decides. Each rank is divided by the one that seeding every page would give on the
same graph, less a host's own part of it where no rule decides any of its pages: a
host that links to blocked ones alone has a distrust of 1, whatever its size. A host
is blocked if its distrust reaches `threshold` and exceeds its trust. After k steps
at most damping ** k of the mass has not moved; steps go on until that is `TOLERANCE`
(none if there are no edges). Steps are joins and sums over (host, host) edges, with
a written table every few, so lineage stays short and a hub's edges can be split by
adaptive execution.

Nulls and edge cases: a null url, or one without ://, has an empty host and
path and is allowed; null html has no links; links of a page to one host count
once; identical rows count as two pages; an empty table gives an empty result;
columns whose names clash with the result's are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.llm.common import or_empty, quoted, stage, table, without

# The rules of the registered query as (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
DAMPING = 0.85
TOLERANCE = 1e-3   # of the mass may not have moved
ITERATIONS = math.ceil(math.log(TOLERANCE) / math.log(DAMPING))
WRITE_EVERY = 4    # steps
THRESHOLD = 0.5
LEAST = 1e-9       # rank; less is rounding
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
LINK = r"""(?i)<a[\x09-\x0D\x20][^<>]*?href[\x09-\x0D\x20]*=[\x09-\x0D\x20]*["']?[\x09-\x0D\x20]*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'<>\x09-\x0D\x20]+)"""

RESULT = ("host", "path", "rule", "verdict", "trust", "distrust")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(or_empty(url), HOST, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(or_empty(url), PATH, 1)


def _decide(host: Column, path: Column, rules: tuple) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule; nulls if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1] + r[2])):  # the longest is tested first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): pages of host src that link to another host dst."""
    targets = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)),
                                           lambda h: F.translate(h, UPPER, LOWER)))
    none = F.array().cast("array<string>")
    links = pages.where("host != ''").select("host", F.explode(
        F.when(F.col("html").contains("//"), targets).otherwise(none)).alias("dst"))
    return links.where("host != dst").groupBy(F.col("host").alias("src"), "dst").agg(F.count(F.lit(1)).alias("n"))


def propagate(hosts: DataFrame, edges: DataFrame, damping: float = DAMPING, iterations: int = ITERATIONS) -> DataFrame:
    """hosts (host, pages, allowed, blocked) and edges (src, dst, n) ->
    (host, trust, distrust), shares in [0, 1]."""
    one = lambda way, a, b: edges.select(F.lit(way).alias("way"), F.col(a).alias("src"), F.col(b).alias("dst"), "n")
    both = one(0, "src", "dst").unionAll(one(1, "dst", "src"))
    out = both.groupBy("way", "src").agg(F.sum("n").alias("total"))
    graph = stage(both.join(stage(out, "url-degree"), ["way", "src"]).select(
        "way", F.col("src").alias("host"), "dst", (F.col("n") / F.col("total")).alias("share")), "url-graph")
    seeds = stage(hosts.select("host", F.explode(F.array(
        F.struct(F.lit(0).alias("way"), F.col("allowed").cast("double").alias("mark"), F.col("pages").cast("double").alias("base")),
        F.struct(F.lit(1).alias("way"), F.col("blocked").cast("double").alias("mark"), F.col("pages").cast("double").alias("base")),
    )).alias("s")).select("s.way", "host", "s.mark", "s.base"), "url-seeds")
    jump = seeds.select("way", "host", (F.col("mark") * (1 - damping)).alias("mark"), (F.col("base") * (1 - damping)).alias("base"))
    ranks = seeds
    for i in range(0 if graph.isEmpty() else iterations):
        moved = graph.join(ranks, ["way", "host"]).select(
            "way", F.col("dst").alias("host"), (F.col("mark") * F.col("share") * damping).alias("mark"),
            (F.col("base") * F.col("share") * damping).alias("base"))
        ranks = jump.unionAll(moved).groupBy("way", "host").agg(F.sum("mark").alias("mark"), F.sum("base").alias("base"))
        if (i + 1) % WRITE_EVERY == 0 or i + 1 == iterations:
            ranks = stage(ranks, "url-rank")
    # A host without a decided page: only what reaches it counts.
    own = hosts.where("allowed + blocked = 0").select("host", (F.col("pages") * (1 - damping)).alias("own"))
    ranks = ranks.join(own, "host", "left").withColumn("base", F.col("base") - F.coalesce("own", F.lit(0.0)))
    share = lambda way: F.max(F.when((F.col("way") == way) & (F.col("base") > LEAST), F.col("mark") / F.col("base")))
    return ranks.groupBy("host").agg(F.coalesce(share(0), F.lit(0.0)).alias("trust"), F.coalesce(share(1), F.lit(0.0)).alias("distrust"))


def judge_urls(pages: DataFrame, rules: tuple = RULES, threshold: float = THRESHOLD, damping: float = DAMPING,
               iterations: int = ITERATIONS) -> DataFrame:
    """`pages` (url and html among its columns) with host, path, rule, verdict
    and the host's trust and distrust shares."""
    rest = without(pages, RESULT)
    judged = pages.select(*rest, host_of(quoted("url")).alias("host"), path_of(quoted("url")).alias("path"))
    rule, verdict = _decide(F.col("host"), F.col("path"), rules)
    judged = judged.withColumn("rule", rule).withColumn("__own", verdict)
    hosts = judged.where("host != ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(F.col("__own") == "allow").alias("allowed"),
        F.count_if(F.col("__own") == "block").alias("blocked"))
    edges = stage(host_edges(pages.select(host_of(quoted("url")).alias("host"), quoted("html").alias("html"))), "url-edges")
    linked = edges.select("dst").distinct().join(hosts, F.col("dst") == F.col("host"), "left_anti").select(F.col("dst").alias("host"))
    _, whole = _decide(F.col("host"), F.lit("/"), tuple(r for r in rules if r[2] == "/"))
    linked = linked.select("host", F.lit(1).cast("long").alias("pages"), F.coalesce(whole == "allow", F.lit(False)).cast("long").alias("allowed"),
                           F.coalesce(whole == "block", F.lit(False)).cast("long").alias("blocked"))
    hosts = stage(hosts.unionByName(linked), "url-hosts")
    shares = stage(propagate(hosts, edges, damping, iterations), "url-shares")
    scored = judged.join(shares, "host", "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    of_host = F.when((distrust >= threshold) & (distrust > trust), F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(*rest, "host", "path", "rule", F.coalesce("__own", of_host).alias("verdict"),
                         trust.alias("trust"), distrust.alias("distrust"))


def op7_urls(spark: SparkSession, data_dir: str) -> DataFrame:
    return judge_urls(table(spark, data_dir, "pages", "page_id", "url", "html")) \
        .select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    quote = lambda s: s.replace("'", "''")
    whole = [(h, a) for a, h, p in RULES if p == "/"]
    decided = lambda action: " OR ".join(f"dst = '{h}' OR ends_with(dst, '.{h}')" for h, a in whole if a == action) or "false"
    longest = sorted(RULES, key=lambda r: (-len(r[1]) - len(r[2]), r[1] + r[2]))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, a) for a, h, p in longest]
    rule = " ".join(f"WHEN {f} THEN '{r}'" for f, r, _ in fits)
    own = " ".join(f"WHEN {f} THEN '{a}'" for f, _, a in fits)
    steps, last = [], "seeds"
    for i in range(ITERATIONS):
        steps.append(f"""r{i} AS (
  SELECT way, host, sum(mark) AS mark, sum(base) AS base FROM (
    SELECT way, host, mark * (1 - {DAMPING}::DOUBLE) AS mark, base * (1 - {DAMPING}::DOUBLE) AS base FROM seeds
    UNION ALL
    SELECT way, dst, mark * share * {DAMPING}::DOUBLE, base * share * {DAMPING}::DOUBLE FROM graph JOIN {last} USING (way, host)
  ) GROUP BY way, host)""")
        last = f"r{i}"
    return f"""
WITH p0 AS (
  SELECT page_id, html, translate(regexp_extract(coalesce(url, ''), '{HOST}', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '{PATH}', 1) AS path FROM pages
), p AS (
  SELECT *, CASE {rule} END AS rule, CASE {own} END AS own FROM p0
), l AS (
  SELECT host AS src, unnest(list_distinct(list_transform(regexp_extract_all(html, '{quote(LINK)}', 1), lambda h: translate(h, '{UPPER}', '{LOWER}')))) AS dst
  FROM p WHERE host != ''
), e AS (
  SELECT src, dst, count(*) AS n FROM l WHERE src != dst GROUP BY ALL
), b AS (
  SELECT 0 AS way, src AS host, dst, n FROM e UNION ALL SELECT 1, dst, src, n FROM e
), graph AS (
  SELECT way, host, dst, n / sum(n) OVER (PARTITION BY way, host) AS share FROM b
), h AS (
  SELECT host, count(*)::DOUBLE AS base, count(*) FILTER (own = 'allow')::DOUBLE AS allowed,
         count(*) FILTER (own = 'block')::DOUBLE AS blocked FROM p WHERE host != '' GROUP BY host
  UNION ALL
  SELECT DISTINCT dst, 1::DOUBLE, ({decided('allow')})::INT::DOUBLE, ({decided('block')})::INT::DOUBLE
  FROM e WHERE dst NOT IN (SELECT host FROM p)
), seeds AS (
  SELECT 0 AS way, host, allowed AS mark, base FROM h UNION ALL SELECT 1, host, blocked, base FROM h
), {", ".join(steps)}, f AS (
  SELECT way, r.host, mark, r.base - CASE WHEN allowed + blocked = 0 THEN h.base * (1 - {DAMPING}::DOUBLE) ELSE 0 END AS base
  FROM {last} r JOIN h USING (host)
), s AS (
  SELECT host, coalesce(max(mark / base) FILTER (way = 0 AND base > {LEAST}), 0) AS trust,
         coalesce(max(mark / base) FILTER (way = 1 AND base > {LEAST}), 0) AS distrust FROM f GROUP BY host
)
SELECT page_id, host, path, rule,
       coalesce(own, CASE WHEN coalesce(distrust, 0) >= {THRESHOLD} AND coalesce(distrust, 0) > coalesce(trust, 0)
                          THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN s USING (host)
"""


OP7_SQL = _sql()
