"""URL filters by rules and link-graph propagation over hosts, in DataFrame functions.

1. Every url is split into host and path and judged by the longest rule that
   fits: a rule (host, path) fits its host and all its subdomains where the
   url's path starts with the rule's. Pages with a rule's verdict seed the hosts
   they lie on, allowed pages with trust and blocked ones with distrust, in
   proportion to their number.
2. The host graph has an edge for every hyperlink with a host of its own in a
   page's html, weighted by its number, and an edge of weight ``PARENT`` between
   each host and its parent domain (``a.b.example`` and ``b.example``, down to
   two labels) both ways, as sites under one domain belong together.
3. Trust is a personalised PageRank from the trusted seeds along the edges;
   distrust is one from the blocked seeds along the reversed edges, so what
   links to blocked hosts loses standing. ``ROUNDS`` rounds with ``DAMPING``;
   what reaches a host without a way out goes no further. Each round is an
   equi-join of ranks and edges and a pre-aggregated sum, so a host with many
   links is split; ranks are written to the shared folder as lineage grows.
4. A page without a rule has its host's verdict: block where the distrust's
   share of trust and distrust exceeds ``BLOCK_SHARE``, else allow (also where
   neither reaches the host).

Defined cases: a null url, or one without ``://``, has empty host and path, no
rule and is allowed; a null html has no links; repeated rows are judged each and
seed and link each time; no seeds of a kind give no mass of that kind; ranks are
compared rounded to ``DIGITS`` digits, so that the order of summation decides
nothing; a null page_id stays null; an empty table gives an empty result; extra
columns do not matter.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from . import common as C

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING = 0.85
ROUNDS = 20
ROUNDS_A_TABLE = 5             # rounds planned together, then written
PARENT = 1.0
BLOCK_SHARE = 0.5
DIGITS = 12
LINK = r"""(?i)href\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s<>]*)"""


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the contract.
RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"),
         Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Name of the longest rule that fits (ties: the first by name), else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name), reverse=True):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.lit(rule.name)).otherwise(out)
    return out


def verdict_of(rule: Column, rules: tuple[Rule, ...]) -> Column:
    out = F.lit(None).cast("string")
    for r in rules:
        out = F.when(rule == r.name, F.lit(r.verdict)).otherwise(out)
    return out


def host_edges(pages: DataFrame, parent: float = PARENT) -> DataFrame:
    """src, dst, weight: hyperlinks between hosts, and hosts with their parent domains."""
    links = pages.filter("host <> ''").select("host", F.explode(F.regexp_extract_all("html", F.lit(LINK))).alias("to"))
    # a link without a scheme ("//host/path") is read as one with some scheme
    links = links.select(F.col("host").alias("src"), host_of(F.concat(F.lit(":"), F.regexp_replace(
        "to", r"^[^/]*:", ""))).alias("dst"))
    links = links.filter("dst <> '' and src <> dst").groupBy("src", "dst").agg(
        F.count("*").cast("double").alias("weight"))
    hosts = pages.select("host").unionByName(links.select(F.col("dst").alias("host"))).filter("host <> ''").distinct()
    labels = F.split("host", r"\.")
    ups = F.when(F.size(labels) > 2, F.transform(F.sequence(F.lit(1), F.size(labels) - 2), lambda k: F.struct(
        F.array_join(F.slice(labels, k, F.size(labels)), ".").alias("child"),
        F.array_join(F.slice(labels, k + 1, F.size(labels)), ".").alias("up"))))
    tree = hosts.select(F.explode(ups).alias("t")).select("t.child", "t.up").distinct()
    both = tree.select(F.explode(F.array(
        F.struct(F.col("child").alias("src"), F.col("up").alias("dst")),
        F.struct(F.col("up").alias("src"), F.col("child").alias("dst")))).alias("e")).select(
        "e.src", "e.dst", F.lit(parent).alias("weight"))
    return links.unionByName(both).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """kind, host, rank after so many rounds.

    ``edges``: kind, src, dst, weight; ``seeds``: kind, host, seed (each kind
    adds up to one), read from a table as every round needs them. Both kinds run in the same joins.
    """
    out = edges.groupBy("kind", "src").agg(F.sum("weight").alias("all"))
    edges = C.store(edges.join(out, ["kind", "src"]).select(
        "kind", "src", "dst", (F.col("weight") / F.col("all")).alias("share")), "edges")
    ranks = seeds.select("kind", "host", F.col("seed").alias("rank"))
    start = seeds.select("kind", "host", (F.lit(1 - damping) * F.col("seed")).alias("rank"))
    for k in range(rounds):
        moved = ranks.select("kind", F.col("host").alias("src"), "rank").join(edges, ["kind", "src"]).select(
            "kind", F.col("dst").alias("host"), (F.lit(damping) * F.col("rank") * F.col("share")).alias("rank"))
        ranks = moved.unionByName(start).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if k % ROUNDS_A_TABLE == ROUNDS_A_TABLE - 1 or k == rounds - 1:
            ranks = C.store(ranks, "ranks")
    return ranks


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, rounds: int = ROUNDS, damping: float = DAMPING,
          parent: float = PARENT, block_share: float = BLOCK_SHARE) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust for every page."""
    C.prepare(pages.sparkSession)
    url = F.col("url")
    parts = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), "html")
    rule = rule_of(F.col("host"), F.col("path"), rules)
    ruled = parts.select("page_id", "host", "path", rule.alias("rule")).withColumn(
        "own", verdict_of(F.col("rule"), rules))
    kind = F.when(F.col("own") == "allow", "trust").when(F.col("own") == "block", "distrust").alias("kind")
    counts = ruled.filter(F.col("own").isNotNull()).groupBy(kind, "host").agg(F.count("*").alias("pages"))
    counts = C.store(counts, "counts")
    total = {r["kind"]: r["total"] for r in counts.groupBy("kind").agg(F.sum("pages").alias("total")).collect()}
    seeds = counts.select("kind", "host", (F.col("pages") / F.when(
        F.col("kind") == "trust", F.lit(total.get("trust"))).otherwise(F.lit(total.get("distrust")))).alias("seed"))
    edges = C.store(host_edges(parts.select("host", "html"), parent), "host-edges")
    edges = edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    ranks = propagate(edges, seeds, rounds, damping)
    standing = ranks.groupBy("host").agg(
        *[F.round(F.sum(F.when(F.col("kind") == k, F.col("rank")).otherwise(0.0)), DIGITS).alias(k)
          for k in ("trust", "distrust")])
    spread = F.col("trust") + F.col("distrust")
    bad = F.round(F.col("distrust") - F.lit(block_share) * spread, DIGITS) > 0
    return ruled.join(standing, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("own", F.when(bad, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


def query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    """The rounds written out one after the other."""
    rounds = "".join(f"""
r{k + 1} AS MATERIALIZED (
  SELECT kind, host, sum(rank) AS rank FROM (
    SELECT e.kind, e.dst AS host, {DAMPING} * r.rank * e.share AS rank FROM r{k} r JOIN e ON e.kind = r.kind AND e.src = r.host
    UNION ALL SELECT kind, host, (1 - {DAMPING}) * seed FROM seeds) GROUP BY ALL),""" for k in range(ROUNDS))
    return r"""
WITH split AS (
  SELECT page_id, html,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
ruled AS (
  SELECT page_id, host, path, html, CASE
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM split),
own AS (SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS own FROM ruled),
n AS (SELECT CASE own WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*) AS n FROM own WHERE own IS NOT NULL GROUP BY ALL),
seeds AS MATERIALIZED (SELECT kind, host, n / sum(n) OVER (PARTITION BY kind) AS seed FROM n),
links AS (
  SELECT host AS src, translate(regexp_extract(h, '//([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst
  FROM (SELECT host, unnest(regexp_extract_all(html, '(?i)href\s*=\s*["'']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"''\s<>]*)', 1)) AS h
        FROM split WHERE host <> '')),
hosts AS (SELECT host FROM split WHERE host <> '' UNION SELECT dst FROM links WHERE dst <> '' AND src <> dst),
tree AS (
  SELECT DISTINCT array_to_string(l[k:], '.') AS child, array_to_string(l[k + 1:], '.') AS up
  FROM (SELECT l, unnest(generate_series(1, len(l) - 2)) AS k FROM (SELECT string_split(host, '.') AS l FROM hosts))),
edges AS (
  SELECT src, dst, sum(w) AS w FROM (
    SELECT src, dst, 1.0::DOUBLE AS w FROM links WHERE dst <> '' AND src <> dst
    UNION ALL SELECT child, up, 1.0 FROM tree UNION ALL SELECT up, child, 1.0 FROM tree) GROUP BY ALL),
kinds AS (SELECT 'trust' AS kind, src, dst, w FROM edges UNION ALL SELECT 'distrust', dst, src, w FROM edges),
e AS MATERIALIZED (SELECT kind, src, dst, w / sum(w) OVER (PARTITION BY kind, src) AS share FROM kinds),
r0 AS (SELECT kind, host, seed AS rank FROM seeds),""" + rounds + f"""
standing AS (
  SELECT host, round(sum(rank) FILTER (kind = 'trust'), {DIGITS}) AS trust, round(sum(rank) FILTER (kind = 'distrust'), {DIGITS}) AS distrust
  FROM r{ROUNDS} GROUP BY host)
SELECT o.page_id, o.host, o.path, o.rule, coalesce(o.own, CASE WHEN
  round(coalesce(s.distrust, 0) - {BLOCK_SHARE} * (coalesce(s.trust, 0) + coalesce(s.distrust, 0)), {DIGITS}) > 0 THEN 'block' ELSE 'allow' END) AS verdict
FROM own o LEFT JOIN standing s ON s.host = o.host
"""


SQL = _sql()
