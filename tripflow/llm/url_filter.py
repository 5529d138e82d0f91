"""URL filters: rules, and link-graph propagation for what no rule covers.

A rule names a host (with its subdomains) and a start of the path; the
longest rule that fits a url decides. Other urls take their host's verdict:

* Host edges are the links of the pages (absolute ``href``/``src``) and, both
  ways, a host and the parent host when both have pages.
* Trust is a personalised PageRank from hosts with allowed pages, distrust
  one over reversed edges from hosts with blocked pages: who links to blocked
  hosts earns distrust. A host is a seed by its number of such pages.
* Ranks are scaled to pages: a host's distrust rate is the number of blocked
  pages that reach it for each page of its own. It is blocked if this rate is
  at least ``MIN_DISTRUST`` and exceeds its trust rate, else allowed.

Ranks are host tables; each turn is a join with the edges, aggregated before
the shuffle, and a checkpoint, until no host's rate can still move by more
than ``RATE_TOLERANCE``: what is left to move is at most d / (1 - d) times
what the last turn moved. That shrinks by d each turn, so the number of turns
grows with the logarithm of the seed pages.

Defined cases: a null url, or one without ``://``, has an empty host and path,
no rule, and is allowed unless its (empty) host were blocked; a null html has
no links; rules of equal length: block wins; repeated pages count as often as
they occur; no pages give no rows. Other columns are not read.
"""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.text import checkpoint, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# fixed values: the rules of the query
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/")]
MAX_RULES = 10_000          # rules travel within the plan
DAMPING = 0.6
RATE_TOLERANCE = 1e-3      # pages for each page of a host
MIN_DISTRUST = 0.5

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)(?:href|src)\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def url_host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct(rule, action) of the longest fitting rule, or null."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    if not rules:
        return F.lit(None).cast("struct<rule:string,action:string>")
    by_host: dict[str, list] = {}
    for action, rule in rules:
        by_host.setdefault(rule.partition("/")[0].lower(), []).append((action, rule))
    entry = [x for name, own in by_host.items() for x in (
        F.lit(name), F.array(*[F.struct(F.lit(len(r)).alias("size"), F.lit(a).alias("action"), F.lit(r).alias("rule"),
                                        F.lit(r[r.index("/"):] if "/" in r else "").alias("start")) for a, r in own]))]
    known = F.create_map(*entry)
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    found = F.flatten(F.filter(F.transform(suffixes, lambda s: F.try_element_at(known, s)), lambda x: x.isNotNull()))
    fits = F.filter(found, lambda r: F.startswith(path, r["start"]))
    best = F.array_max(fits)            # size first; "block" sorts after "allow"
    return F.when(best.isNotNull(), F.struct(best["rule"].alias("rule"), best["action"].alias("action")))


def host_edges(pages: DataFrame, host: str = "host", html: str = "html") -> DataFrame:
    """(src, dst, weight): links between hosts, and parent hosts both ways."""
    links = (pages.select(F.col(host).alias("src"), F.explode(F.regexp_extract_all(F.col(html), F.lit(_LINK), F.lit(1))).alias("dst"))
             .select("src", ascii_lower(F.col("dst")).alias("dst")))
    hosts = pages.groupBy(F.col(host).alias("src")).agg(F.count(F.lit(1)).alias("n")).where("src <> ''")
    parent = hosts.select("src", F.regexp_extract("src", r"^[^.]*\.(.+)$", 1).alias("dst"))
    parent = parent.join(hosts.select(F.col("src").alias("dst")), "dst", "left_semi").select("src", "dst")
    both = parent.union(parent.select("dst", "src"))
    return (links.union(both).where("src <> dst AND src <> '' AND dst <> ''")
            .groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight")))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = 1e-6,
              max_turns: int | None = None) -> DataFrame:
    """Personalised PageRank of several kinds at once: ``edges`` (kind, src,
    dst, weight), ``seeds`` (kind, host, seed), (kind, host, rank) out. Seeds
    of a kind sum to 1; so do its ranks. What a host without edges would pass
    on returns to the seeds. No rank is further than ``tolerance`` from its
    limit; ``max_turns`` is by default what that can take at most."""
    if max_turns is None:
        max_turns = max(1, ceil(log(tolerance * (1 - damping) / 4) / log(damping)))
    total = edges.groupBy("kind", "src").agg(F.sum("weight").alias("all"))
    edges = checkpoint(edges.join(total, ["kind", "src"]).select("kind", "src", "dst", (F.col("weight") / F.col("all")).alias("share")))
    ends = edges.select("kind", F.col("src").alias("host")).union(edges.select("kind", F.col("dst").alias("host")))
    nodes = ends.union(seeds.select("kind", "host")).distinct()
    passes_on = edges.select("kind", F.col("src").alias("host"), F.lit(True).alias("passes_on")).distinct()
    base = checkpoint(nodes.join(seeds, ["kind", "host"], "left").join(passes_on, ["kind", "host"], "left")
                      .select("kind", "host", F.coalesce("seed", F.lit(0.0)).alias("seed"),
                              F.coalesce("passes_on", F.lit(False)).alias("passes_on")))
    rank = base.withColumn("rank", F.col("seed"))
    for _ in range(max_turns):
        idle = {r.kind: r.idle for r in rank.where(~F.col("passes_on")).groupBy("kind").agg(F.sum("rank").alias("idle")).collect()}
        back = F.coalesce(F.create_map(*[F.lit(x) for kv in idle.items() for x in kv])[F.col("kind")], F.lit(0.0)) \
            if idle else F.lit(0.0)
        got = (edges.join(rank.select("kind", F.col("host").alias("src"), "rank"), ["kind", "src"])
               .groupBy("kind", F.col("dst").alias("host")).agg(F.sum(F.col("rank") * F.col("share")).alias("got")))
        new = ((1 - damping) * F.col("seed")
               + damping * (F.coalesce("got", F.lit(0.0)) + back * F.col("seed")))
        step = checkpoint(rank.withColumnRenamed("rank", "old").join(got, ["kind", "host"], "left")
                          .select("kind", "host", "seed", "passes_on", "old", new.alias("rank")))
        moved = step.agg(F.sum(F.abs(F.col("rank") - F.col("old")))).first()[0] or 0.0
        rank = step.drop("old")
        if moved * damping / (1 - damping) < tolerance:
            break
    return rank.select("kind", "host", "rank")


def host_verdicts(judged: DataFrame, min_distrust: float = MIN_DISTRUST) -> DataFrame:
    """(host, pages, trust_rate, distrust_rate, host_verdict). ``judged``:
    (host, html, action), action being a rule's or null."""
    hosts = checkpoint(judged.groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"), F.sum((F.col("action") == "allow").cast("long")).alias("allowed"),
        F.sum((F.col("action") == "block").cast("long")).alias("blocked")))
    sums = hosts.agg(F.sum("allowed").alias("allow"), F.sum("blocked").alias("block")).first()
    allow, block = sums.allow or 0, sums.block or 0
    links = checkpoint(host_edges(judged))
    edges = links.select(F.lit("trust").alias("kind"), "src", "dst", "weight").union(
        links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    seeds = (hosts.where("allowed > 0").select(F.lit("trust").alias("kind"), "host", (F.col("allowed") / max(allow, 1)).alias("seed"))
             .union(hosts.where("blocked > 0").select(F.lit("distrust").alias("kind"), "host",
                                                      (F.col("blocked") / max(block, 1)).alias("seed"))))
    rank = checkpoint(propagate(edges, seeds, tolerance=RATE_TOLERANCE / max(allow, block, 1)))
    of = lambda kind, n: rank.where(F.col("kind") == kind).select("host", (F.col("rank") * n).alias(kind))
    rate = lambda kind: F.round(F.coalesce(F.col(kind), F.lit(0.0)) / F.col("pages"), 9)
    out = hosts.join(of("trust", allow), "host", "left").join(of("distrust", block), "host", "left").select(
        "host", "pages", rate("trust").alias("trust_rate"), rate("distrust").alias("distrust_rate"))
    bad = (F.col("distrust_rate") >= min_distrust) & (F.col("distrust_rate") > F.col("trust_rate"))
    return out.withColumn("host_verdict", F.when(bad, "block").otherwise("allow"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict, trust_rate, distrust_rate."""
    split = pages.select(F.col(id_col).alias("page_id"), url_host(F.col(url_col)).alias("host"),
                         url_path(F.col(url_col)).alias("path"), F.col(html_col).alias("html"))
    judged = split.withColumn("r", fitting_rule(F.col("host"), F.col("path"), rules)).select(
        "page_id", "host", "path", F.col("r.rule").alias("rule"), F.col("r.action").alias("action"), "html")
    hosts = host_verdicts(judged)
    return (judged.drop("html").join(hosts, "host", "left")
            .select("page_id", "host", "path", "rule", F.coalesce("action", "host_verdict").alias("verdict"),
                    "trust_rate", "distrust_rate"))


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))
