"""URL filters: rules per url, and trust that spreads over the host graph.

Everything here is DataFrame expressions.

* **Rules** judge single urls: the longest rule whose host is the url's host
  or a parent domain of it, and whose path begins the url's path.
* **Hosts** without a rule for the page at hand are judged by the link graph.
  Its edges are the links between different hosts, each weighed by its share
  of the source's links.  Trust starts at hosts most of whose pages rules
  allow, with the share of their pages allowed, and flows along the links
  (a trusted host vouches for what it links to).  Distrust starts at hosts
  most of whose pages rules block and flows against the links (a host answers for what
  it links to).  Both are personalised PageRank with a fixed number of steps;
  a host without links in the direction of flow keeps what it holds.
* A host is blocked if its distrust reaches ``BLOCK_AT`` and exceeds its trust.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postcluster.llm.frames import cut

#: (verdict, host, path)
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

DAMPING = 0.85
STEPS = 8
#: Lineage is cut after every so many steps.
CUT_EVERY = 4
BLOCK_AT = 0.05
#: A host is a seed if rules allow (or block) more than this share of its pages.
SEED_SHARE = 0.5
#: Rules become one expression; a longer list belongs in a table to join.
MAX_RULES = 1000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The host of an absolute or scheme-relative link in a page.
LINK_HOST = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
    lower case; empty for null and for urls without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null.

    Of rules of one length, those of the longer host go first, then ``block``.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; up to {MAX_RULES} are one expression")
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block", r))
    fits = [
        F.when(((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path),
               F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict")))
        for verdict, rule_host, rule_path in ordered
    ]
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.coalesce(*fits, none)


def host_seeds(judged: DataFrame) -> DataFrame:
    """``host, trust, distrust``: the shares of its pages that rules allow and
    block, 0 up to ``SEED_SHARE``."""
    def share(verdict: str) -> Column:
        found = F.avg(F.when(F.col("ruled.verdict") == verdict, 1.0).otherwise(0.0))
        return F.when(found > SEED_SHARE, found).otherwise(0.0)

    return judged.where(F.col("host") != "").groupBy("host").agg(
        share("allow").alias("trust"), share("block").alias("distrust"))


def host_edges(pages: DataFrame, url: str, html: str) -> DataFrame:
    """``src, dst, n``: links between different hosts.  A host whose pages
    hold a third of all links costs a row per task in the shuffle."""
    links = F.explode(F.regexp_extract_all(F.col(html), F.lit(LINK_HOST), F.lit(1)))
    return (
        pages.select(host_of(F.col(url)).alias("src"), links.alias("to"))
        .select("src", F.translate("to", UPPER, LOWER).alias("dst"))
        .where((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
        .groupBy("src", "dst").agg(F.count("*").alias("n"))
    )


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, steps: int = STEPS) -> DataFrame:
    """``host, trust, distrust`` after ``steps`` of personalised PageRank.

    Both flows are one table ``(kind, host)`` and one join a step, hashed by
    both columns; sums have a partial step before their shuffle.
    """
    both = F.explode(F.array(
        F.struct(F.lit("trust").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b")),
        F.struct(F.lit("distrust").alias("kind"), F.col("dst").alias("a"), F.col("src").alias("b")))).alias("f")
    flows = edges.select(both, "n").select("f.*", "n")
    out = flows.groupBy("kind", "a").agg(F.sum("n").alias("total"))
    flows = cut(flows.join(out, ["kind", "a"]).select(
        F.col("kind").alias("flow"), "a", "b", (F.col("n") / F.col("total")).alias("w")))
    hosts = seeds.select("host").union(edges.select("src")).union(edges.select("dst")).distinct()
    known = hosts.join(seeds, "host", "left").na.fill(0.0)
    start = known.select("host", F.explode(F.array(
        F.struct(F.lit("trust").alias("kind"), F.col("trust").alias("seed")),
        F.struct(F.lit("distrust").alias("kind"), F.col("distrust").alias("seed")))).alias("s"))
    start = start.select("s.kind", "host", "s.seed")
    keeps = flows.select(F.col("flow").alias("kind"), F.col("a").alias("host")).distinct().withColumn("sends", F.lit(True))
    start = cut(start.join(keeps, ["kind", "host"], "left").na.fill(False, ["sends"]))
    if flows.isEmpty():  # every host keeps what it holds
        ranks = start.withColumn("rank", F.col("seed"))
    else:
        ranks = start.withColumn("rank", F.col("seed"))
        for step in range(1, steps + 1):
            sent = ranks.where("sends").join(
                flows, (F.col("kind") == F.col("flow")) & (F.col("host") == F.col("a"))
            ).select("kind", F.col("b").alias("host"), (F.col("rank") * F.col("w")).alias("got"))
            kept = ranks.where("NOT sends").select("kind", "host", F.col("rank").alias("got"))
            sums = sent.union(kept).groupBy("kind", "host").agg(F.sum("got").alias("got"))
            ranks = start.join(sums, ["kind", "host"], "left").withColumn(
                "rank", (1 - damping) * F.col("seed") + damping * F.coalesce("got", F.lit(0.0))).drop("got")
            if step % CUT_EVERY == 0:
                ranks = cut(ranks)
    flow = {kind: F.sum(F.when(F.col("kind") == kind, F.col("rank")).otherwise(0.0)).alias(kind)
            for kind in ("trust", "distrust")}
    return ranks.groupBy("host").agg(*flow.values())


def filter_urls(pages: DataFrame, url: str = "url", html: str = "html", rules=RULES,
                damping: float = DAMPING, steps: int = STEPS, block_at: float = BLOCK_AT) -> DataFrame:
    """All columns of ``pages`` in a struct ``_row`` (but for the html), with
    ``host``, ``path``, ``rule`` and ``verdict``.

    Null urls and urls without ``://`` have an empty host and path, fit no
    rule, give no edges and are allowed.  Null pages give no edges.  Repeated
    rows each get the same verdict and count as often as they stand.
    """
    kept = [F.col(f"`{c}`") for c in pages.columns if c != html]
    parts = pages.select(F.struct(*kept).alias("_row"), host_of(F.col(url)).alias("host"),
                         path_of(F.col(url)).alias("path"))
    judged = parts.withColumn("ruled", rule_of(F.col("host"), F.col("path"), rules))
    edges = cut(host_edges(pages, url, html))
    scores = propagate(host_seeds(judged), edges, damping, steps)
    blocked = scores.where((F.col("distrust") >= block_at) & (F.col("distrust") > F.col("trust"))).select(
        F.col("host").alias("bad_host"))
    # Hosts are few against pages, and a hot host is split by the join's
    # runtime plan, or the blocked hosts are broadcast if they are small.
    joined = judged.join(blocked, F.col("host") == F.col("bad_host"), "left")
    verdict = F.coalesce(F.col("ruled.verdict"), F.when(F.col("bad_host").isNotNull(), "block").otherwise("allow"))
    return joined.select("_row", "host", "path", F.col("ruled.rule").alias("rule"), verdict.alias("verdict"))
