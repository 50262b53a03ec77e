"""URL filters [DataFrame functions only]: policy rules, and link-graph propagation for the hosts they leave open.

A policy is a short list of (host, path, action): a rule fits its host and all subdomains, if the url's path starts with
the rule's; the longest rule wins (equally long ones: block before allow, then alphabetical order).

Hosts of pages that rules allow are the trusted seeds, of pages that rules block the blocked seeds, each in proportion to such
pages. Over weighted host edges, personalised PageRank spreads trust from the trusted seeds along links, and distrust
from the blocked seeds against them (who links to a blocked host is suspect). A host is blocked where its
distrust exceeds ``THRESHOLD`` of its trust and distrust together. Edges are the pages' absolute links between hosts, counted per
pair before any shuffle, and, as a site vouches for its parts, one edge of weight ``SITE_WEIGHT`` each way between a host
and the domain right above it (of two labels at least). The share is rounded to ``PLACES`` decimals, so it does not matter how many
seeds there are, and equal trust and distrust are equal.

Pages are read once; after that everything has a row per host or pair of hosts. Ranks of hosts without links out are
not handed on. Ranks are written to the shared folder every ``CUT`` rounds, and the rounds go on until in ``CUT`` of them no host
has been reached anew and no rank has changed by more than ``TOLERANCE`` of itself (ranks below ``TINY`` count as unchanged).

Defined cases: a null url or one without ``://`` has an empty host and path, fits no rule and is judged like a host of its own
without links; repeated rows are judged alike; null html has no links; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.shared import written

Rule = tuple[str, str, str]
DAMPING, ROUNDS, CUT, SITE_WEIGHT, THRESHOLD = 0.8, 8, 4, 1.0, 0.5
TOLERANCE, TINY, PLACES = 1e-6, 1e-300, 6
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: the host of an absolute link (with or without its scheme)
LINK = r"""(?i)href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(after_scheme(url), F.lit("")), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(after_scheme(url), F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """struct(rule, action) of the winning rule, or null."""
    best = F.lit(None).cast("struct<rule:string,action:string>")
    order = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[2] != "block", r[0] + r[1]))
    for rule_host, rule_path, action in reversed(order):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        best = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(action).alias("action"))).otherwise(best)
    return best


def judged_by_rules(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, rule, action, links (distinct hosts that the page links to)."""
    named = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    ruled = named.withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    links = F.transform(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)), lambda x: F.translate(x, UPPER, LOWER))
    return ruled.select(
        "page_id", "host", "path", "r.rule", "r.action", F.coalesce(F.array_distinct(links), F.array().cast("array<string>")).alias("links")
    )


def host_edges(judged: DataFrame) -> DataFrame:
    """src, dst, weight."""
    links = judged.select(F.col("host").alias("src"), F.explode("links").alias("dst")).where("src <> '' AND dst <> '' AND src <> dst")
    counted = links.groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    above = F.regexp_extract("host", r"^[^.]+\.([^.]+\..+)$", 1)
    part = judged.select("host").distinct().select("host", above.alias("site")).where("site <> ''")
    both = F.explode(F.array(F.struct(F.col("host").alias("src"), F.col("site").alias("dst")), F.struct(F.col("site").alias("src"), F.col("host").alias("dst"))))
    sites = part.select(both.alias("e")).select("e.src", "e.dst", F.lit(SITE_WEIGHT).alias("weight"))
    return counted.unionByName(sites).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def settled(before: DataFrame, after: DataFrame) -> bool:
    """Whether ranks have (nearly) stayed as they were. A host that has been reached stays reached."""
    both = after.join(before.withColumnRenamed("rank", "was"), ["kind", "host"], "left")
    moved = F.col("was").isNull() | (F.abs(F.col("rank") - F.col("was")) > TOLERANCE * F.col("rank") + TINY)
    return not both.agg(F.bool_or(moved)).first()[0]


def propagate(seeds: DataFrame, edges: DataFrame, rounds: int | None = ROUNDS) -> DataFrame:
    """host, trust, distrust from seeds (host, trusted, blocked: how many pages) and edges (src, dst, weight), after so many rounds or,
    with None, when they have settled."""
    ways = F.explode(
        F.array(
            F.struct(F.lit("trust").alias("kind"), F.col("src"), F.col("dst")),
            F.struct(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst")),
        )
    )
    flows = edges.select(ways.alias("e"), "weight").select("e.kind", "e.src", "e.dst", "weight")
    out = flows.groupBy("kind", "src").agg(F.sum("weight").alias("all"))
    flows = written(flows.join(out, ["kind", "src"]).select(
        F.col("kind").alias("way"), "src", "dst", (F.col("weight") / F.col("all")).alias("share")
    ), "flows")
    kinds = F.explode(
        F.array(F.struct(F.lit("trust").alias("kind"), F.col("trusted").alias("n")), F.struct(F.lit("distrust").alias("kind"), F.col("blocked").alias("n")))
    )
    marked = seeds.select("host", kinds.alias("s")).select("s.kind", "host", "s.n").where("n > 0")
    totals = marked.groupBy("kind").agg(F.sum("n").alias("all"))
    start = written(marked.join(F.broadcast(totals), "kind").select("kind", "host", (F.col("n") / F.col("all")).alias("rank")), "seeds")
    rank = last = start
    for i in count(1) if rounds is None else range(1, rounds + 1):
        moved = rank.join(flows, (F.col("kind") == F.col("way")) & (F.col("host") == F.col("src"))).select(
            "kind", F.col("dst").alias("host"), (F.lit(DAMPING) * F.col("rank") * F.col("share")).alias("rank")
        )
        kept = start.select("kind", "host", (F.lit(1 - DAMPING) * F.col("rank")).alias("rank"))
        rank = moved.unionByName(kept).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if i % CUT == 0:
            rank = written(rank, "ranks")
            if rounds is None and settled(last, rank):
                break
            last = rank
    score = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0)).alias(kind)
    return rank.groupBy("host").agg(score("trust"), score("distrust"))


def by_host(scores: DataFrame) -> DataFrame:
    """host, by_host (allow or block) from host, trust, distrust."""
    share = F.round(F.try_divide(F.col("distrust"), F.col("trust") + F.col("distrust")), PLACES)
    return scores.select("host", F.when(share > THRESHOLD, "block").otherwise("allow").alias("by_host"))


def judge(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict (allow or block)."""
    judged = written(judged_by_rules(pages, rules), "judged-pages")
    n_of = lambda action: F.count(F.when(F.col("action") == action, 1))
    seeds = judged.groupBy("host").agg(n_of("allow").alias("trusted"), n_of("block").alias("blocked"))
    verdicts = by_host(propagate(seeds, host_edges(judged), rounds=None))
    return judged.drop("links").join(verdicts, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("action", "by_host", F.lit("allow")).alias("verdict")
    )
