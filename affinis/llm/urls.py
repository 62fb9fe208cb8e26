"""URL filters: allow and block rules, and trust that spreads over the link graph of hosts.

DataFrame functions only. A rule fits its host and all subdomains where the url's path starts with the rule's path; the
longest rule wins. Other urls are judged by their host: personalised PageRank spreads trust from hosts with allowed
pages along links, and distrust from hosts with blocked pages against them (who links to a blocked host is suspect).
A host goes when distrust outweighs trust by the threshold. The two ranks sum to one each, so their ratio does not depend on the graph's
size.

Nulls and edge cases: a null url or one without :// has an empty host and path, fits no rule and is allowed; a null
html has no links; repeated rows are pages of their own; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, dropped, stored

# Fixed values of the contract: verdict and rule (host, then path).
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))

#: The change of a host's rank, as a share of that rank, at which it has settled; ranks from LEAST on are looked at.
DAMPING, ENOUGH, LEAST = 0.85, 1e-6, 1e-300
#: A host's distrust may be this share of its trust and distrust together.
MAX_DISTRUST = 0.5


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(rest)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        at, _, rest = text.partition("/")
        fits = ((host == at) | F.endswith(host, F.lit("." + at))) & F.startswith(path, F.lit("/" + rest))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def edges(pages: DataFrame, host: Column, html_col: str = "html") -> DataFrame:
    """(src, dst, w) between different hosts; w: the share of src's distinct linked hosts."""
    hrefs = F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(r"""(?i)\shref\s*=\s*["']?(?:https?:)?//([^/?#"'\s>]+)"""), F.lit(1))
    linked = pages.select(host.alias("src"), F.explode(F.array_distinct(F.transform(hrefs, ascii_lower))).alias("dst"))
    pairs = linked.where((F.col("src") != "") & (F.col("src") != F.col("dst"))).groupBy("src", "dst").agg(F.count("*").alias("n"))
    out = pairs.groupBy("src").agg(F.count("*").alias("out"))
    return pairs.join(out, "src").select("src", "dst", (1.0 / F.col("out")).alias("w"))


def spread(links: DataFrame, seeds: DataFrame, rounds: int | None = None, enough: float = ENOUGH) -> DataFrame:
    """(host, rank): personalised PageRank over links (src, dst, w) from seeds (host, seed), whose weights sum to one.

    Each round is one join and one pre-aggregated sum, cut from its lineage; it ends when no host's rank
    moves by more than enough of itself (a host reached for the first time moves by all of it), or after rounds if given.
    Mass that reaches a host without links returns to the seeds.
    """
    ranks = behind = stored(seeds.select("host", "seed", F.col("seed").alias("rank")))
    for _ in itertools.count() if rounds is None else range(rounds):
        flow = links.join(ranks, links.src == ranks.host).groupBy("dst").agg(F.sum(F.col("rank") * F.col("w")).alias("got"))
        moved = ranks.join(flow, ranks.host == flow.dst, "full").select(F.coalesce("host", "dst").alias("host"), F.coalesce("seed", F.lit(0.0)).alias("seed"), F.coalesce("rank", F.lit(0.0)).alias("was"), F.coalesce("got", F.lit(0.0)).alias("got"))
        moved = stored(moved)
        dropped(behind)
        behind = moved
        total = moved.agg(F.sum("got")).first()[0] or 0.0
        fresh = moved.withColumn("rank", F.col("seed") * (1 - DAMPING * total) + DAMPING * F.col("got"))
        ranks = fresh.select("host", "seed", "rank")
        if fresh.where((F.abs(F.col("rank") - F.col("was")) > enough * F.col("rank")) & (F.greatest("rank", "was") > LEAST)).isEmpty():
            break
    return ranks.select("host", "rank")


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules: tuple[tuple[str, str], ...] = RULES, max_distrust: float = MAX_DISTRUST) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, and the host's trust and distrust."""
    url = F.col(url_col)
    host, path = host_of(url), path_of(url)
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path")).select("id", "host", "path", rule.alias("rule"), verdict.alias("ruling"))
    hosts = stored(rows.where("host <> ''").groupBy("host").agg(F.count_if(F.col("ruling") == "allow").alias("good"), F.count_if(F.col("ruling") == "block").alias("bad")))
    sums = hosts.agg(F.sum("good"), F.sum("bad")).first()
    seeds = [hosts.where(F.col(c) > 0).select("host", (F.col(c) / F.lit(float(n or 1))).alias("seed")) for c, n in zip(("good", "bad"), sums, strict=True)]
    links = stored(edges(pages, host, html_col))
    trust = spread(links, seeds[0]).withColumnRenamed("rank", "trust")
    against = links.groupBy("dst").agg(F.count("*").alias("n"))
    turned = links.join(against, "dst").select(F.col("dst").alias("src"), F.col("src").alias("dst"), (1.0 / F.col("n")).alias("w"))
    distrust = spread(turned, seeds[1]).withColumnRenamed("rank", "distrust")
    tidy = lambda c: F.format_string("%.9e", F.coalesce(c, F.lit(0.0))).cast("double")  # noqa: E731  # ten digits of any rank, however small
    scored = trust.join(distrust, "host", "full").select("host", *[tidy(c).alias(c) for c in ("trust", "distrust")])
    zero = [F.coalesce(c, F.lit(0.0)).alias(c) for c in ("trust", "distrust")]
    both = rows.join(scored, "host", "left").select("id", "host", "path", "rule", "ruling", *zero)
    own = F.when(F.col("distrust") > max_distrust * (F.col("trust") + F.col("distrust")), F.lit("block")).otherwise(F.lit("allow"))
    return both.select("id", "host", "path", "rule", F.coalesce("ruling", own).alias("verdict"), "trust", "distrust")
