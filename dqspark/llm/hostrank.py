"""URL filter: explicit rules, and trust and distrust spread over the host graph.

Hosts whose pages a rule allows are trusted seeds, hosts whose pages a rule
blocks are blocked seeds. Personalised PageRank carries trust along links;
distrust goes against them, from a host to those that link to it. Where no rule
fits a page, its host's share of distrust decides.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqspark.llm.staging import Staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING, CLOSE_ENOUGH, THRESHOLD = 0.85, 1e-9, 0.5
#: Steps in one plan, and the least score of a host that is reached.
ROUND, LEAST = 8, sys.float_info.min
#: Fixed rules of the registered query: (verdict, host and beginning of the path).
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"(?i)(?:href|src)\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s>]+)"


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null; block wins a tie."""
    best = F.lit(None)
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block", r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        best = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(best)
    return best


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, w) between different hosts: links, counted, and each host's nearest parent.

    A parent is a host that has pages itself and whose name is the end of the
    other's after a dot; both point to each other with weight 1.
    """
    links = (
        pages.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1))).alias("dst"))
        .select("src", F.translate("dst", UPPER, LOWER).alias("dst"))
        .groupBy("src", "dst")
        .agg(F.count("*").alias("w"))
    )
    known = pages.select("host").distinct()
    labels = F.split("host", r"\.")
    ends = known.select(F.col("host").alias("child"), F.posexplode(
        F.transform(F.sequence(F.lit(2), F.greatest(F.size(labels), F.lit(2))), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    ).alias("cut", "host")).where("host <> ''")
    parents = ends.join(known, "host").groupBy("child").agg(F.min_by("host", "cut").alias("parent"))
    up = parents.select(F.col("child").alias("src"), F.col("parent").alias("dst"), F.lit(1).cast("long").alias("w"))
    down = up.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")
    both = links.unionByName(up).unionByName(down).where("src <> dst AND src <> '' AND dst <> ''")
    return both.groupBy("src", "dst").agg(F.sum("w").cast("double").alias("w"))


def spread(edges: DataFrame, seeds: DataFrame, staged: Staged, damping: float = DAMPING) -> DataFrame:
    """(kind, host, score): personalised PageRank of each kind of seeds.

    ``edges`` (kind, src, dst, w) and ``seeds`` (kind, host, weight); scores of a
    kind sum up to 1, what a host without way out holds returns to the seeds.
    That only scales the sum over all walks from the seeds, so each step adds what
    walks one link longer bring. Steps end when no host is reached for the first
    time any more and no host's sum grows by more than CLOSE_ENOUGH of itself,
    which holds from then on; hosts far from all seeds take a step a link. Each
    ROUND of steps is written to the shared folder; the driver reads two numbers
    a round. Sums too small for a double stay at the least normal one.
    """
    total = seeds.groupBy("kind").agg(F.sum("weight").alias("all"))
    start = staged.write(
        seeds.join(total, "kind").where("weight > 0").select("kind", "host", (F.col("weight") / F.col("all")).alias("got"), (F.col("weight") / F.col("all")).alias("score"))
    )
    out = edges.groupBy("kind", "src").agg(F.sum("w").alias("all"))
    shares = edges.join(out, ["kind", "src"]).select(
        "kind", F.col("src").alias("host"), "dst", (damping * F.col("w") / F.col("all")).alias("share"), F.lit(0).alias("own")
    )
    # A host's own row hands its sum on to the next step.
    hosts = start.select("kind", "host").union(edges.select("kind", "src")).union(edges.select("kind", "dst")).distinct()
    own = hosts.select("kind", "host", F.col("host").alias("dst"), F.lit(0.0).alias("share"), F.lit(1).alias("own"))
    shares = staged.write(shares.unionByName(own))
    current = start
    while True:
        following = current.select("kind", "host", "got", "score")
        for _ in range(ROUND):
            sent = following.join(shares, ["kind", "host"]).groupBy("kind", F.col("dst").alias("host"))
            sent = sent.agg(F.sum(F.col("got") * F.col("share")).alias("got"), F.sum(F.col("score") * F.col("own")).alias("old"), F.max("own").alias("known"))
            following = sent.select("kind", "host", "got", F.greatest(F.col("old") + F.col("got"), F.lit(LEAST)).alias("score"), "known")
        following = staged.write(following)
        growth, known = following.agg(F.max(F.col("got") / F.col("score")), F.min("known")).first()
        staged.drop(current)
        current = following
        if known != 0 and (growth or 0.0) <= CLOSE_ENOUGH:
            break
    total = current.groupBy("kind").agg(F.sum("score").alias("all"))
    return current.join(total, "kind").select("kind", "host", (F.col("score") / F.col("all")).alias("score"))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """id, host, path, rule, verdict, trust and distrust for each row of ``pages``.

    Null urls and such without ``://`` have an empty host and path; they are in
    no graph, as are null pages' links, and are allowed without a rule. A host
    is blocked where distrust makes up more than ``threshold`` of its trust and
    distrust; a host that neither reaches is allowed. Repeated rows each count.
    No rows give no rows. Other columns are not read.
    """
    staged = Staged(pages.sparkSession, "hostrank")
    read = pages.select(
        F.col(id_col).alias("id"),
        url_host(F.col(url_col)).alias("host"),
        url_path(F.col(url_col)).alias("path"),
        F.col(html_col).alias("html"),
    )
    edges = staged.write(host_edges(read.select("host", "html")))
    read = read.drop("html").withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
    seeds = (
        read.where("host <> '' AND best IS NOT NULL")
        .groupBy(F.col("best.verdict").alias("kind"), "host")
        .agg(F.count("*").cast("double").alias("weight"))
    )
    forward = edges.select(F.lit("allow").alias("kind"), "src", "dst", "w")
    reverse = edges.select(F.lit("block").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "w")
    scores = spread(forward.unionByName(reverse), staged.write(seeds), staged)
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0))
    hosts = scores.groupBy("host").agg(of("allow").alias("trust"), of("block").alias("distrust"))
    hosts = hosts.withColumn("host_verdict", F.when(F.col("distrust") > threshold * (F.col("trust") + F.col("distrust")), "block").otherwise("allow"))
    joined = read.join(hosts, "host", "left")
    return joined.select(
        "id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", "host_verdict", F.lit("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )


def op9_host_pagerank(spark, sf_dir: str) -> DataFrame:
    found = judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.withColumnRenamed("id", "page_id")
