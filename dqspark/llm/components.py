"""Connected components of an edge table, distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqspark.llm.staging import Staged


def components(edges: DataFrame, staged: Staged) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the smallest node.

    Alternates large-star and small-star (Kiveris et al., 2014) until nothing
    changes, about log(nodes) rounds. Each round is written to the shared folder
    and the one before is removed. A round keeps at most as many edges as the
    one before; the minimum of a node's neighbours is combined before it is
    shuffled. Null ends and self loops are ignored, so a node with no other
    neighbour is not in the result.
    """
    # AQE splits the rows of a hot root in the joins below.
    current = staged.write(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    )
    mark = None
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staged.write(large.where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        following = staged.write(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        staged.drop(current)
        staged.drop(large)
        current = following
        seen = current.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if seen == mark:
            break
        mark = seen
    star = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return star.unionByName(star.select(F.col("root").alias("node"), "root").distinct())
