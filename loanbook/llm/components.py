"""Connected components by alternating large-star and small-star steps.

Every half step is a table in the shared folder, so joins run between plain tables, where
adaptive execution can split the partition of a node with very many links.
"""

from pyspark.sql import DataFrame, functions as F

from loanbook.llm.shared import keep


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = keep(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    least = keep(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of links (a, b); component is the smallest node reachable.

    Links may be repeated, in either direction, or of a node with itself; nulls link nothing.
    A node that is in no link to another node is not in the result. No links give no rows.
    """
    edges = keep(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("a is not null and b is not null and u > v").distinct(), "edges")
    state = None
    while True:
        digest = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(digest) == state or digest[0] == 0:
            break
        state = tuple(digest)
        edges = keep(_small(keep(_large(edges), "large")), "small")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
