"""Connected components of a link table, by alternating large and small stars.

Every round replaces the links of each node by links to the smallest node it
knows. The minimum per node is combined map-side, and the links are joined with
it, so a node with very many links is a skewed join (which Spark splits) and not
a group in one task. Rounds end when the table stops changing; each round is
written to the checkpoint folder, so lineage does not grow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import checkpointed


def _both_ways(links: DataFrame) -> DataFrame:
    ends = F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                             F.struct(F.col("b").alias("u"), F.col("a").alias("v"))))
    return links.select(ends.alias("e")).select("e.u", "e.v")


def _large_star(links: DataFrame) -> DataFrame:
    near = _both_ways(links)
    low = near.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return (near.where("v > u").join(low, "u")
            .select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.union(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def _mark(links: DataFrame):
    row = links.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links`` (columns a, b: bigint).

    The component is its smallest node. Self-links, null ends and repeated links
    are ignored; an empty table gives an empty result.
    """
    now = checkpointed(links.select("a", "b").where("a <> b")
                       .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = _mark(now)
    while True:
        now = checkpointed(_small_star(_large_star(now)))
        last, mark = mark, _mark(now)
        if mark == last:
            break
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component")))
