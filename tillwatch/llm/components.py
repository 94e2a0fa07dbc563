"""Connected components of links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b: long); two nodes have one label if links lead from one to the other.

    In each round a node points to the neighbour of the smallest hash, if that is smaller than its
    own; the links between the groups are what is left for the next round. A random order of the nodes
    keeps pointers short and halves the groups at least, in expectation. All tables of a round are
    written, so a lost executor costs one step; no step brings the links of a node together in one
    task: minima combine before the shuffle, and joins have plain tables on either side, which Spark can split.
    """
    a, b = F.col("a"), F.col("b")
    links = kept(links.where(a != b).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "links")
    labels = kept(links.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("label", F.col("node")), "labels")
    while not links.isEmpty():
        ends = links.select(F.inline(F.array(F.struct(a.alias("node"), b.alias("to")), F.struct(b.alias("node"), a.alias("to")))))
        best = ends.groupBy("node").agg(F.min(F.struct(F.xxhash64("to").alias("h"), F.col("to").alias("id"))).alias("best"))
        mine = F.struct(F.xxhash64("node").alias("h"), F.col("node").alias("id"))
        up = kept(best.select("node", F.least("best", mine)["id"].alias("up")), "up")
        for _ in range(2):  # a group's pointers may still be longer; then it takes another round
            over = up.select(F.col("node").alias("up"), F.col("up").alias("over"))
            up = kept(up.join(over, "up").select("node", F.col("over").alias("up")), "up")
        for end in ("a", "b"):
            links = links.join(up.withColumnRenamed("node", end), end).drop(end).withColumnRenamed("up", end)
        links = kept(links.where(a != b).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "links")
        labels = kept(labels.join(up.withColumnRenamed("node", "label"), "label", "left").select("node", F.coalesce("up", "label").alias("label")), "labels")
    return labels
