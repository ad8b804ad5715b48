"""Connected components of a link table by repeated contraction, all on Spark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, label) for every node of ``links(a, b)``: equal labels exactly for nodes
    joined by a chain of links.

    Each round every node moves to the neighbour of highest degree (ties by a hash that
    changes with the round, itself included) and links are renamed; a star collapses in
    one round, a path shrinks by a constant factor, so ``rounds`` would be used up only by paths
    beyond any number of rows a table can hold; it raises then. Tables are written every round, so
    the lineage stays short and joins on busy nodes can be split by size.
    """
    edges = stored(links.select("a", "b").where("a <> b")
                   .select(F.explode(F.array(F.struct("a", "b"),
                                             F.struct(F.col("b").alias("a"),
                                                      F.col("a").alias("b")))).alias("e"))
                   .select("e.*").distinct(), "edges")
    nodes = stored(edges.groupBy("a").agg(F.count("*").alias("deg")), "nodes")
    label = nodes.select(F.col("a").alias("node"), F.col("a").alias("label"))
    for k in range(rounds):
        rank = lambda c: F.struct(F.col("deg"), F.xxhash64(F.lit(k), F.col(c)).alias("h"),
                                  F.col(c).alias("to"))
        around = edges.join(nodes.select(F.col("a").alias("b"), "deg"), "b")
        moved = stored(around.select(F.col("a"), rank("b").alias("r"))
                       .unionByName(nodes.select("a", rank("a").alias("r")))
                       .groupBy("a").agg(F.max("r").alias("r")).select("a", "r.to"), "moves")
        label = stored(label.join(moved, F.col("label") == F.col("a"), "left")
                       .select("node", F.coalesce("to", "label").alias("label")), "labels")
        half = stored(edges.join(moved.withColumnRenamed("to", "a2"), "a").select("a2", "b"), "half")
        edges = stored(half.join(moved.select(F.col("a").alias("b"), F.col("to").alias("b2")), "b")
                       .where("a2 <> b2").select(F.col("a2").alias("a"), F.col("b2").alias("b"))
                       .distinct(), "edges")
        if edges.isEmpty():
            return label
        nodes = stored(edges.groupBy("a").agg(F.count("*").alias("deg")), "nodes")
    raise RuntimeError(f"components did not settle in {rounds} rounds")
