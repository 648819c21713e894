"""Connected components by contraction, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavlake.llm.scratch import discard, staged


def components(links: DataFrame) -> DataFrame:
    """(v, root) for every vertex of ``links`` (a, b), root one vertex of its component.

    Each round gives the vertices that are still linked a new random order (a hash of vertex and round),
    hooks every vertex to its first neighbour if that comes before it, follows the
    hooks twice, and relabels the links; links inside a component vanish. Only vertices that come before all
    their neighbours stay themselves: about one in three of a path, fewer where there are more links. As the
    order is new each time, no numbering of the vertices makes this worse, and the rounds grow with the
    logarithm of the size. ``links`` may be empty, hold loops, both directions and repeats.
    """
    edges = staged(links.where("a <> b")
                   .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), "edges")
    labels = staged(edges.select(F.col("a").alias("v")).union(edges.select("b")).distinct()
                    .withColumn("root", F.col("v")), "labels")
    turn = 0
    while not edges.isEmpty():
        place = {c: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("id")) for c in ("a", "b")}
        turn += 1
        later = F.greatest(place["a"], place["b"])
        hook = (edges.select(later["id"].alias("a"), F.least(place["a"], place["b"]).alias("first"))
                .groupBy("a").agg(F.min("first").alias("first")).select("a", F.col("first.id").alias("p")))
        for _ in range(2):
            up = hook.select(F.col("a").alias("p"), F.col("p").alias("pp"))
            hook = (hook.join(up, "p", "left")
                    .select("a", F.coalesce("pp", "p").alias("p")))
        hook = staged(hook, "hooks")
        relabel = staged(
            labels.join(hook.withColumnRenamed("a", "root"), "root", "left")
            .select("v", F.coalesce("p", "root").alias("root")), "labels")
        to_a = hook.select("a", F.col("p").alias("pa"))
        to_b = hook.select(F.col("a").alias("b"), F.col("p").alias("pb"))
        left = (edges.join(to_a, "a", "left").join(to_b, "b", "left")
                .select(F.coalesce("pa", "a").alias("x"), F.coalesce("pb", "b").alias("y"))
                .where("x <> y"))
        smaller = staged(left.select(F.greatest("x", "y").alias("a"),
                                     F.least("x", "y").alias("b")).distinct(), "edges")
        discard(edges, labels, hook)
        edges, labels = smaller, relabel
    discard(edges)
    return labels
