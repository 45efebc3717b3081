"""Connected components of an edge table, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component): component is the smallest node reachable over edges
    ``(a, b)`` of longs. Alternates two steps until nothing changes: hang all
    larger neighbours of a node on its smallest neighbour, then hang all
    smaller neighbours on the smallest. Both are one aggregate and one join on
    the node, so a hub's neighbours are never gathered in a task (the minimum is
    combined map-side and AQE splits a skewed join). Each round is written to
    the shared folder.
    """
    both = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = written(both, "cc")
    n = e.count()
    while n:
        sym = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = sym.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (sym.where("b > a").join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        large = written(large, "cc_large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("x"), F.col("m").alias("y")),
            F.struct(F.col("a").alias("x"), F.col("m").alias("y")))).alias("s"))
            .select(F.col("s.x").alias("a"), F.col("s.y").alias("b")).where("a <> b").distinct())
        new = written(small, "cc_small")
        changed = new.exceptAll(e).limit(1).count() + (new.count() != n)
        e, n = new, new.count()
        if not changed:
            break
    return (e.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
