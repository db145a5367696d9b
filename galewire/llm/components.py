"""Connected components of an edge table, by contraction, without gathering any component."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galewire.sources.scratch import materialize


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` for every node of edges (``a``, ``b``): nodes of one component, and
    no others, share a label, which is one of them.

    Each round moves every node to the least of itself and its neighbours and keeps the edges
    between the moved nodes; rounds grow with the logarithm of a component, as labels are in no
    order along a path. Each is written to the shared folder, so the plan stays short and a lost
    executor costs one round. Null ends are ignored; repeated edges and loops do no harm.
    """

    def tidy(e: DataFrame) -> DataFrame:
        return e.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    left = materialize(tidy(edges), "edges")
    maps = []
    while not left.isEmpty():
        ends = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moved = materialize(
            ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_m"))
            .select("node", F.least("node", "_m").alias("label")),
            "labels",
        )
        maps.append(moved)
        a = moved.select(F.col("node").alias("a"), F.col("label").alias("_a"))
        b = moved.select(F.col("node").alias("b"), F.col("label").alias("_b"))
        left = materialize(
            tidy(left.join(a, "a").join(b, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))),
            "edges",
        )
    if not maps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("label"))

    def compose(later: DataFrame, earlier: DataFrame) -> DataFrame:
        after = later.select(F.col("node").alias("label"), F.col("label").alias("_end"))
        return earlier.join(after, "label", "left").select("node", F.coalesce("_end", "label").alias("label"))

    return materialize(reduce(compose, reversed(maps)), "components")
