"""Connected components of a graph given by its edges."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galewire.sources.scratch import materialize


def _tidy(edges: DataFrame) -> DataFrame:
    """Each edge once, from the greater to the lesser end; no loops."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """``a`` and ``m``, the least of its neighbours and itself."""
    return edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the least node of its component, for every node of edges (``a``, ``b``,
    whole numbers).

    Large-star and small-star steps in turn (Kiveris and others, 2014): each node links its greater
    neighbours, then its lesser ones, to the least node it knows, until all that is left are stars. The
    edges never become more; the number of steps grows with the logarithm of a component. No
    neighbourhood is gathered: minima are aggregated before they are shuffled and joined back. Each
    step is written to the shared folder, so the plan stays short.
    """
    star, mark = materialize(_tidy(edges), "star"), None
    while True:
        both = star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _tidy(
            both.where("b > a").join(_least_neighbour(both), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        least = _least_neighbour(large)
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
        star = materialize(_tidy(small), "star")
        before, mark = mark, star.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            break
    roots = star.select(F.col("b").alias("node")).distinct()
    return star.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        roots.select("node", F.col("node").alias("label"))
    )
