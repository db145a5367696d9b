"""As-of join: the last and the next moment of another table, for many moments of a key."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLICE = "_slice"


def sliced(df: DataFrame, at: str, width: int) -> DataFrame:
    """``df`` with the number of the time slice of its moments (whole numbers)."""
    return df.withColumn(SLICE, F.floor(F.col(at) / F.lit(width)).cast("long"))


def slice_edges(seen: DataFrame, keys: list[str], at: str, width: int) -> DataFrame:
    """First and last moment of each occupied slice of a key: ``first_at``, ``last_at``."""
    return sliced(seen, at, width).groupBy(*keys, SLICE).agg(
        F.min(at).alias("first_at"), F.max(at).alias("last_at")
    )


def as_of(
    asked: DataFrame, seen: DataFrame, keys: list[str], at: str, width: int, edges: DataFrame | None = None
) -> DataFrame:
    """``asked`` (keys and moment, distinct, none of them null) with ``before`` and ``after``: the last
    moment of ``seen`` that is not later and the first that is not earlier, null where there is none.

    Asked and seen moments of a key and time slice are one stream in order of time, from which each
    asked moment takes the last seen one, and once more in the other direction. What lies beyond a
    slice is handed over from a table with one row per occupied slice, so no task holds more than a
    slice of a key, and no row an array. Seen moments of slices nobody asks for are dropped first.
    ``edges`` may give that table (keys, slice, first_at, last_at) if it is known already.
    """
    asked = sliced(asked.select(*keys, at), at, width)
    places = asked.select(*keys, SLICE).distinct()
    moments = sliced(seen.select(*keys, at), at, width).join(places, [*keys, SLICE], "left_semi")
    stream = moments.withColumn("_asked", F.lit(False)).unionByName(asked.withColumn("_asked", F.lit(True)))

    # A frame that ends at the current row is kept up to date; one that starts there is made anew
    # for every row. So the second direction sorts the other way round.
    own = Window.partitionBy(*keys, SLICE)
    upto = (Window.unboundedPreceding, Window.currentRow)
    seen_at = F.when(~F.col("_asked"), F.col(at))
    met = (
        stream.withColumn("_before", F.last(seen_at, True).over(own.orderBy(at, "_asked").rowsBetween(*upto)))
        .withColumn("_after", F.last(seen_at, True).over(own.orderBy(F.desc(at), "_asked").rowsBetween(*upto)))
        .where("_asked").select(*keys, SLICE, at, "_before", "_after")
    )

    if edges is None:
        edges = slice_edges(seen, keys, at, width)
    none = F.lit(None).cast("long")
    grid = (
        edges.select(*keys, SLICE, "first_at", "last_at")
        .unionByName(places.select("*", none.alias("first_at"), none.alias("last_at")))
        .groupBy(*keys, SLICE).agg(F.max("first_at").alias("first_at"), F.max("last_at").alias("last_at"))
    )
    line, past = Window.partitionBy(*keys), (Window.unboundedPreceding, -1)
    beyond = (
        grid.withColumn("_last", F.last("last_at", True).over(line.orderBy(SLICE).rowsBetween(*past)))
        .withColumn("_next", F.last("first_at", True).over(line.orderBy(F.desc(SLICE)).rowsBetween(*past)))
        .select(*keys, SLICE, "_last", "_next")
    )
    return met.join(beyond, [*keys, SLICE]).select(
        *keys, at, F.coalesce("_before", "_last").alias("before"), F.coalesce("_after", "_next").alias("after")
    )
