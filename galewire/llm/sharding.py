"""Shards that each hold the mixture: proportional stratified interleaving.

The rows of a source are put in seeded random order; row k of n gets the fraction (k + 0.5) / n.
All rows are sorted by fraction and cut into shards of equal counts, at most one apart, so every
shard has each source's share to within a row or so, and is itself well mixed at any prefix.

Two exchanges of the rows given: by (source, slice of the random order) and by slice of the
fraction. Slices before a row are counted, not gathered, so no task holds a source or a shard.

Defined results: a null source is a stratum of its own; null texts count 1 byte and have no
checksum; repeated rows each get their own slot. An empty table gives no rows.
"""

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from galewire.llm.rows import SLICE_ROWS, key_shift, order_key, ranked, with_row_id
from galewire.sources.scratch import materialize

SHARDS = 16
SEED = 29


def interleave(
    rows: DataFrame, carry: str, source: str, n_shards: int = SHARDS, seed: int = SEED, order_by: str | None = None
) -> DataFrame:
    """``carry``, ``shard`` and ``slot`` (from 0 in each shard) for every row.

    ``rows`` is read three times: give a written table, narrow, whose ``carry`` tells its rows
    apart. The random order follows from ``order_by`` (unless given: ``carry``), ties from ``carry``.
    """
    key = F.when(F.col(source).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source)))
    keyed = rows.select(
        F.col(carry).alias("carry"), key.alias("source_key"), order_key(seed, F.col(order_by or carry)).alias("order")
    )
    n = rows.count()
    parts = max(1, math.ceil(n / SLICE_ROWS))
    fraction = (F.col("rank") + 0.5) / F.col("group_rows")
    spread = materialize(
        ranked(keyed, ["source_key"], "order", key_shift(n), ["carry"]).select(
            "carry", "source_key", "order", fraction.alias("fraction"),
            F.floor(fraction * parts).alias("part"),
        ),
        "shard-fractions",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spread.groupBy("part").agg(F.count("*").alias("_n")).select(
        "part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    own = Window.partitionBy("part").orderBy("fraction", "source_key", "order", "carry")
    placed = spread.join(offsets, "part").withColumn("_at", F.col("_before") + F.row_number().over(own) - 1)
    return placed.select(
        F.col("carry").alias(carry),
        F.expr(f"(_at * {n_shards}) div {max(n, 1)}").cast("int").alias("shard"),
        "_at",
    ).select(
        carry, "shard",
        # A shard begins at the first place p with p * n_shards >= shard * n.
        (F.col("_at") - F.expr(f"(shard * {n}L + {n_shards - 1}) div {n_shards}")).alias("slot"),
    )


def write_shards(docs: DataFrame, path: str) -> None:
    """Documents with ``shard`` and ``slot``, one folder per shard, each file in slot order.

    A shard is written by as many tasks as its size asks for, in runs of consecutive slots.
    """
    docs.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).mode("overwrite").parquet(path)


def shard_documents(docs: DataFrame, n_shards: int = SHARDS, source: str = "source") -> DataFrame:
    """The input rows with ``shard`` and ``slot``; input columns of these names are replaced."""
    named = with_row_id(docs)
    # Slots follow from content; equal rows, which only their places tell apart, may trade theirs.
    place = F.struct("digest", "rid").alias("place")
    rows = materialize(named.select(place, "digest", F.col(f"row.`{source}`").alias("source")), "shard-rows")
    placed = interleave(rows, "place", "source", n_shards, order_by="digest")
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in ("shard", "slot")]
    return named.join(placed.withColumn("rid", F.col("place.rid")), "rid").select(*kept, "shard", "slot")
