"""Lookup joins that stay balanced when many rows share a key."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NULL_SLOTS = 4095


def lookup_join(facts: DataFrame, table: DataFrame, keys: list[str], spread: str) -> DataFrame:
    """Left join to a table that holds one row (or few) per key.

    Rows with a null key cannot match; they are spread over many partitions by ``spread``
    instead of meeting in one. A hot non-null key is heavy on the left side only, which is the
    case adaptive execution splits at run time. Whether the table is broadcast is decided by its
    measured size, never by a hint.
    """
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()
    # Slot 0 for every real key. It is written as a computation on both sides: a literal would be
    # folded out of the join keys, and the null rows would meet in one partition after all.
    matched = F.pmod(F.xxhash64(*keys), F.lit(1))
    spread_out = F.pmod(F.xxhash64(spread), F.lit(NULL_SLOTS)) + 1
    left = facts.withColumn("_slot", F.when(no_key, spread_out).otherwise(matched))
    right = table.withColumn("_slot", matched)
    return left.join(right, [*keys, "_slot"], "left").drop("_slot")
