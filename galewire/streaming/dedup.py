"""Duplicate removal on a stream, with state bounded by event time."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galewire.functions.text import text_hash
from galewire.operators.filters import drop_reposts


#: How many tasks share the rows of one text before they meet.
SALTS = 32


def stream_dedup(df: DataFrame, delay: str = "1 day") -> DataFrame:
    """First post per id, then per text, within the watermark delay.

    State is hashed over the executors and forgotten once the watermark has passed it. A text is
    first made single within each of SALTS groups of ids, so that of a text everybody repeats a
    few rows only meet in one task. Rows later than the watermark are dropped by Spark;
    ``metrics.StageTotals`` counts them.
    """
    fresh = drop_reposts(df).withWatermark("created_at", delay)
    by_id = fresh.dropDuplicatesWithinWatermark(["tweet_id"])
    hashed = by_id.withColumns(
        {"_hash": text_hash(F.col("text")), "_salt": F.pmod(F.xxhash64("tweet_id"), F.lit(SALTS))}
    )
    fewer = hashed.dropDuplicatesWithinWatermark(["_hash", "_salt"])
    return fewer.dropDuplicatesWithinWatermark(["_hash"]).drop("_hash", "_salt")
