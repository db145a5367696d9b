"""Rows that come after the watermark, kept apart instead of dropped."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BooleanType

from galewire.sources.storage import BATCH

SHARDS = 64
LATE = "late"


def marked_late(df: DataFrame, time: str, delay: str, spread: str, shards: int = SHARDS) -> DataFrame:
    """``df`` with ``late``: whether a row's time is not after the watermark when it arrives, which is
    when Spark's own operators would drop it.

    The watermark of a micro-batch is the greatest time of the batches before it, less the delay. A
    row without a time is never late. Rows are dealt out by ``spread``; no state is kept.
    """
    keyed = df.withWatermark(time, delay).withColumn(
        "_shard", F.pmod(F.xxhash64(spread), F.lit(shards))
    )
    schema = df.schema.add(LATE, BooleanType())

    def mark(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark_at = pd.Timestamp(state.getCurrentWatermarkMs(), unit="ms")
        for some in rows:
            some = some.drop(columns=["_shard"])
            some[LATE] = (some[time] <= mark_at).fillna(False).astype(bool)
            yield some

    return keyed.groupBy("_shard").applyInPandasWithState(
        mark, schema, "n int", "append", GroupStateTimeout.NoTimeout
    )


def write_split(batch: DataFrame, out: str, batch_id: int) -> None:
    """Rows in time and late rows of a micro-batch, each in a folder of the batch, which is replaced
    when the batch runs again."""
    batch.persist()
    for folder, chosen in (("in_time", ~F.col(LATE)), (LATE, F.col(LATE))):
        batch.where(chosen).drop(LATE).write.mode("overwrite").parquet(f"{out}/{folder}/{BATCH}={batch_id}")
    batch.unpersist()


def start_split(marked: DataFrame, out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write a marked stream to ``in_time`` and ``late``: each row is in one of them."""
    return (
        marked.writeStream.foreachBatch(lambda batch, batch_id: write_split(batch, out, batch_id))
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )
