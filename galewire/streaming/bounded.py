"""Duplicate removal on a stream with a memory of fixed size: the keys used last."""

from collections import OrderedDict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from galewire.functions.text import text_hash
from galewire.operators.filters import drop_reposts

SHARDS = 64
# Fixed value: how many keys are remembered, in all shards together.
REMEMBERED = 10_000
DIGEST = 16  # bytes


class LastUsed(StatefulProcessor):
    """Lets the first row of a key pass and remembers the ``most`` keys used last.

    A key that comes again is moved to the end, whether its row passes or not; beyond the bound the
    key that was used longest ago is forgotten. Rows of a micro-batch are taken in the order of
    ``order``. The state of a shard is one value: the digests of its keys in order of use.
    """

    def __init__(self, names: list[str], most: int, order: list[str]):
        self.names, self.most, self.order = names, most, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "digests binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # Computed columns arrive without their names.
        given = pd.concat([r.set_axis(self.names, axis=1) for r in rows]).sort_values(self.order, kind="stable")
        held = self.last.get()
        blob = bytes(held[0]) if held else b""
        used = OrderedDict((blob[k : k + DIGEST], None) for k in range(0, len(blob), DIGEST))
        fresh = []
        for digest in map(bytes, given["_digest"]):
            fresh.append(digest not in used)
            used[digest] = None
            used.move_to_end(digest)
            if len(used) > self.most:
                used.popitem(last=False)
        self.last.update((b"".join(used),))
        yield given[fresh].drop(columns=["_shard"])

    def close(self) -> None:
        pass


def first_of_key(
    df: DataFrame, key: str, order: list[str], most: int = REMEMBERED, shards: int = SHARDS
) -> DataFrame:
    """Rows of a stream whose key is not among those used last. Keys are dealt to shards by hash, and
    each shard remembers its part of ``most``; a null key passes as one key of its own."""
    digest = F.unhex(F.md5(F.coalesce(F.concat(F.lit("k"), F.col(key)), F.lit("-"))))
    keyed = df.withColumn("_digest", digest).withColumn("_shard", F.pmod(F.xxhash64("_digest"), F.lit(shards)))
    schema = keyed.drop("_shard").schema
    return (
        keyed.groupBy("_shard")
        .transformWithStateInPandas(LastUsed(keyed.columns, max(1, most // shards), order), schema, "Append", "None")
        .drop("_digest")
    )


def stream_dedup_lru(df: DataFrame, most: int = REMEMBERED, shards: int = SHARDS) -> DataFrame:
    """First post per id, then per text, among the ``most`` ids and texts used last.

    Unlike ``stream_dedup`` it needs no event time and forgets by count: state never grows beyond the
    bound, and a duplicate that comes after so many others is not recognised. Its columns go through
    pandas, so leave out nested ones that are not needed.
    """
    order = ["created_at", "tweet_id"]
    by_id = first_of_key(drop_reposts(df), "tweet_id", order, most, shards)
    hashed = by_id.withColumn("_hash", text_hash(F.col("text")))
    return first_of_key(hashed, "_hash", order, most, shards).drop("_hash")
