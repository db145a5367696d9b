"""Duplicate removal over whole tables.

The earliest row by ``created_at`` wins. ``row_number() = 1`` is limited on the map side before
the shuffle, so a key that holds a large share of all rows sends at most one row per input
partition.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from galewire.functions.text import text_hash
from galewire.operators.filters import drop_reposts
from galewire.operators.groups import components
from galewire.sources.scratch import materialize


def _first_per(df: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def dedup_by_id(df: DataFrame) -> DataFrame:
    hashed = df.withColumn("_hash", text_hash(F.col("text")))
    return _first_per(hashed, "tweet_id", ["created_at", "_hash", "text"]).drop("_hash")


def dedup_by_text(df: DataFrame) -> DataFrame:
    """One post per text, ignoring case and surrounding white space."""
    hashed = df.withColumn("_hash", text_hash(F.col("text")))
    return _first_per(hashed, "_hash", ["created_at", "tweet_id", "text"]).drop("_hash")


def dedup_chain(df: DataFrame) -> DataFrame:
    """Drop reposts, then repeated ids, then repeated texts among the first rows per id."""
    return dedup_by_text(dedup_by_id(drop_reposts(df)))


def dedup_chain_rows(posts: DataFrame, row: str, carried: list[str]) -> DataFrame:
    """The rows that ``dedup_chain`` keeps, without their texts: tweet_id, created_at, ``row`` and the
    ``carried`` columns. Of posts as ``parse_posts`` makes them (id, time and text are filled), with a
    column ``row`` that differs wherever two posts differ in anything.

    Texts do not travel: rows of an id, a time and a text hash that spell the text differently, of which
    the first spelling counts, are looked up by themselves, if there are any. Rows that have the text in
    common as well are put in order by ``row``.
    """
    fresh = drop_reposts(posts).withColumn("_hash", text_hash(F.col("text")))
    place = ["tweet_id", "created_at", "_hash"]
    spelled = F.unhex(F.md5("text")).alias("_text")
    narrow = materialize(fresh.select(*place, spelled, row, *carried), "narrow", codec="zstd")
    spellings = narrow.groupBy(*place).agg(F.min("_text").alias("_low"), F.max("_text").alias("_high"))
    tied = materialize(spellings.where("_low != _high").select(*place), "tied")
    if not tied.isEmpty():
        texts = fresh.select(*place, "text").join(tied, place, "left_semi")
        first = texts.groupBy(*place).agg(F.unhex(F.md5(F.min("text"))).alias("_first"))
        narrow = narrow.join(first, place, "left").where("_first IS NULL OR _first = _text").drop("_first")
    by_id = _first_per(narrow, "tweet_id", ["created_at", "_hash", row])
    by_text = _first_per(by_id, "_hash", ["created_at", "tweet_id"])
    return by_text.select("tweet_id", "created_at", row, *carried)


def whole_rows(posts: DataFrame, row: str, kept: DataFrame) -> DataFrame:
    """The posts of ``kept`` (tweet_id and ``row``, once each) in full, with the other columns of ``kept``.
    Full rows are shuffled once, one for each different post and input partition."""
    return _first_per(posts, ["tweet_id", row], ["tweet_id"]).join(kept, ["tweet_id", row])


def dedup_vs_history(df: DataFrame, history: DataFrame) -> DataFrame:
    """Rows whose id and text were not seen before. ``history`` has tweet_id and text_hash."""
    hashed = df.withColumn("text_hash", text_hash(F.col("text")))
    ids = history.select("tweet_id").where(F.col("tweet_id").isNotNull()).distinct()
    hashes = history.select("text_hash").where(F.col("text_hash").isNotNull()).distinct()
    fresh = hashed.join(ids, "tweet_id", "left_anti").join(hashes, "text_hash", "left_anti")
    return fresh.drop("text_hash")


def _collapsed(df: DataFrame) -> DataFrame:
    """Identical copies folded into one narrow row with their number."""
    return df.groupBy(
        "tweet_id",
        "created_at",
        text_hash(F.col("text")).alias("text_hash"),
        F.coalesce("retweet_status", F.lit(False)).alias("retweet_status"),
    ).agg(F.count(F.lit(1)).alias("copies"))


def dedup_outcomes(df: DataFrame) -> DataFrame:
    """What the chain did with each post: kept, dup_id, dup_text or repost.

    One line per distinct (id, time, text) and outcome, with the number of rows behind it;
    winners are found on narrow, pre-aggregated rows.
    """
    groups = _collapsed(df)
    by_id = (
        groups.where(~F.col("retweet_status"))
        .groupBy("tweet_id")
        .agg(F.min(F.struct("created_at", "text_hash")).alias("_first"))
    )
    by_text = by_id.groupBy(F.col("_first.text_hash").alias("text_hash")).agg(
        F.min(F.struct("_first.created_at", "tweet_id")).alias("_first_text")
    )
    rows = groups.join(by_id, "tweet_id", "left").join(by_text, "text_hash", "left")
    outcome = (
        F.when(F.col("retweet_status"), "repost")
        .when(F.struct("created_at", "text_hash") != F.col("_first"), "dup_id")
        .when(F.struct("created_at", "tweet_id") != F.col("_first_text"), "dup_text")
        .otherwise("kept")
    )
    # Identical copies: the first one gets the outcome, the others repeat its id.
    single = outcome.isin("kept", "dup_text")
    first = F.struct(
        outcome.alias("dedup_outcome"),
        F.when(single, F.lit(1).cast("long")).otherwise(F.col("copies")).alias("n_rows"),
    )
    others = F.struct(F.lit("dup_id").alias("dedup_outcome"), (F.col("copies") - 1).alias("n_rows"))
    parts = F.filter(
        F.array(first, F.when(single & (F.col("copies") > 1), others)), lambda p: p.isNotNull()
    )
    return rows.withColumn("_part", F.explode(parts)).select(
        "tweet_id", "created_at", "text_hash", "_part.dedup_outcome", "_part.n_rows"
    )


PLACE = ["created_at", "tweet_id", "text_hash"]
# Pairs that one task walks through at most.
TASK_PAIRS = 100_000


def _settled(alive: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pairs that are the earliest of both their id and their text, and what they leave alive."""
    place = F.min(F.struct(*PLACE)).alias("p")
    first_of_id = alive.groupBy("tweet_id").agg(place).select("p.*")
    first_of_text = alive.groupBy("text_hash").agg(place).select("p.*")
    settled = materialize(first_of_id.join(first_of_text, PLACE), "settled")
    left = alive.join(settled.select("tweet_id"), "tweet_id", "left_anti").join(
        settled.select("text_hash"), "text_hash", "left_anti"
    )
    return settled, materialize(left, "pairs")


def _walked(groups: DataFrame) -> DataFrame:
    """The pairs that a pass in time order keeps, of rows with a ``_group`` each; no id and no text is
    in two groups."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, ids, texts = None, set(), set()
        for batch in batches:
            keep = []
            columns = [batch.column(c).to_pylist() for c in ("_group", "tweet_id", "text_hash")]
            for of, tweet_id, text in zip(*columns):
                if of != group:
                    group, ids, texts = of, set(), set()
                keep.append(tweet_id not in ids and text not in texts)
                if keep[-1]:
                    ids.add(tweet_id)
                    texts.add(text)
            yield batch.filter(pa.array(keep, pa.bool_())).select(PLACE)

    rows = groups.repartition("_group").sortWithinPartitions("_group", *PLACE).select("_group", *PLACE)
    return rows.mapInArrow(walk, rows.drop("_group").schema)


def greedy_pairs(pairs: DataFrame, task_pairs: int = TASK_PAIRS) -> DataFrame:
    """The (tweet_id, text_hash) pairs a row-by-row pass in time order would keep.

    Such a pass keeps a row when neither its id nor its text belongs to a row kept earlier: a
    maximal matching between ids and texts, greedy in time order. A pair that is the earliest of
    both its id and its text is always kept and rules out the others of either; nearly all pairs
    settle in this first step. What is left falls into components of ids and texts that touch each
    other, which do not depend on one another: each is walked through in time order by the task it
    lies in. Only components of over ``task_pairs`` pairs go on step by step. If no more than that is
    left in all, one task walks through it without a search for components.
    """
    alive = pairs.groupBy("tweet_id", "text_hash").agg(F.min("created_at").alias("created_at")).select(*PLACE)
    kept, left = _settled(materialize(alive.where("tweet_id IS NOT NULL AND text_hash IS NOT NULL"), "pairs"))
    n = left.count()
    if not n:
        return kept
    if n <= task_pairs:
        return kept.unionByName(_walked(left.withColumn("_group", F.lit(0).cast("long"))))
    ends = [F.xxhash64(F.lit(k), c).alias(x) for k, (c, x) in enumerate((("tweet_id", "a"), ("text_hash", "b")))]
    labels = components(left.select(*ends)).select(F.col("node").alias("_node"), F.col("label").alias("_group"))
    grouped = materialize(left.withColumn("_node", ends[0]).join(labels, "_node").drop("_node"), "grouped")
    large = materialize(
        grouped.groupBy("_group").agg(F.count("*").alias("_n")).where(F.col("_n") > task_pairs).select("_group"),
        "large-groups",
    )
    kept = kept.unionByName(_walked(grouped.join(large, "_group", "left_anti")))
    alive = materialize(grouped.join(large, "_group", "left_semi").select(*PLACE), "pairs")
    while not alive.isEmpty():
        settled, alive = _settled(alive)
        kept = kept.unionByName(settled)
    return kept


def dedup_greedy(df: DataFrame) -> DataFrame:
    """Exact row-by-row semantics: a row dropped for its text does not use up its id.

    Equal to ``dedup_chain`` whenever an id always carries one text. Wide rows are shuffled once: one
    per id, time and text and input partition, to meet the kept ones, of which an id has one.
    """
    fresh = drop_reposts(df).withColumn("text_hash", text_hash(F.col("text")))
    kept = greedy_pairs(fresh.select("tweet_id", "text_hash", "created_at"))
    return _first_per(fresh, PLACE, ["text"]).join(kept, PLACE, "left_semi").drop("text_hash")
