"""The chain as a streaming query."""

import hashlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from galewire.operators.clean import clean_posts
from galewire.operators.filters import topic_filter
from galewire.operators.parse import CORRUPT, REST, chain_rejects, flatten_posts, parse_posts, raw_json
from galewire.plans.enrich import (
    UNUSED_CLEANED, UNUSED_PARSED, TextModels, bounded, tag_texts, text_models, weather_of,
)
from galewire.sources.posts import stream_posts
from galewire.sources.scratch import forget_shuffles, materialize
from galewire.sources.storage import BATCH, JSON_CODEC, PARTITION, batch_date, batch_folder, to_processed
from galewire.sources.tables import References
from galewire.streaming.dedup import stream_dedup
from galewire.streaming.metrics import count_stage

# Fixed value: how often to read what has arrived and write it.
WRITE_INTERVAL = "300 seconds"
# Posts whose position and weather, some hundred bytes each, go to every task at a time.
GROUP_ROWS = 100_000
# The file a row of a table lies in.
FILE = "_metadata.file_path AS _file"


def trigger_options(once: bool, interval: str) -> dict:
    return {"availableNow": True} if once else {"processingTime": interval}


def readable(raw: DataFrame) -> DataFrame:
    return raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT) if CORRUPT in raw.columns else raw


def cleaned_stream(raw: DataFrame, delay: str = "1 day", only_topic: bool = False) -> DataFrame:
    """Parsed, deduplicated and cleaned posts of a raw stream, with counters of each stage."""
    good = readable(raw)
    chosen = topic_filter(good) if only_topic else good
    flat = count_stage(flatten_posts(chosen, rest=True), "flatten", reposts=F.col("retweet_status"))
    # Rows are shuffled three times to meet the state: each text goes along once.
    parsed = count_stage(parse_posts(flat), "parse").drop(*UNUSED_PARSED)
    return count_stage(
        clean_posts(stream_dedup(parsed, delay)), "clean", with_emoji=F.col("emoji_count") > 0
    )


def file_groups(rows: dict[str, int], most: int = GROUP_ROWS) -> list[list[str]]:
    """Files in groups of ``most`` rows at most, a larger file alone."""
    groups, held = [], 0
    for file, n in sorted(rows.items()):
        if not groups or held + n > most:
            groups.append([])
            held = 0
        groups[-1].append(file)
        held += n
    return groups


def of_files(table: DataFrame, files: list[str]) -> DataFrame:
    """The rows of some files of a table; no other file is opened."""
    return table.selectExpr("*", FILE).where(F.col("_file").isin(files)).drop("_file")


def with_weather(staged: DataFrame, refs: References, slot: str) -> Iterator[DataFrame]:
    """The staged posts with position and weather, in parts that are read one after the other, so that no
    text is shuffled: a part is some files of the table, and what was found for its posts, GROUP_ROWS
    narrow rows or those of one file, goes to each task."""
    narrow = staged.selectExpr("tweet_id", FILE)
    found = materialize(weather_of(staged, bounded(refs, staged), slot).join(narrow, "tweet_id"), "found", slot)
    rows = {r._file: r.n for r in narrow.groupBy("_file").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not rows:
        yield staged.join(found.drop("_file"), "tweet_id", "left")
    for group in file_groups(rows):
        its = found.where(F.col("_file").isin(group)).drop("_file")
        yield of_files(staged, group).join(F.broadcast(its), "tweet_id", "left")


def write_batch(tagged: DataFrame, refs: References, out: str, batch_id: int) -> None:
    """Add weather to one micro-batch and write it twice: Parquet table and raw JSON, each under
    its processing date.

    Each batch owns its folder and replaces it, and keeps the date of its first run, so a batch
    that is run again after a failure leaves no second copy.
    """
    place = hashlib.md5(out.encode()).hexdigest()
    again = [c for c in UNUSED_CLEANED if c in tagged.columns]
    staged = materialize(tagged.drop(*again), "batch", slot=place, codec="zstd")
    forget_shuffles(tagged)
    day = batch_date(staged.sparkSession, out, batch_id)
    folder, mode = batch_folder(f"{out}/processed", day, batch_id), "overwrite"
    for part in with_weather(staged.drop("raw_json", REST), refs, place):
        to_processed(part, day).drop(PARTITION).write.mode(mode).option("compression", "snappy").parquet(folder)
        mode = "append"
    copies = staged.withColumnRenamed("text_original", "text")
    copies.select("tweet_id", "created_at", raw_json(copies).alias("raw_json")).write.mode("overwrite").option(
        "compression", JSON_CODEC
    ).json(batch_folder(f"{out}/raw", day, batch_id))


def write_rejects(raw: DataFrame, out: str, batch_id: int) -> None:
    day = batch_date(raw.sparkSession, f"{out}/rejects-log", batch_id)
    rejects = chain_rejects(raw).write.mode("overwrite").option("compression", JSON_CODEC)
    rejects.json(batch_folder(f"{out}/rejects", day, batch_id))


def start_rejects(
    spark: SparkSession,
    folder: str,
    out: str,
    checkpoint: str,
    once: bool = False,
    interval: str = WRITE_INTERVAL,
    files_per_trigger: int = 1000,
) -> StreamingQuery:
    """The query beside the chain that keeps what the chain does not take: unreadable lines and
    posts that break a rule, each with its reason, by processing date. It holds no state."""
    raw = count_stage(
        stream_posts(spark, folder, files_per_trigger), "read", corrupt=F.col(CORRUPT).isNotNull()
    )
    return (
        raw.writeStream.foreachBatch(lambda batch, batch_id: write_rejects(batch, out, batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(once, interval))
        .start()
    )


def start(
    spark: SparkSession,
    folder: str,
    refs: References | Callable[[], References],
    out: str,
    checkpoint: str,
    once: bool = False,
    interval: str = WRITE_INTERVAL,
    delay: str = "1 day",
    files_per_trigger: int = 1000,
    models: TextModels | None = None,
    only_topic: bool = False,
) -> StreamingQuery:
    """Start the query on a folder of JSON Lines files. ``start_rejects`` keeps what it leaves out,
    and ``metrics.StageTotals`` adds up its counters.

    The weather lookup aggregates, so it runs inside each micro-batch, on the observations of the
    batch's days. ``refs`` may be a function: it is called for every batch and can return tables
    that have grown since.
    """

    def tables() -> References:
        return refs() if callable(refs) else refs

    raw = stream_posts(spark, folder, files_per_trigger)
    cleaned = cleaned_stream(raw, delay, only_topic)
    tagged = count_stage(tag_texts(cleaned, models or text_models(tables())), "tag")
    return (
        tagged.writeStream.foreachBatch(
            lambda batch, batch_id: write_batch(batch, tables(), out, batch_id)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(once, interval))
        .start()
    )


def read_output(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/processed").drop(BATCH)


def read_rejects(spark: SparkSession, out: str) -> DataFrame:
    schema = "tweet_id string, created_at string, reject_reason string, raw_json string"
    return spark.read.schema(f"{schema}, {PARTITION} string, {BATCH} bigint").json(f"{out}/rejects")
