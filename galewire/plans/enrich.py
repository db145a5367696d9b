"""From raw posts to the processed table."""

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galewire.operators.clean import clean_posts
from galewire.operators.dedup import dedup_chain_rows, whole_rows
from galewire.operators.filters import topic_filter
from galewire.operators.geo import join_place, join_user_location, resolve_geo
from galewire.operators.lang import Detector, detect_language, profile_detector
from galewire.operators.parse import (
    CORRUPT, REST, chain_rejects, flatten_posts, parse_posts, raw_json,
)
from galewire.operators.sentiment import Scorer, lexicon_scorer, score_sentiment
from galewire.operators.weather import enrich_weather, observations_between
from galewire.sources.scratch import materialize
from galewire.sources.storage import (
    PARTITION, scan_processed, to_processed, today, write_processed, write_raw_json,
)
from galewire.sources.tables import References

GEO_COLUMNS = [
    "geo_lat", "geo_lon", "geo_confidence", "geo_source", "place_name", "user_location_string",
]

# Columns of the parsed and of the cleaned posts that no later step and no table reads.
UNUSED_PARSED = ["raw_json", "mentions", "urls", "parse_timestamp"]
# What positions are made of.
LOCATED_BY = ["coordinates", "place", "place_id", "author_id", "user_location"]
# Tells posts apart that differ in any field.
ROW = "_row"
UNUSED_CLEANED = ["text", "hashtags", "emoji_list"]


def parsed_posts(raw: DataFrame) -> DataFrame:
    return parse_posts(flatten_posts(raw))


def locate_posts(posts: DataFrame, refs: References) -> DataFrame:
    """Position of each post, on narrow rows: (tweet_id, created_at, position columns)."""
    narrow = posts.select(
        "tweet_id", "created_at", "coordinates", "place", "place_id", "author_id", "user_location"
    )
    if refs.places is not None:
        narrow = join_place(narrow, refs.places)
    if refs.users is not None:
        narrow = join_user_location(narrow, refs.users)
    return resolve_geo(narrow, refs.gazetteer).select("tweet_id", "created_at", *GEO_COLUMNS)


@dataclass(frozen=True)
class TextModels:
    """What tags texts; each part is optional."""

    detector: Detector | None = None
    second_detector: Detector | None = None
    english: Scorer | None = None
    multilingual: Scorer | None = None
    fallback: Scorer | None = None


def text_models(refs: References, **plugged) -> TextModels:
    """Profile detector and lexicon fallback from the reference tables, made once per run; model
    plug-ins by name."""
    detector = None if refs.profiles is None else profile_detector(refs.profiles)
    defaults = {"detector": detector, "fallback": lexicon_scorer(refs.lexicon)}
    return TextModels(**(defaults | plugged))


def tag_texts(cleaned: DataFrame, models: TextModels) -> DataFrame:
    """Language and sentiment, in the row."""
    tagged = detect_language(cleaned, models.detector, models.second_detector)
    return score_sentiment(tagged, models.english, models.multilingual, models.fallback)


def weather_of(posts: DataFrame, refs: References, slot: str | None = None) -> DataFrame:
    """Position and weather of posts with unique ids, by ``tweet_id``; all lookups run on narrow rows.
    Positions are needed twice, for the distinct points and for the posts, so they are written
    once in between."""
    located = materialize(locate_posts(posts, refs), "located", slot)
    weather = enrich_weather(
        located, refs.stations, refs.observations, dataset_id=refs.dataset_id, slot=slot
    )
    return weather.drop("created_at", "processing_stage")


def add_weather(posts: DataFrame, refs: References, slot: str | None = None) -> DataFrame:
    """Position and weather of posts with unique ids. The wide rows are shuffled once, by tweet_id, to
    meet them."""
    return posts.join(weather_of(posts, refs, slot), "tweet_id", "left")


def bounded(refs: References, staged: DataFrame) -> References:
    """References with only the observations of the days the staged posts were written on."""
    first, last = staged.agg(F.to_date(F.min("created_at")), F.to_date(F.max("created_at"))).first()
    if first is None:
        return refs
    return replace(refs, observations=observations_between(refs.observations, first, last))


def kept_posts(raw: DataFrame, refs: References, only_topic: bool = False) -> DataFrame:
    """The posts the chain keeps, parsed, with position, weather and what their raw JSON is made of
    (``raw_json``), written once to the shared folder.

    Which posts are kept, and where and in what weather they were written, is found on narrow rows. Then
    the raw posts are read again and shuffled once to meet the answer, each with its text once. So a lost
    executor does not bring parsing and dedup back, and texts wait in no other table.
    """
    chosen = topic_filter(raw) if only_topic else raw
    parsed = parse_posts(flatten_posts(chosen, rest=True))
    row = F.unhex(F.md5(F.concat_ws("\n", F.to_json(REST), "text")))
    posts = parsed.withColumn(ROW, row).drop(*UNUSED_PARSED)
    kept = materialize(dedup_chain_rows(posts, ROW, LOCATED_BY), "kept")
    found = kept.select("tweet_id", ROW).join(weather_of(kept, bounded(refs, kept)), "tweet_id", "left")
    return materialize(whole_rows(posts, ROW, found).drop(ROW), "posts", codec="zstd")


def tag_posts(kept: DataFrame, models: TextModels) -> DataFrame:
    """Cleaned and tagged posts, in the row; each read of the result makes them anew."""
    return tag_texts(clean_posts(kept.drop(REST)), models).drop(*UNUSED_CLEANED)


def run(
    raw: DataFrame, refs: References, models: TextModels | None = None, only_topic: bool = False
) -> DataFrame:
    """Whole chain over a batch of raw posts. Texts are cleaned and tagged when the result is read: who
    reads it more than once writes it first."""
    return tag_posts(kept_posts(raw, refs, only_topic), models or text_models(refs))


def store(
    raw: DataFrame,
    refs: References,
    out: str,
    models: TextModels | None = None,
    processing_date: str | None = None,
    only_topic: bool = False,
    mode: str = "overwrite",
) -> DataFrame:
    """Run the chain and write its three outputs under ``out``: the processed table, the raw JSON
    of the posts in it, and the rejected records with their reasons, each by processing date.

    A second run of one date replaces what the first wrote on it; other dates stay. With mode
    ``append`` it is added, for a date that is filled by several runs on different posts.

    Raw JSON is that of the very posts in the processed table. Returns the written table.
    """
    spark = raw.sparkSession
    good = raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT) if CORRUPT in raw.columns else raw
    write_raw_json(chain_rejects(raw).withColumn(PARTITION, today(processing_date)), f"{out}/rejects", mode)
    kept = kept_posts(good, refs, only_topic)
    tagged = tag_posts(kept, models or text_models(refs))
    write_processed(to_processed(tagged, processing_date), f"{out}/processed", mode)
    copies = kept.select("tweet_id", "created_at", raw_json(kept).alias("raw_json"))
    write_raw_json(copies.withColumn(PARTITION, today(processing_date)), f"{out}/raw", mode)
    return scan_processed(spark, f"{out}/processed")
