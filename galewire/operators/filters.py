"""Row filters."""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galewire.operators.parse import is_repost

# The topic words and hashtags.
TOPIC_WORDS = ["storm", "cyclone", "flood", "heatwave", "wildfire"]
TOPIC_HASHTAGS = ["climatechange", "climate", "weather"]


def topic_pattern(words=TOPIC_WORDS, hashtags=TOPIC_HASHTAGS) -> str:
    any_word = "|".join(re.escape(w) for w in words)
    any_tag = "|".join(re.escape(t) for t in hashtags)
    return rf"(?i)(?:\b(?:{any_word})\b|#(?:{any_tag})\b)"


def topic_filter(
    df: DataFrame, words=TOPIC_WORDS, hashtags=TOPIC_HASHTAGS, lang: str | None = None
) -> DataFrame:
    """Posts on the topic that are no reposts, optionally in one language."""
    text = F.col("text")
    kept = df.where(~is_repost(text) & text.rlike(topic_pattern(words, hashtags)))
    return kept if lang is None else kept.where(F.col("lang") == lang)


def drop_reposts(df: DataFrame) -> DataFrame:
    return df.where(~F.coalesce("retweet_status", F.lit(False)))


def newer_than(df: DataFrame, mark: DataFrame, id_column: str = "id") -> DataFrame:
    """Rows whose id is above the mark, a one-row table as ``next_high_water_mark`` makes it;
    all rows when the mark is null (first run). Ids compare as numbers: as texts, 9 would
    follow 10. An id that is no number has no place in that order: such rows are not newer; see
    ``without_number``."""
    newest = mark.select(F.col("high_water_mark").cast("decimal(38,0)")).scalar()
    return df.where(newest.isNull() | (F.col(id_column).try_cast("decimal(38,0)") > newest))


def without_number(df: DataFrame, id_column: str = "id") -> DataFrame:
    """Rows that no since-id read can place: their id is null or no number."""
    return df.where(F.col(id_column).try_cast("decimal(38,0)").isNull())


def next_high_water_mark(df: DataFrame, id_column: str = "id") -> DataFrame:
    """One row with the newest id."""
    newest = F.max(F.col(id_column).try_cast("decimal(38,0)")).cast("string")
    return df.agg(newest.alias("high_water_mark"))


def is_quality_row() -> Column:
    """The condition a processed row must meet to enter the analytics table."""
    return (
        F.col("geo_confidence").isin("high", "medium")
        & F.col("weather_station_id").isNotNull()
        & (F.col("sentiment_confidence") > 0.5)
        & (F.col("text_length") > 10)
    )
