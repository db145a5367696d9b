"""Sentiment of a stream over days, sliding windows and sessions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _counts() -> list:
    def label(name: str):
        return F.count_if(F.col("sentiment_label") == name).alias(f"{name}_count")

    return [
        F.count(F.lit(1)).alias("tweet_count"),
        F.round(F.avg("sentiment_score"), 6).alias("avg_sentiment"),
        label("positive"),
        label("neutral"),
        label("negative"),
    ]


def daily_trend(scored: DataFrame, delay: str = "1 day") -> DataFrame:
    """Counts and mean score per UTC day of posts with created_at, sentiment_score and
    sentiment_label."""
    return (
        scored.withWatermark("created_at", delay)
        .groupBy(F.window("created_at", "1 day"))
        .agg(*_counts())
        .select(
            F.date_format("window.start", "yyyy-MM-dd").alias("day"),
            "tweet_count", "avg_sentiment", "positive_count", "neutral_count", "negative_count",
        )
    )


def sliding_trend(scored: DataFrame, length: str = "6 hours", step: str = "1 hour", delay: str = "1 day") -> DataFrame:
    """The same over windows that overlap: one of ``length`` begins every ``step``."""
    return (
        scored.withWatermark("created_at", delay)
        .groupBy(F.window("created_at", length, step))
        .agg(*_counts())
        .select(
            F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
            "tweet_count", "avg_sentiment", "positive_count", "neutral_count", "negative_count",
        )
    )


def author_sessions(scored: DataFrame, gap: str = "30 minutes", delay: str = "1 day") -> DataFrame:
    """Sessions of an author: posts that follow each other within the gap. Sessions that a later post
    joins are merged in the state."""
    return (
        scored.withWatermark("created_at", delay)
        .groupBy("author_id", F.session_window("created_at", gap).alias("_session"))
        .agg(
            F.count(F.lit(1)).alias("tweet_count"),
            F.round(F.avg("sentiment_score"), 6).alias("avg_sentiment"),
            F.max("created_at").alias("last_at"),
        )
        .select(
            "author_id", F.col("_session.start").alias("first_at"), "last_at", "tweet_count", "avg_sentiment"
        )
    )
