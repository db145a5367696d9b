"""Reports over the analytics and processed tables.

Every top-k carries enough tie-breakers to name its rows uniquely.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galewire.functions.text import stable_round


def _avg(column: str, digits: int) -> Column:
    return stable_round(F.avg(column), digits)


def _mean(column: str) -> Column:
    return F.round(F.avg(column), 10)


def _n() -> Column:
    return F.count(F.lit(1))


def sentiment_distribution(analytics: DataFrame) -> DataFrame:
    return (
        analytics.groupBy("sentiment_label")
        .agg(
            _n().alias("tweet_count"),
            _avg("sentiment_score", 3).alias("avg_score"),
            _avg("sentiment_confidence", 3).alias("avg_confidence"),
        )
        .orderBy(F.desc("tweet_count"), "sentiment_label")
    )


def _negative(analytics: DataFrame) -> DataFrame:
    return analytics.where(F.col("sentiment_label") == "negative")


def negative_locations(analytics: DataFrame, digits: int = 2, k: int = 10) -> DataFrame:
    return (
        _negative(analytics)
        .groupBy(
            F.round("geo_lat", digits).alias("lat"),
            F.round("geo_lon", digits).alias("lon"),
            "place_name",
        )
        .agg(
            _n().alias("negative_tweet_count"),
            _avg("sentiment_score", 3).alias("avg_sentiment"),
            _avg("weather_temp_c", 1).alias("avg_temp_c"),
            _avg("weather_precip_mm", 1).alias("avg_precip_mm"),
            _avg("weather_wind_speed_ms", 1).alias("avg_wind_ms"),
            F.max("weather_event_type").alias("primary_event"),
        )
        .orderBy(
            F.desc("negative_tweet_count"),
            F.asc_nulls_last("lat"),
            F.asc_nulls_last("lon"),
            F.asc_nulls_last("place_name"),
        )
        .limit(k)
    )


def sentiment_by_event(analytics: DataFrame) -> DataFrame:
    return (
        analytics.where(F.col("weather_event_type").isNotNull())
        .groupBy("weather_event_type")
        .agg(
            _n().alias("tweet_count"),
            _avg("sentiment_score", 3).alias("avg_sentiment"),
            _avg("weather_temp_c", 1).alias("avg_temp_c"),
            _avg("weather_precip_mm", 1).alias("avg_precip_mm"),
        )
        .orderBy("avg_sentiment", "weather_event_type")
    )


def _label_count(label: str) -> Column:
    return F.count_if(F.col("sentiment_label") == label)


def daily_trend(analytics: DataFrame) -> DataFrame:
    return (
        analytics.groupBy("processing_date")
        .agg(
            _n().alias("tweet_count"),
            _avg("sentiment_score", 3).alias("avg_sentiment"),
            _label_count("positive").alias("positive_count"),
            _label_count("neutral").alias("neutral_count"),
            _label_count("negative").alias("negative_count"),
        )
        .orderBy("processing_date")
    )


def language_distribution(analytics: DataFrame, k: int = 10) -> DataFrame:
    return (
        analytics.groupBy("detected_lang", "sentiment_method")
        .agg(_n().alias("tweet_count"), _avg("sentiment_score", 3).alias("avg_sentiment"))
        .orderBy(
            F.desc("tweet_count"),
            F.asc_nulls_last("detected_lang"),
            F.asc_nulls_last("sentiment_method"),
        )
        .limit(k)
    )


def geo_quality(processed: DataFrame) -> DataFrame:
    return (
        processed.groupBy("geo_confidence")
        .agg(
            _n().alias("tweet_count"),
            _avg("sentiment_score", 3).alias("avg_sentiment"),
            _avg("weather_station_distance_km", 1).alias("avg_station_distance_km"),
        )
        .orderBy(F.desc("tweet_count"), "geo_confidence")
    )


def match_quality(processed: DataFrame) -> DataFrame:
    return (
        processed.where(F.col("noaa_match_quality").isNotNull())
        .groupBy("noaa_match_quality")
        .agg(_n().alias("tweet_count"), _avg("sentiment_score", 3).alias("avg_sentiment"))
        .orderBy(F.desc("tweet_count"), "noaa_match_quality")
    )


def emoji_buckets(analytics: DataFrame) -> DataFrame:
    n = F.col("emoji_count")
    bucket = F.when(n == 0, "no_emoji").when(n <= 2, "few_emoji").otherwise("many_emoji")
    return (
        analytics.groupBy(bucket.alias("emoji_category"))
        .agg(
            _n().alias("tweet_count"),
            _avg("sentiment_score", 3).alias("avg_sentiment"),
            _avg("emoji_sentiment_score", 3).alias("avg_emoji_sentiment"),
        )
        .orderBy(F.desc("tweet_count"), "emoji_category")
    )


def weather_severity(analytics: DataFrame) -> DataFrame:
    t, p = F.col("weather_temp_c"), F.col("weather_precip_mm")
    heat = (
        F.when(t > 35, "extreme_heat")
        .when(t > 30, "hot")
        .when(t < 0, "freezing")
        .when(t < 10, "cold")
        .otherwise("moderate")
    )
    rain = (
        F.when(p > 25, "heavy_rain")
        .when(p > 10, "rain")
        .when(p > 0, "light_rain")
        .otherwise("no_rain")
    )
    return (
        analytics.where(t.isNotNull())
        .groupBy(heat.alias("temp_category"), rain.alias("precip_category"))
        .agg(_n().alias("tweet_count"), _avg("sentiment_score", 3).alias("avg_sentiment"))
        .orderBy(F.desc("tweet_count"), "temp_category", "precip_category")
    )


def _negative_on_map(analytics: DataFrame) -> DataFrame:
    return _negative(analytics).where(F.col("geo_lat").isNotNull() & F.col("geo_lon").isNotNull())


def heatmap_export(analytics: DataFrame, k: int = 1000) -> DataFrame:
    """The k most negative located posts."""
    return (
        _negative_on_map(analytics)
        .orderBy("sentiment_score", "tweet_id")
        .limit(k)
        .select(
            "geo_lat", "geo_lon", "sentiment_score", "sentiment_label", "weather_event_type",
            "text_clean", "created_at",
        )
    )


def heat_points(analytics: DataFrame, k: int = 1000) -> DataFrame:
    """Map points weighted by how negative they are."""
    return (
        _negative_on_map(analytics)
        .orderBy("sentiment_score", "tweet_id")
        .limit(k)
        .select("geo_lat", "geo_lon", F.abs("sentiment_score").alias("weight"))
    )


def total_counts(processed: DataFrame, analytics: DataFrame) -> DataFrame:
    """Number of processed rows and of rows that made it into the analytics table."""
    quality = analytics.agg(_n()).scalar()
    return processed.agg(_n().alias("total_tweets")).withColumn("quality_tweets", quality)


# ---------------------------------------------------------------- chart data (unrounded means)


def chart_sentiment_by_event(analytics: DataFrame) -> DataFrame:
    return (
        analytics.where(F.col("weather_event_type").isNotNull())
        .groupBy("weather_event_type")
        .agg(_n().alias("tweet_count"), _mean("sentiment_score").alias("avg_sentiment"))
        .orderBy("avg_sentiment", "weather_event_type")
    )


def chart_negative_locations(analytics: DataFrame, digits: int = 2, k: int = 10) -> DataFrame:
    return (
        _negative(analytics)
        .groupBy(
            F.round("geo_lat", digits).alias("lat"),
            F.round("geo_lon", digits).alias("lon"),
            "place_name",
        )
        .agg(
            _n().alias("negative_count"),
            _mean("sentiment_score").alias("avg_sentiment"),
            _mean("weather_temp_c").alias("avg_temp"),
            _mean("weather_precip_mm").alias("avg_precip"),
            _mean("weather_wind_speed_ms").alias("avg_wind"),
            F.max("weather_event_type").alias("primary_event"),
        )
        .orderBy(
            F.desc("negative_count"),
            F.asc_nulls_last("lat"),
            F.asc_nulls_last("lon"),
            F.asc_nulls_last("place_name"),
        )
        .limit(k)
    )


def chart_daily_trend(analytics: DataFrame) -> DataFrame:
    return (
        analytics.groupBy("processing_date")
        .agg(_mean("sentiment_score").alias("avg_sentiment"), _n().alias("tweet_count"))
        .orderBy("processing_date")
    )
