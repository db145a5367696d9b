"""Raw JSON posts to typed rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galewire.functions.text import is_blank
from galewire.functions.times import parse_timestamp

TAGS = "array<string>"
# Where readers leave the text of a record they cannot read.
CORRUPT = "_corrupt_record"
# All fields of a raw post but its text, where a post is carried far: its JSON holds the text once more.
REST = "raw_rest"


def geojson_point(geo: Column) -> Column:
    """``{lat, lon}`` of a GeoJSON point (stored longitude first); null for anything else."""
    point = geo["coordinates"]
    lon, lat = F.get(point["coordinates"], F.lit(0)), F.get(point["coordinates"], F.lit(1))
    return F.when(
        (point["type"] == "Point") & lat.isNotNull() & lon.isNotNull(),
        F.struct(lat.alias("lat"), lon.alias("lon")),
    )


def is_repost(text: Column) -> Column:
    return F.coalesce(text.startswith("RT @"), F.lit(False))


def raw_rest(raw: DataFrame) -> Column:
    """A raw post without its text, whose place stays."""
    return F.struct(*[F.lit(None).cast("string").alias(c) if c == "text" else F.col(c) for c in raw.columns])


def raw_json(posts: DataFrame) -> Column:
    """The JSON of the raw post, of posts that are flat or more: from its ``REST`` and its text, if it is
    not there as it is."""
    if REST not in posts.columns:
        return F.col("raw_json")
    fields = posts.schema[REST].dataType.names
    return F.to_json(F.struct(*[F.col("text") if c == "text" else F.col(f"{REST}.{c}") for c in fields]))


def flatten_posts(raw: DataFrame, rest: bool = False) -> DataFrame:
    """One flat row per raw post, with defaults. Posts without an id are dropped. With ``rest`` the raw
    post goes along as ``REST`` in place of its JSON."""
    return raw.where(F.col("id").isNotNull()).select(
        F.col("id").alias("tweet_id"),
        raw_rest(raw).alias(REST) if rest else F.to_json(F.struct(*raw.columns)).alias("raw_json"),
        "created_at",
        F.coalesce("text", F.lit("")).alias("text"),
        "author_id",
        F.coalesce("lang", F.lit("unknown")).alias("lang"),
        geojson_point(F.col("geo")).alias("coordinates"),
        "place",
        F.col("geo.place_id").alias("place_id"),
        "user_location",
        is_repost(F.col("text")).alias("retweet_status"),
        F.coalesce(F.col("public_metrics.retweet_count"), F.lit(0)).alias("retweet_count"),
        "entities",
    )


def reject_reason(flat: DataFrame) -> DataFrame:
    """Adds ``reject_reason``: null for a valid post, else the first rule it breaks."""
    reason = (
        F.when(F.col("tweet_id").isNull(), "missing_tweet_id")
        .when(F.col("text").isNull(), "missing_text")
        .when(F.col("created_at").isNull(), "missing_created_at")
        .when(is_blank(F.col("text")), "blank_text")
        .when(parse_timestamp(F.col("created_at")).isNull(), "bad_timestamp")
    )
    return flat.withColumn("reject_reason", reason)


def valid_posts(flat: DataFrame) -> DataFrame:
    return reject_reason(flat).where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_posts(flat: DataFrame) -> DataFrame:
    return reject_reason(flat).where(F.col("reject_reason").isNotNull())


def chain_rejects(raw: DataFrame) -> DataFrame:
    """The raw posts that the chain does not take, whole, each with the reason: posts that break a
    rule and, where the reader marks them, records that could not be read."""
    posts = [c for c in raw.columns if c != CORRUPT]
    flat = raw.select(
        F.col("id").alias("tweet_id"), "text", "created_at",
        F.to_json(F.struct(*posts)).alias("raw_json"),
        (F.col(CORRUPT) if CORRUPT in raw.columns else F.lit(None).cast("string")).alias(CORRUPT),
    )
    unread = F.col(CORRUPT).isNotNull()
    reason = F.when(unread, "corrupt_record").otherwise(F.col("reject_reason"))
    return reject_reason(flat).withColumn("reject_reason", reason).where("reject_reason IS NOT NULL").select(
        "tweet_id", "created_at", "reject_reason",
        F.when(unread, F.col(CORRUPT)).otherwise(F.col("raw_json")).alias("raw_json"),
    )


def entity_names(entries: Column, field: str) -> Column:
    names = F.transform(entries, lambda e: F.coalesce(e[field], F.lit("")))
    return F.coalesce(names, F.array().cast(TAGS))


def flatten_entities(df: DataFrame) -> DataFrame:
    """Hashtags, mentions and links as plain string lists with their counts."""
    entities = F.col("entities")
    lists = df.withColumns(
        {
            "hashtags": entity_names(entities["hashtags"], "tag"),
            "mentions": entity_names(entities["mentions"], "username"),
            "urls": entity_names(entities["urls"], "url"),
        }
    )
    return lists.withColumns(
        {
            "hashtag_count": F.size("hashtags"),
            "mention_count": F.size("mentions"),
            "url_count": F.size("urls"),
        }
    )


def parse_posts(flat: DataFrame) -> DataFrame:
    """Typed rows of the valid posts; posts with an unreadable time are dropped."""
    typed = flatten_entities(valid_posts(flat))
    return typed.select(
        "tweet_id",
        F.coalesce("author_id", F.lit("unknown")).alias("author_id"),
        parse_timestamp(F.col("created_at")).alias("created_at"),
        F.col("created_at").alias("created_at_str"),
        "text",
        "lang",
        "coordinates",
        "place",
        "place_id",
        "user_location",
        "retweet_status",
        "retweet_count",
        "hashtags",
        "mentions",
        "urls",
        "hashtag_count",
        "mention_count",
        "url_count",
        REST if REST in flat.columns else "raw_json",
        F.lit("parsed").alias("processing_stage"),
        F.current_timestamp().alias("parse_timestamp"),
    )
