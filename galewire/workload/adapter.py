"""Posts, weather and report tables derived from the benchmark tables.

The benchmark data holds no social posts, so each document becomes one post: its whole text,
decorated with the things posts have. Everything is row-wise arithmetic on table columns, so
size and content grow with the tables.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from galewire.operators.clean import once
from galewire.operators.lang import train_profiles
from galewire.operators.sentiment import DEFAULT_LEXICON, Rules
from galewire.functions.text import text_hash
from galewire.operators.parse import flatten_posts, parse_posts
from galewire.operators.weather import weather_event
from galewire.session import POST_SETTINGS, configure
from galewire.sources.tables import References, lexicon_table

EPOCH_2024 = 1704067200
MINUTES_30_DAYS = 43200

# Weights of some frequent words of the benchmark texts, next to the default lexicon.
TEXT_LEXICON = DEFAULT_LEXICON | {
    "and": 0.4, "the": -0.3, "that": 0.7, "of": -0.6, "le": 0.5, "de": -0.4, "que": 0.6,
    "und": -0.5, "der": 0.3, "la": 0.2, "el": -0.7, "not": -0.2,
}


# Frequent words of the benchmark texts as boosters, negations and turns, so that every rule is met.
TEXT_RULES = Rules(
    negations=("not", "no", "without", "by", "pour", "con"),
    boosters={"very": 1, "a": 1, "is": -1, "les": 1, "los": -1, "die": 1, "was": 1},
    turns=("but", "this", "des", "por", "mit"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark, POST_SETTINGS).read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """Text rows dealt anew by key: a benchmark table is one row group, hence one task, however
    many cores there are. Only the adapter does this; the operators take rows as they come."""
    return df.repartition(key)


def _pick(condition: Column, value) -> Column:
    return F.when(condition, value if isinstance(value, Column) else F.lit(value)).otherwise("")


def post_time(k: Column) -> Column:
    return F.timestamp_seconds(F.lit(EPOCH_2024) + (k * 37 % MINUTES_30_DAYS) * 60)


def post_text(k: Column, text: Column) -> Column:
    key = k.cast("string")
    return F.concat(
        _pick(k % 13 == 0, "RT @u: "),
        text,
        _pick(k % 4 == 1, " @user1"),
        _pick(k % 5 == 0, " #ClimateChange"),
        _pick(k % 6 == 0, " #Flood2024"),
        _pick(k % 7 == 0, F.concat(F.lit(" https://ex.org/"), key)),
        _pick(k % 9 == 0, " Don't worry, we'll see it's fine, I can't complain"),
        _pick(k % 11 == 0, " 😢"),
        _pick(k % 17 == 0, " 🌞❤️"),
        _pick(k % 10 == 3, "  \t storm   warning\n "),
        _pick(k % 14 == 1, " flood"),
        # An emoji without weight, symbols that are none, and characters NFKC takes apart.
        _pick(k % 19 == 2, " strong 💪💪 day 🥆🔾 ﬁne ½"),
        _pick(k % 23 == 5, " y’all wouldn't've gone at six o'clock, ma'am, gonna be VERY good!!"),
    )


def post_stamp(ts: Column, lang: Column) -> Column:
    """Four ISO forms, by language: milliseconds, an offset, seconds, and no offset."""
    two_hours = F.expr("INTERVAL 2 HOUR")
    return (
        F.when(lang == "en", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .when(lang == "fr", F.date_format(ts + two_hours, "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
        .when(lang == "de", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
    )


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw post per document."""
    k = F.col("doc_id")
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    docs = docs.transform(once, "text", post_text(k, F.col("text")))
    docs = docs.transform(once, "created_at", post_stamp(post_time(k), F.col("lang")))
    lat = F.lit(25.0) + k % 10 * 2 + (k % 7 - 3) * 0.2
    lon = F.lit(-120.0) + F.expr("(doc_id div 10) % 10") * 5 + (k % 3 - 1) * 0.1
    point = F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))
    tag = "array<struct<tag: string>>"
    tags = F.concat(
        F.when(k % 5 == 0, F.array(F.struct(F.lit("ClimateChange").alias("tag"))))
        .otherwise(F.array().cast(tag)),
        F.when(k % 6 == 0, F.array(F.struct(F.lit("Flood2024").alias("tag"))))
        .otherwise(F.array().cast(tag)),
    )
    mentions = F.when(k % 4 == 1, F.array(F.struct(F.lit("user1").alias("username"))))
    link = F.concat(F.lit("https://ex.org/"), k.cast("string"))
    urls = F.when(k % 7 == 0, F.array(F.struct(link.alias("url"))))
    return docs.select(
        k.cast("string").alias("id"),
        "text",
        "created_at",
        F.concat(F.lit("u"), (k * 3 % 4000).cast("string")).alias("author_id"),
        "lang",
        F.when(
            k % 4 == 2, F.concat(F.lit("  Nation_"), (k % 25).cast("string"), F.lit(" "))
        ).alias("user_location"),
        F.struct(
            F.when(k % 4 == 1, F.concat(F.lit("pl"), (k % 25).cast("string"))).alias("place_id"),
            F.when(k % 4 == 0, point).alias("coordinates"),
        ).alias("geo"),
        F.lit(None).cast(
            "struct<id: string, full_name: string, geo: struct<type: string, bbox: array<double>,"
            " coordinates: array<array<array<double>>>>>"
        ).alias("place"),
        F.struct(tags.alias("hashtags"), mentions.alias("mentions"), urls.alias("urls")).alias(
            "entities"
        ),
        F.struct(
            (k % 50).cast("int").alias("retweet_count"),
            (k % 9).cast("int").alias("reply_count"),
            (k % 80).cast("int").alias("like_count"),
        ).alias("public_metrics"),
    )


def messy_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat posts, some of them invalid: fields are lost depending on labels and source."""
    flat = flatten_posts(raw_posts(spark, sf_dir))
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("tweet_id"), "quality", "toxic"
    )
    sources = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("tweet_id"), "source"
    )
    joined = flat.join(labels, "tweet_id", "left").join(sources, "tweet_id", "left")
    return joined.select(
        F.col("tweet_id").alias("doc_key"),
        F.when(F.col("source") != "src0", F.col("tweet_id")).alias("tweet_id"),
        F.when(F.col("source") == "src1", F.lit(" \t  "))
        .when(F.coalesce("toxic", F.lit(0)) == 0, F.col("text"))
        .alias("text"),
        F.when(F.col("source") == "src2", F.lit("yesterday"))
        .when(F.col("source") != "src3", F.col("created_at"))
        .alias("created_at"),
        F.coalesce("quality", F.lit(1)).alias("quality"),
    )


def faulty_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw posts, some of which lack a field or hold one that cannot be used."""
    k = F.col("id").cast("long") % 29
    return raw_posts(spark, sf_dir).select(
        F.col("id").alias("_key"),
        F.when(k != 1, F.col("id")).alias("id"),
        F.when(k == 4, F.lit(" \t ")).when(k != 2, F.col("text")).alias("text"),
        F.when(k == 5, F.lit("yesterday")).when(k != 3, F.col("created_at")).alias("created_at"),
        "author_id", "lang", "user_location", "geo", "place", "entities", "public_metrics",
    )


def faulty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as JSON lines, some of them cut short."""
    posts = faulty_posts(spark, sf_dir)
    whole = F.to_json(F.struct(*[c for c in posts.columns if c != "_key"]))
    short = F.concat(F.lit('{"id": "'), F.col("_key"), F.lit('", "text": '))
    return posts.select(F.when(F.col("_key").cast("long") % 29 == 6, short).otherwise(whole).alias("value"))


def parsed_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_posts(flatten_posts(raw_posts(spark, sf_dir)))


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with repeated ids, repeated texts and exact copies: documents and conversation
    turns share one id space, and pages of the same number arrive a second time."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        F.col("doc_id").alias("k"), post_time(F.col("doc_id")).alias("created_at"), "text"
    )
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("k"),
        post_time(F.col("conv_id") * 7 + F.col("turn") * 11).alias("created_at"),
        "text",
    )
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("k"))
    again = docs.join(pages, "k", "left_semi")
    rows = docs.unionByName(turns).unionByName(again)
    return rows.select(
        F.col("k").cast("string").alias("tweet_id"),
        "created_at",
        F.concat(_pick(F.col("k") % 13 == 0, "RT @u: "), F.col("text")).alias("text"),
        (F.col("k") % 13 == 0).alias("retweet_status"),
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What earlier runs kept: labelled documents, some known by id and some by text only."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    return docs.select(
        F.when(F.col("quality") == 1, F.col("doc_id").cast("string")).alias("tweet_id"),
        F.when(F.col("quality") == 0, text_hash(F.col("text"))).alias("text_hash"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("ST"), s.cast("string")).alias("id"),
        F.col("s_name").alias("name"),
        (F.lit(25.0) + s % 10 * 2 + F.expr("s_suppkey div 100") * 0.05).alias("latitude"),
        (F.lit(-120.0) + F.expr("(s_suppkey div 10) % 10") * 5).alias("longitude"),
        F.col("s_acctbal").alias("elevation"),
        F.lit("GHCND").alias("dataset_id"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("ST"), (F.col("user_id") % 100).cast("string")).alias("station_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.when(kind == "click", "TMAX")
        .when(kind == "view", "TMIN")
        .when(kind == "purchase", "PRCP")
        .when(kind == "error", "AWND")
        .otherwise("SNOW")
        .alias("datatype"),
        F.when(kind == "click", F.round(F.col("value") * 4 - 100, 2))
        .otherwise(F.col("value"))
        .alias("value"),
        F.col("props").alias("attributes"),
    )


def _nation_lat(shift: float) -> Column:
    return F.lit(25.0) + F.col("n_nationkey") % 10 * 2 + shift


def _nation_lon(shift: float) -> Column:
    return F.lit(-120.0) + F.expr("(n_nationkey div 10) % 10") * 5 + shift


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as places: even keys with a bounding box, odd keys with a ring."""
    lat, lon = _nation_lat(0.1), _nation_lon(0.1)
    low_lon, low_lat, high_lon, high_lat = lon - 0.05, lat - 0.05, lon + 0.05, lat + 0.05
    box = F.array(low_lon, low_lat, high_lon, high_lat)
    corners = [(low_lon, low_lat), (high_lon, low_lat), (high_lon, high_lat), (low_lon, high_lat)]
    ring = F.array(F.array(*[F.array(x, y) for x, y in corners]))
    even = F.col("n_nationkey") % 2 == 0
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("pl"), F.col("n_nationkey").cast("string")).alias("id"),
        F.col("n_name").alias("full_name"),
        F.struct(
            F.lit("Feature").alias("type"),
            F.when(even, box).alias("bbox"),
            F.when(~even, ring).alias("coordinates"),
        ).alias("geo"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string"))
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("id"),
        F.when(F.col("c_mktsegment") != "MACHINERY", nation).alias("location"),
    )


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.lower("n_name").alias("location_key"),
        _nation_lat(0.05).alias("lat"),
        _nation_lon(0.02).alias("lon"),
    )


def lexicon(spark: SparkSession) -> DataFrame:
    return lexicon_table(spark, TEXT_LEXICON)


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_profiles(spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")))


def references(spark: SparkSession, sf_dir: str) -> References:
    return References(
        stations=stations(spark, sf_dir),
        observations=observations(spark, sf_dir),
        gazetteer=gazetteer(spark, sf_dir),
        lexicon=lexicon(spark),
        profiles=profiles(spark, sf_dir),
        places=places(spark, sf_dir),
        users=users(spark, sf_dir),
    )


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The processed table with every column filled from the document it stands for."""
    docs = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    none = F.lit(None).cast("string")

    def thousandths(expr: Column) -> Column:
        return expr / 1000.0

    score = thousandths(k * 17 % 2001 - 1000)
    tier = (
        F.when(k % 4 == 0, "high").when(k % 4 == 1, "medium").when(k % 4 == 2, "low")
        .otherwise("unavailable")
    )
    located = k % 4 != 3
    temp = (k * 7 % 550 - 100) / 10.0
    precip = F.when(k % 17 != 0, F.when(k % 3 == 0, (k * 13 % 400) / 10.0).otherwise(F.lit(0.0)))
    wind = (k * 11 % 250) / 10.0
    quality = (
        F.when(k % 5 == 0, "high").when(k % 5 == 1, "medium").when(k % 5 == 2, "low")
        .when(k % 5 == 3, "no_observations")
    )
    return docs.select(
        k.cast("string").alias("tweet_id"),
        F.col("source").alias("author_id"),
        post_time(k).alias("created_at"),
        post_stamp(post_time(k), F.col("lang")).alias("created_at_str"),
        post_time(k).alias("processing_ts"),
        F.col("text").alias("text_clean"),
        F.col("text").alias("text_original"),
        F.col("lang").alias("detected_lang"),
        thousandths(k * 31 % 1001).alias("lang_confidence"),
        F.when(k % 3 == 0, "twitter_fallback").otherwise("ngram_profile").alias("lang_method"),
        (k % 3).cast("int").alias("hashtag_count"),
        (k % 2).cast("int").alias("mention_count"),
        (k % 4).cast("int").alias("url_count"),
        (k % 5).cast("int").alias("emoji_count"),
        ((k * 3 % 21 - 10) / 10.0).alias("emoji_sentiment_score"),
        F.length("text").alias("text_length"),
        (k % 60).cast("int").alias("word_count"),
        (k % 4 > 0).alias("has_media"),
        ((k % 90) / 10.0).alias("avg_word_length"),
        F.when(located, F.lit(25.0) + k % 10).alias("geo_lat"),
        F.when(located, F.lit(-120.0) + k % 7).alias("geo_lon"),
        tier.alias("geo_confidence"),
        F.when(tier == "high", "coordinates").when(tier == "medium", "place_centroid")
        .when(tier == "low", "user_location_geocoded").otherwise("unavailable").alias("geo_source"),
        F.when(tier == "medium", F.concat(F.lit("PLACE_"), (k % 3).cast("string"))).alias("place_name"),
        F.when(tier == "low", F.col("source")).alias("user_location_string"),
        F.when(k % 9 != 0, F.concat(F.lit("ST"), (k % 100).cast("string"))).alias("weather_station_id"),
        F.when(k % 9 != 0, F.concat(F.lit("Station "), (k % 100).cast("string"))).alias("weather_station_name"),
        F.when(k % 9 != 0, (k * 7 % 500) / 10.0).alias("weather_station_distance_km"),
        temp.alias("weather_temp_c"),
        (temp + 3).alias("weather_temp_max_c"),
        (temp - 3).alias("weather_temp_min_c"),
        precip.alias("weather_precip_mm"),
        wind.alias("weather_wind_speed_ms"),
        F.when(k % 8 != 0, weather_event(precip, wind, temp + 3)).alias("weather_event_type"),
        F.date_format(post_time(k), "yyyy-MM-dd'T'HH:mm:ss").alias("weather_observation_time"),
        quality.alias("noaa_match_quality"),
        score.alias("sentiment_score"),
        F.when(score > 0.3, "positive").when(score < -0.3, "negative").otherwise("neutral")
        .alias("sentiment_label"),
        F.when(F.col("lang") == "en", "lexicon_en").otherwise("lexicon_multi").alias("sentiment_method"),
        thousandths(k * 29 % 1001).alias("sentiment_confidence"),
        none.alias("raw_json_path"),
        F.lit("documents").alias("source"),
        F.lit("sentiment_computed").alias("processing_stage"),
        F.date_format(post_time(k), "yyyy-MM-dd").alias("processing_date"),
    )
