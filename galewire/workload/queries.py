"""One Spark query per operator, over the tables of a benchmark folder."""

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galewire.functions import emoji as E
from galewire.functions import text as X
from galewire.functions.geo import haversine_km, place_centroid
from galewire.functions.times import iso_seconds, parse_timestamp
from galewire.operators import dedup, filters, geo, lang, sentiment, weather
from galewire.operators.clean import clean_posts, once, text_features
from galewire.operators.joins import lookup_join
from galewire.operators.parse import flatten_posts, is_repost, reject_reason
from galewire.plans import quality, reports
from galewire.plans.enrich import GEO_COLUMNS, locate_posts, run, store
from galewire.schemas import RAW_POST
from galewire.sources import posts as post_files
from galewire.sources import since, storage
from galewire.sources.scratch import materialize, scratch_path
from galewire.streaming import run as stream_run
from galewire.streaming import bounded, late
from galewire.streaming.dedup import stream_dedup
from galewire.streaming.trend import author_sessions, daily_trend, sliding_trend
from galewire.workload import adapter as A

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


REJECTS = "tweet_id string, created_at string, reject_reason string, raw_json string"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _joined(c):
    return F.array_join(c, "|")


# ---------------------------------------------------------------- sources and storage


@query
def scan_json(spark, sf):
    path = scratch_path(spark, "json")
    post_files.save_posts(A.raw_posts(spark, sf), path)
    good, _ = post_files.split_corrupt(post_files.read_posts(spark, path))
    return good.select(
        "id", "created_at", "author_id", "lang", "user_location",
        F.md5("text").alias("text_md5"),
        F.col("geo.place_id").alias("place_id"),
        F.get("geo.coordinates.coordinates", F.lit(0)).alias("lon"),
        F.size("entities.hashtags").alias("n_tags"),
        F.col("public_metrics.retweet_count").alias("retweet_count"),
    )


@query
def incremental_since_id(spark, sf):
    seen = A.table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("id"))
    fresh = filters.newer_than(A.raw_posts(spark, sf), filters.next_high_water_mark(seen))
    return fresh.select("id", "author_id", "created_at")


@query
def stream_since_id(spark, sf):
    """The same as a stream that begins after the mark."""
    seen = A.table(spark, sf, "conversations").agg(F.max("conv_id")).first()[0]
    source, out = scratch_path(spark, "numbered"), scratch_path(spark, "since-out")
    fields = "id string, author_id string, created_at string"
    since.save_numbered(A.raw_posts(spark, sf).select("id", "author_id", "created_at"), source)
    fresh = since.stream_since(spark, source, fields, since=seen)
    _finish(fresh.writeStream.format("parquet").option("path", out), spark, "since-log")
    return spark.read.schema(fields).parquet(out)


@query
def scan_json_array(spark, sf):
    """Posts in eight array files, each cut into ranges of 64 kB."""
    path = scratch_path(spark, "arrays")
    posts = A.raw_posts(spark, sf)
    texts = posts.select((F.col("id").cast("long") % 8).alias("file"), F.to_json(F.struct(*posts.columns)).alias("post"))
    arrays = texts.groupBy("file").agg(F.array_join(F.collect_list("post"), ",\n").alias("all"))
    arrays.select(F.concat(F.lit("["), "all", F.lit("]"))).write.text(path)
    good, _ = post_files.split_corrupt(post_files.read_posts(spark, path, json_array=True, chunk_bytes=1 << 16))
    return good.select("id", "created_at", "lang", F.md5("text").alias("text_md5"))


@query
def high_water_mark(spark, sf):
    return filters.next_high_water_mark(A.raw_posts(spark, sf))


def _stored(spark, sf) -> tuple[str, DataFrame]:
    path = scratch_path(spark, "processed")
    storage.write_processed(A.processed(spark, sf), path, many_dates=True)
    return path, storage.scan_processed(spark, path)


@query
def scan_partitioned_parquet(spark, sf):
    _, stored = _stored(spark, sf)
    return stored.select("tweet_id", "processing_date", "sentiment_score", "text_length")


@query
def sql_table_scan(spark, sf):
    path, _ = _stored(spark, sf)
    storage.create_processed_table(spark, path, "processed_posts_scan")
    return spark.sql(
        "SELECT processing_date, geo_confidence, COUNT(*) AS n, "
        "SUM(text_length) AS sum_text_length "
        "FROM processed_posts_scan GROUP BY processing_date, geo_confidence"
    )


@query
def partition_counts(spark, sf):
    return storage.partition_counts(A.processed(spark, sf))


@query
def verify_output(spark, sf):
    _, stored = _stored(spark, sf)
    return quality.label_counts(stored)


@query
def final_analytics(spark, sf):
    return storage.quality_rows(A.processed(spark, sf))


@query
def raw_json_roundtrip(spark, sf):
    raw = flatten_posts(A.raw_posts(spark, sf)).select(
        F.from_json("raw_json", RAW_POST).alias("p")
    )
    return raw.select(
        "p.id", "p.created_at", "p.author_id", F.md5("p.text").alias("text_md5"),
        F.col("p.geo.place_id").alias("place_id"),
        F.size("p.entities.hashtags").alias("n_tags"),
    )


@query
def raw_json_audit(spark, sf):
    """Audit copies written per date and read back."""
    path = scratch_path(spark, "raw")
    parsed = A.parsed_posts(spark, sf)
    day = F.date_format("created_at", "yyyy-MM-dd").alias("processing_date")
    storage.write_raw_json(parsed.select("tweet_id", "created_at", "text", day), path)
    back = spark.read.schema(
        "tweet_id string, created_at timestamp, text string, processing_date string"
    ).json(path)
    return back.select("tweet_id", "created_at", "processing_date", F.md5("text").alias("text_md5"))


@query
def rejects_of_chain(spark, sf):
    """What the chain's third output holds after a run over faulty posts."""
    out = scratch_path(spark, "chain-out")
    store(A.faulty_posts(spark, sf).drop("_key"), A.references(spark, sf), out, processing_date="2024-01-31")
    rejects = spark.read.schema(REJECTS).json(f"{out}/rejects")
    return rejects.groupBy("tweet_id", "reject_reason").agg(F.count(F.lit(1)).alias("n"))


@query
def raw_audit_of_chain(spark, sf):
    """The raw JSON copies a run of the chain leaves."""
    out = scratch_path(spark, "chain-out")
    store(A.raw_posts(spark, sf), A.references(spark, sf), out, processing_date="2024-01-31")
    copies = spark.read.schema("tweet_id string, raw_json string, processing_date string").json(f"{out}/raw")
    return copies.select("tweet_id", "processing_date", F.md5(F.get_json_object("raw_json", "$.text")).alias("text_md5"))


# ---------------------------------------------------------------- parsing and filters


@query
def flatten_post(spark, sf):
    return flatten_posts(A.raw_posts(spark, sf)).select(
        "tweet_id", "created_at", "author_id", "lang", "user_location", "retweet_status",
        "retweet_count", F.md5("text").alias("text_md5"),
        F.col("coordinates.lat").alias("lat"), F.col("coordinates.lon").alias("lon"),
    )


@query
def parse_post(spark, sf):
    return A.parsed_posts(spark, sf).select(
        "tweet_id", "author_id", "created_at", "created_at_str", "lang", "retweet_status",
        "retweet_count", "hashtag_count", "mention_count", "url_count", "processing_stage",
    )


@query
def entity_flatten(spark, sf):
    return A.parsed_posts(spark, sf).select(
        "tweet_id", _joined("hashtags").alias("hashtags"), _joined("mentions").alias("mentions"),
        _joined("urls").alias("urls"), "hashtag_count", "mention_count", "url_count",
    )


@query
def parse_timestamps(spark, sf):
    messy = A.messy_posts(spark, sf)
    return messy.select("doc_key", parse_timestamp(F.col("created_at")).alias("parsed_at"))


@query
def repost_flag(spark, sf):
    return A.raw_posts(spark, sf).select("id", is_repost(F.col("text")).alias("retweet_status"))


@query
def required_fields(spark, sf):
    return reject_reason(A.messy_posts(spark, sf)).select("doc_key", "reject_reason")


@query
def report_parse(spark, sf):
    return quality.parse_report(A.messy_posts(spark, sf))


@query
def topic_filter(spark, sf):
    return filters.topic_filter(A.raw_posts(spark, sf)).select("id", "lang", "created_at")


@query
def topic_filter_lang(spark, sf):
    return filters.topic_filter(A.raw_posts(spark, sf), lang="en").select("id", "created_at")


@query
def drop_reposts(spark, sf):
    return filters.drop_reposts(A.arrivals(spark, sf)).select(
        "tweet_id", "created_at", F.md5("text").alias("text_md5")
    )


# ---------------------------------------------------------------- duplicates


def _kept(df: DataFrame) -> DataFrame:
    return df.select("tweet_id", "created_at", X.text_hash(F.col("text")).alias("text_hash"))


@query
def dedup_by_id(spark, sf):
    return _kept(dedup.dedup_by_id(filters.drop_reposts(A.arrivals(spark, sf))))


@query
def dedup_by_text(spark, sf):
    return _kept(dedup.dedup_by_text(A.arrivals(spark, sf)))


@query
def dedup_chain(spark, sf):
    return _kept(dedup.dedup_chain(A.arrivals(spark, sf)))


@query
def dedup_greedy(spark, sf):
    return _kept(dedup.dedup_greedy(A.arrivals(spark, sf)))


@query
def dedup_outcomes(spark, sf):
    return dedup.dedup_outcomes(A.arrivals(spark, sf))


@query
def report_dedup(spark, sf):
    return quality.dedup_report(dedup.dedup_outcomes(A.arrivals(spark, sf)))


@query
def dedup_vs_history(spark, sf):
    docs = A.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("tweet_id"), "text")
    fresh = dedup.dedup_vs_history(docs, A.history(spark, sf))
    return fresh.select("tweet_id", F.md5("text").alias("text_md5"))


# ---------------------------------------------------------------- cleaning


def _normal(spark, sf) -> DataFrame:
    return A.parsed_posts(spark, sf).withColumn("t", X.nfkc(F.col("text")))


@query
def nfkc(spark, sf):
    return _normal(spark, sf).select("tweet_id", F.md5("t").alias("text_md5"), F.length("t").alias("n"))


@query
def emoji_features(spark, sf):
    listed = _normal(spark, sf).withColumn("e", E.emoji_list(F.col("t")))
    return listed.select(
        "tweet_id", F.array_join("e", "").alias("emojis"), F.size("e").alias("emoji_count")
    )


@query
def emoji_score(spark, sf):
    scored = E.emoji_score(E.emoji_list(F.col("t")))
    return _normal(spark, sf).select("tweet_id", scored.alias("emoji_sentiment_score"))


@query
def emoji_tokens(spark, sf):
    listed = _normal(spark, sf).withColumn("e", E.emoji_list(F.col("t")))
    spelled = listed.withColumn("x", E.emoji_tokens(F.col("t"), F.col("e")))
    return spelled.select("tweet_id", F.md5("x").alias("text_md5"), F.length("x").alias("n"))


@query
def hashtag_decompose(spark, sf):
    words = F.transform("hashtags", X.split_camel)
    spelled = X.expand_hashtags(F.col("t"), F.col("hashtags"))
    return _normal(spark, sf).select(
        "tweet_id", _joined(words).alias("words"), F.md5(spelled).alias("text_md5")
    )


@query
def strip_urls(spark, sf):
    return A.parsed_posts(spark, sf).select(
        "tweet_id", F.md5(X.strip_urls(F.col("text"))).alias("text_md5")
    )


@query
def expand_contractions(spark, sf):
    return A.parsed_posts(spark, sf).select(
        "tweet_id", F.md5(X.expand_contractions(F.col("text"))).alias("text_md5")
    )


@query
def normalize_ws(spark, sf):
    return A.parsed_posts(spark, sf).select(
        "tweet_id", F.md5(X.normalize_ws(F.col("text"))).alias("text_md5")
    )


@query
def strip_ws(spark, sf):
    return A.parsed_posts(spark, sf).select(
        "tweet_id", X.text_hash(F.col("text")).alias("text_hash")
    )


@query
def text_features_of_posts(spark, sf):
    tidy = A.parsed_posts(spark, sf).withColumn("t", X.normalize_ws(F.col("text")))
    return tidy.withColumns(text_features(F.col("t"), F.col("url_count"))).select(
        "tweet_id", "text_length", "word_count", "has_media", "avg_word_length"
    )


def _cleaned(spark, sf) -> DataFrame:
    return clean_posts(A.parsed_posts(spark, sf))


@query
def clean_text(spark, sf):
    return _cleaned(spark, sf).select(
        "tweet_id", "text_clean", "emoji_count", "emoji_sentiment_score", "text_length",
        "word_count", "has_media", "avg_word_length", "hashtag_count", "mention_count",
        "url_count", "processing_stage",
    )


# ---------------------------------------------------------------- position


@query
def join_place(spark, sf):
    filled = geo.join_place(A.raw_posts(spark, sf), A.places(spark, sf))
    return filled.select("id", F.col("place.id").alias("place_id"), F.col("place.full_name").alias("full_name"))


@query
def join_user_location(spark, sf):
    filled = geo.join_user_location(A.raw_posts(spark, sf), A.users(spark, sf))
    return filled.select("id", "author_id", "user_location")


@query
def place_centroids(spark, sf):
    return A.places(spark, sf).select(
        "id", "full_name", place_centroid(F.col("geo")).alias("c")
    ).select("id", "full_name", "c.lat", "c.lon")


@query
def gazetteer_join(spark, sf):
    raw = geo.join_user_location(A.raw_posts(spark, sf), A.users(spark, sf))
    keyed = raw.select(
        F.col("id").alias("tweet_id"), geo.location_key(F.col("user_location")).alias("location_key")
    )
    return geo.gazetteer_join(keyed, A.gazetteer(spark, sf))


def _located(spark, sf) -> DataFrame:
    return locate_posts(A.parsed_posts(spark, sf), A.references(spark, sf))


@query
def geo_resolve(spark, sf):
    return _located(spark, sf).select("tweet_id", *GEO_COLUMNS)


@query
def report_geo_tiers(spark, sf):
    return quality.geo_tier_report(_located(spark, sf))


@query
def haversine(spark, sf):
    nations = A.gazetteer(spark, sf).select("location_key", F.col("lat").alias("n_lat"), F.col("lon").alias("n_lon"))
    suppliers = A.table(spark, sf, "supplier").select(
        F.concat(F.lit("ST"), F.col("s_suppkey").cast("string")).alias("id"),
        F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string")).alias("location_key"),
    )
    placed = A.stations(spark, sf).join(suppliers, "id").join(nations, "location_key")
    distance = haversine_km(F.col("latitude"), F.col("longitude"), F.col("n_lat"), F.col("n_lon"))
    return placed.select("id", "location_key", F.round(distance, 6).alias("distance_km"))


# ---------------------------------------------------------------- weather


def _points(spark, sf) -> DataFrame:
    located = _located(spark, sf).where(F.col("geo_lat").isNotNull())
    return located.select(F.col("geo_lat").alias("lat"), F.col("geo_lon").alias("lon"))


@query
def nearest_station(spark, sf):
    found = weather.nearest_station(_points(spark, sf), A.stations(spark, sf))
    return found.select(
        "lat", "lon", "station_id", "station_name", "distance_km", "station_lat", "station_lon",
        "station_elevation",
    )


def _stationed(spark, sf) -> DataFrame:
    located = _located(spark, sf).select(
        "tweet_id", "created_at", F.col("geo_lat").alias("lat"), F.col("geo_lon").alias("lon")
    )
    found = weather.nearest_station(_points(spark, sf), A.stations(spark, sf))
    return lookup_join(
        located, found.select("lat", "lon", "station_id", "distance_km"), ["lat", "lon"], "tweet_id"
    )


def _windowed(spark, sf) -> DataFrame:
    return weather.join_observations(_stationed(spark, sf), A.observations(spark, sf))


@query
def observation_units(spark, sf):
    converted = weather.observation_units(A.observations(spark, sf))
    return converted.select(
        "station_id", "timestamp", "datatype", "value", "temperature_max_c", "temperature_min_c",
        "precipitation_mm", "wind_speed_ms", "snowfall_mm",
    )


@query
def observation_window_join(spark, sf):
    found = _windowed(spark, sf).where(F.col("n_obs").isNotNull())
    return found.select("tweet_id", "station_id", "n_obs")


@query
def observations_needed(spark, sf):
    """From a store cut by date, what the posts of one week look at."""
    path = scratch_path(spark, "observations")
    storage.write_observations(A.observations(spark, sf), path)
    week = _stationed(spark, sf).where(
        (F.col("created_at") >= "2024-01-08") & (F.col("created_at") < "2024-01-15")
    )
    store = storage.scan_observations(spark, path)
    found = weather.observations_needed(store, weather.needed_days(week))
    return found.select("station_id", "timestamp", "datatype", "value")


@query
def weather_rollup(spark, sf):
    found = _windowed(spark, sf).where(F.col("n_obs").isNotNull())
    metrics = weather.rollup_columns()
    return found.withColumns(metrics).select("tweet_id", *metrics)


@query
def closest_observation(spark, sf):
    found = _windowed(spark, sf)
    return found.where(F.col("n_obs").isNotNull()).select(
        "tweet_id",
        iso_seconds(F.timestamp_micros("closest.at")).alias("weather_observation_time"),
        F.round(F.col("closest.diff") / 60e6, 6).alias("minutes"),
    )


def _weathered(spark, sf) -> DataFrame:
    return weather.enrich_weather(
        _located(spark, sf), A.stations(spark, sf), A.observations(spark, sf)
    )


@query
def weather_event_class(spark, sf):
    return _weathered(spark, sf).select("tweet_id", "weather_event_type")


@query
def match_quality(spark, sf):
    return _weathered(spark, sf).select(
        "tweet_id", "weather_station_distance_km", "noaa_match_quality"
    )


@query
def weather_enrich(spark, sf):
    return _weathered(spark, sf).select("tweet_id", *weather.WEATHER_COLUMNS, "weather_outcome")


@query
def report_weather(spark, sf):
    return quality.weather_report(_weathered(spark, sf))


# ---------------------------------------------------------------- language and sentiment


@query
def lang_profiles(spark, sf):
    return A.profiles(spark, sf)


@query
def lang_profile_score(spark, sf):
    detect = lang.profile_detector(A.profiles(spark, sf))
    found = _cleaned(spark, sf).transform(once, "d", detect(F.col("text_clean")))
    return found.where(F.col("d.lang").isNotNull()).select(
        "tweet_id", F.col("d.lang").alias("det_lang"), F.col("d.confidence").alias("det_conf")
    )


@query
def lang_profile_score_joined(spark, sf):
    """The way taken by profiles too large to travel to the tasks."""
    texts = _cleaned(spark, sf).select("tweet_id", "text_clean")
    found = lang.profile_language(texts, A.profiles(spark, sf), "d")
    return found.where(F.col("d.lang").isNotNull()).select(
        "tweet_id", F.col("d.lang").alias("det_lang"), F.col("d.confidence").alias("det_conf")
    )


def _tagged(spark, sf) -> DataFrame:
    texts = _cleaned(spark, sf).select("tweet_id", "text_clean", "lang")
    return lang.detect_language(texts, lang.profile_detector(A.profiles(spark, sf)))


@query
def lang_cascade(spark, sf):
    return _tagged(spark, sf).select("tweet_id", "detected_lang", "lang_confidence", "lang_method")


@query
def report_lang_method(spark, sf):
    return quality.language_method_report(_tagged(spark, sf))


def _lexicon_scores(spark, sf, make=sentiment.lexicon_scorer) -> DataFrame:
    scorer = make(A.lexicon(spark), rules=A.TEXT_RULES)
    texts = _cleaned(spark, sf).select("tweet_id", "text_clean")
    return scorer(texts, "s", F.lit(True)).select(
        "tweet_id", F.col("s.score").alias("raw_score"),
        F.col("s.confidence").alias("raw_confidence"), F.col("s.method").alias("raw_method"),
    )


@query
def lexicon_sentiment(spark, sf):
    return _lexicon_scores(spark, sf)


@query
def lexicon_sentiment_joined(spark, sf):
    """The way taken by lexicons too large to travel to the tasks."""
    return _lexicon_scores(spark, sf, sentiment.joined_lexicon_scorer)


def _routed(spark, sf) -> DataFrame:
    """Sentiment by the given language, with one lexicon scorer per route."""
    words = A.lexicon(spark)
    posts = _cleaned(spark, sf).select(
        "tweet_id", "text_clean", F.col("lang").alias("detected_lang"), "emoji_sentiment_score"
    )
    return sentiment.score_sentiment(
        posts,
        english=sentiment.lexicon_scorer(words, "lexicon_en"),
        multilingual=sentiment.lexicon_scorer(words, "lexicon_multi"),
    )


@query
def sentiment_route(spark, sf):
    return _routed(spark, sf).select(
        "tweet_id", "sentiment_score", "sentiment_label", "sentiment_method", "sentiment_confidence"
    )


@query
def report_sentiment(spark, sf):
    return quality.sentiment_report(_routed(spark, sf))


@query
def sentiment_finalize(spark, sf):
    rows = A.processed(spark, sf)
    score, label = sentiment.finalize_sentiment(
        F.col("sentiment_score"), F.col("emoji_sentiment_score") * 5
    )
    return rows.select("tweet_id", score.alias("final_score"), label.alias("final_label"))


@query
def label_to_score(spark, sf):
    rows = A.processed(spark, sf)
    score = sentiment.label_to_score(F.col("sentiment_label"), F.col("sentiment_confidence"))
    return rows.select("tweet_id", score.alias("raw_score"))


# ---------------------------------------------------------------- the whole chain


ENRICHED = [
    "tweet_id", "author_id", "created_at", "text_clean", "text_length", "detected_lang",
    "lang_confidence", "lang_method", "geo_lat", "geo_lon", "geo_confidence", "place_name",
    *weather.WEATHER_COLUMNS, "weather_outcome", "sentiment_score", "sentiment_label",
    "sentiment_confidence", "emoji_count", "emoji_sentiment_score", "word_count", "has_media",
]


def enriched(spark, sf) -> DataFrame:
    return run(A.raw_posts(spark, sf), A.references(spark, sf))


@query
def enriched_posts(spark, sf):
    return enriched(spark, sf).select(*ENRICHED)


@query
def enriched_distribution(spark, sf):
    stored = storage.to_processed(enriched(spark, sf), "2024-01-31")
    return reports.sentiment_distribution(stored)


@query
def enriched_reports(spark, sf):
    """The reports over what the chain makes, from one run of it: group, size and mean of each."""
    processed = materialize(storage.to_processed(enriched(spark, sf), "2024-01-31"), "processed")
    analytics = storage.quality_rows(processed)
    made = {
        "locations": (reports.negative_locations(analytics), ["lat", "lon", "place_name"]),
        "events": (reports.sentiment_by_event(analytics), ["weather_event_type"]),
        "days": (reports.daily_trend(analytics), ["processing_date"]),
        "languages": (reports.language_distribution(analytics), ["detected_lang", "sentiment_method"]),
        "tiers": (reports.geo_quality(processed), ["geo_confidence"]),
        "matches": (reports.match_quality(processed), ["noaa_match_quality"]),
        "emoji": (reports.emoji_buckets(analytics), ["emoji_category"]),
        "severity": (reports.weather_severity(analytics), ["temp_category", "precip_category"]),
    }

    def plain(name: str, report: DataFrame, keys: list[str]) -> DataFrame:
        # Positions as whole hundredths: numbers are spelled alike everywhere.
        spelled = [F.round(F.col(c) * 100).cast("long") if c in ("lat", "lon") else F.col(c) for c in keys]
        group = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("-")) for c in spelled])
        size = "negative_tweet_count" if name == "locations" else "tweet_count"
        return report.select(
            F.lit(name).alias("report"), group.alias("of_group"), F.col(size).alias("tweet_count"), "avg_sentiment"
        )

    parts = [plain(name, *made_of) for name, made_of in made.items()]
    return functools.reduce(DataFrame.unionByName, parts)


# ---------------------------------------------------------------- reports


def _analytics(spark, sf) -> DataFrame:
    return storage.quality_rows(A.processed(spark, sf))


@query
def q1_sentiment_distribution(spark, sf):
    return reports.sentiment_distribution(_analytics(spark, sf))


@query
def q2_negative_locations(spark, sf):
    return reports.negative_locations(_analytics(spark, sf))


@query
def q3_sentiment_by_event(spark, sf):
    return reports.sentiment_by_event(_analytics(spark, sf))


@query
def q4_daily_trend(spark, sf):
    return reports.daily_trend(_analytics(spark, sf))


@query
def q5_language_distribution(spark, sf):
    return reports.language_distribution(_analytics(spark, sf))


@query
def q6_geo_quality(spark, sf):
    return reports.geo_quality(A.processed(spark, sf))


@query
def q7_match_quality(spark, sf):
    return reports.match_quality(A.processed(spark, sf))


@query
def q8_emoji_buckets(spark, sf):
    return reports.emoji_buckets(_analytics(spark, sf))


@query
def q9_weather_severity(spark, sf):
    return reports.weather_severity(_analytics(spark, sf))


@query
def q10_heatmap_export(spark, sf):
    return reports.heatmap_export(_analytics(spark, sf))


@query
def heat_points(spark, sf):
    return reports.heat_points(_analytics(spark, sf))


@query
def total_counts(spark, sf):
    rows = A.processed(spark, sf)
    return reports.total_counts(rows, storage.quality_rows(rows))


@query
def chart_sentiment_by_event(spark, sf):
    return reports.chart_sentiment_by_event(_analytics(spark, sf))


@query
def chart_negative_locations(spark, sf):
    return reports.chart_negative_locations(_analytics(spark, sf))


@query
def chart_daily_trend(spark, sf):
    return reports.chart_daily_trend(_analytics(spark, sf))


@query
def stats_language_share(spark, sf):
    return quality.language_share(A.raw_posts(spark, sf))


@query
def stats_geo_availability(spark, sf):
    filled = geo.join_place(A.raw_posts(spark, sf), A.places(spark, sf))
    return quality.geo_availability(filled)


@query
def stats_top_hashtags(spark, sf):
    return quality.top_hashtags(A.raw_posts(spark, sf))


@query
def quality_gate(spark, sf):
    return quality.quality_gate(A.processed(spark, sf))


# ---------------------------------------------------------------- streams


def _documents_stream(spark, sf) -> DataFrame:
    """The table at its own path, be it a folder of part files or, which a stream takes by a pattern
    only, one file."""
    static = A.table(spark, sf, "documents")
    return spark.readStream.schema(static.schema).parquet(f"{sf}/[d]ocuments.parquet")


def _finish(writer, spark, name: str) -> None:
    checkpoint = scratch_path(spark, name)
    done = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    done.awaitTermination()


@query
def stream_daily_trend(spark, sf):
    """Trend kept up to date: each batch replaces the (small) result table."""
    k = F.col("doc_id")
    score = (k * 17 % 2001 - 1000) / 1000.0
    scored = _documents_stream(spark, sf).select(
        A.post_time(k).alias("created_at"),
        score.alias("sentiment_score"),
        F.when(score > 0.3, "positive").when(score < -0.3, "negative").otherwise("neutral")
        .alias("sentiment_label"),
    )
    out = scratch_path(spark, "trend")

    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    _finish(daily_trend(scored).writeStream.outputMode("complete").foreachBatch(replace), spark, "trend-log")
    return spark.read.parquet(out)


def _scored_stream(spark, sf) -> DataFrame:
    """Documents as scored posts of ten authors."""
    k = F.col("doc_id")
    return _documents_stream(spark, sf).select(
        (k % 10).cast("string").alias("author_id"), A.post_time(k).alias("created_at"),
        ((k * 17 % 2001 - 1000) / 1000.0).alias("sentiment_score"),
    ).withColumn("sentiment_label", F.when(F.col("sentiment_score") > 0.3, "positive")
                 .when(F.col("sentiment_score") < -0.3, "negative").otherwise("neutral"))


def _complete(spark, result: DataFrame, name: str) -> DataFrame:
    """A stream's result table, replaced with every batch."""
    out = scratch_path(spark, name)

    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    _finish(result.writeStream.outputMode("complete").foreachBatch(replace), spark, f"{name}-log")
    return spark.read.parquet(out)


@query
def stream_sliding_trend(spark, sf):
    return _complete(spark, sliding_trend(_scored_stream(spark, sf)), "sliding")


@query
def stream_sessions(spark, sf):
    return _complete(spark, author_sessions(_scored_stream(spark, sf), "90 minutes"), "sessions")


@query
def stream_dedup_lru(spark, sf):
    """What a memory of 32 texts lets pass."""
    k = F.col("doc_id")
    posts = _documents_stream(spark, sf).select(
        A.post_time(k).alias("created_at"), (k * k % 97).cast("string").alias("text"), k.alias("n"),
    )
    out = scratch_path(spark, "stream-lru")
    kept = bounded.first_of_key(posts, "text", ["created_at", "n"], 32, 1).select("n", "text")
    _finish(kept.writeStream.format("parquet").option("path", out), spark, "lru-log")
    return spark.read.schema("n bigint, text string").parquet(out)


@query
def late_of_stream(spark, sf):
    """Documents that arrive in four files, one batch each: which come after the watermark."""
    source, out = scratch_path(spark, "late-in"), scratch_path(spark, "late-out")
    k = F.col("doc_id")
    posts = A.table(spark, sf, "documents").select(k, A.post_time(k).alias("created_at"))
    for part in range(4):
        posts.where(k % 4 == part).coalesce(1).write.mode("append").parquet(source)
    arriving = spark.readStream.schema(posts.schema).option("maxFilesPerTrigger", 1).parquet(source)
    late.start_split(
        late.marked_late(arriving, "created_at", "10 days", "doc_id"), out, scratch_path(spark, "late-log")
    ).awaitTermination()
    found = [spark.read.parquet(f"{out}/{x}").select("doc_id", F.lit(x).alias("output")) for x in ("in_time", "late")]
    return found[0].unionByName(found[1])


@query
def stream_dedup_posts(spark, sf):
    """Which texts a stream keeps; of equal texts any one may arrive first."""
    posts = _documents_stream(spark, sf).select(
        F.col("doc_id").cast("string").alias("tweet_id"),
        A.post_time(F.col("doc_id")).alias("created_at"),
        "text",
        is_repost(F.col("text")).alias("retweet_status"),
    )
    out = scratch_path(spark, "stream-dedup")
    kept = stream_dedup(posts, "60 days").select(X.text_hash(F.col("text")).alias("text_hash"))
    _finish(kept.writeStream.format("parquet").option("path", out), spark, "dedup-log")
    return spark.read.schema("text_hash string").parquet(out)


@query
def stream_enriched(spark, sf):
    """The whole chain as a stream over JSON files, then counts from its output table."""
    refs = A.references(spark, sf)
    source, out = scratch_path(spark, "incoming"), scratch_path(spark, "stream-out")
    post_files.save_posts(A.raw_posts(spark, sf), source, codec="gzip")
    stream = stream_run.start(
        spark, source, refs, out, scratch_path(spark, "stream-log"), once=True, delay="60 days"
    )
    stream.awaitTermination()
    written = stream_run.read_output(spark, out)
    return written.groupBy("detected_lang", "sentiment_label").agg(
        F.count(F.lit(1)).alias("n"), F.sum("text_length").alias("sum_text_length")
    )


@query
def stream_table_scan(spark, sf):
    """What the stream wrote, through a table over its folder."""
    refs = A.references(spark, sf)
    source, out = scratch_path(spark, "incoming"), scratch_path(spark, "stream-out")
    post_files.save_posts(A.raw_posts(spark, sf), source, codec="gzip")
    stream_run.start(
        spark, source, refs, out, scratch_path(spark, "stream-log"), once=True, delay="60 days"
    ).awaitTermination()
    storage.create_processed_table(spark, f"{out}/processed", "streamed_posts_scan", by_batch=True)
    return spark.sql(
        "SELECT detected_lang, lang_method, COUNT(*) AS n, SUM(text_length) AS sum_text_length "
        "FROM streamed_posts_scan WHERE processing_date >= '2024-01-01' "
        "GROUP BY detected_lang, lang_method"
    )


@query
def rejects_of_stream(spark, sf):
    """Unreadable lines and invalid posts that the stream keeps, with their reasons."""
    source, out = scratch_path(spark, "incoming"), scratch_path(spark, "stream-out")
    A.faulty_lines(spark, sf).write.text(source)
    stream_run.start_rejects(
        spark, source, out, scratch_path(spark, "stream-log"), once=True
    ).awaitTermination()
    line = F.when(F.col("reject_reason") == "corrupt_record", F.md5("raw_json"))
    return stream_run.read_rejects(spark, out).groupBy(
        "tweet_id", "reject_reason", line.alias("line_md5")
    ).agg(F.count(F.lit(1)).alias("n"))
