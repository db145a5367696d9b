"""Fixed schemas (DDL strings) for every table the engine reads or writes."""

RAW_POST = """
    id string, text string, created_at string, author_id string, lang string, user_location string,
    geo struct<place_id: string, coordinates: struct<type: string, coordinates: array<double>>>,
    place struct<id: string, full_name: string,
                 geo: struct<type: string, bbox: array<double>,
                             coordinates: array<array<array<double>>>>>,
    entities struct<hashtags: array<struct<tag: string>>, mentions: array<struct<username: string>>,
                    urls: array<struct<url: string>>>,
    public_metrics struct<retweet_count: int, reply_count: int, like_count: int>
"""

PLACE = """
    id string, full_name string,
    geo struct<type: string, bbox: array<double>, coordinates: array<array<array<double>>>>
"""

STATION = """
    id string, name string, latitude double, longitude double, elevation double, dataset_id string
"""

OBSERVATION = """
    station_id string, timestamp string, datatype string, value double, attributes string
"""

# The date by which a store of observations is cut.
OBSERVED_ON = "obs_date"

GAZETTEER = "location_key string, lat double, lon double"

LEXICON = "token string, weight double"

USER = "id string, location string"

PROFILE = "lang string, gram string, weight bigint"

# Column names and order of the two report tables.
PROCESSED = """
    tweet_id string, author_id string, created_at timestamp, created_at_str string,
    processing_ts timestamp, text_clean string, text_original string, detected_lang string,
    lang_confidence double, lang_method string, hashtag_count int, mention_count int, url_count int,
    emoji_count int, emoji_sentiment_score double, text_length int, word_count int,
    has_media boolean, avg_word_length double, geo_lat double, geo_lon double,
    geo_confidence string, geo_source string, place_name string, user_location_string string,
    weather_station_id string, weather_station_name string, weather_station_distance_km double,
    weather_temp_c double, weather_temp_max_c double, weather_temp_min_c double,
    weather_precip_mm double, weather_wind_speed_ms double, weather_event_type string,
    weather_observation_time string, noaa_match_quality string, sentiment_score double,
    sentiment_label string, sentiment_method string, sentiment_confidence double,
    raw_json_path string, source string, processing_stage string, processing_date string
"""

ANALYTICS_COLUMNS = [
    "tweet_id", "created_at", "author_id", "detected_lang", "text_clean",
    "sentiment_score", "sentiment_label", "sentiment_method", "sentiment_confidence",
    "geo_lat", "geo_lon", "geo_confidence", "geo_source", "place_name",
    "weather_station_id", "weather_station_name", "weather_station_distance_km",
    "weather_temp_c", "weather_precip_mm", "weather_wind_speed_ms", "weather_event_type",
    "noaa_match_quality", "hashtag_count", "mention_count", "emoji_count",
    "emoji_sentiment_score", "processing_date",
]
