"""Where a post was written: point, place, or location text."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galewire.functions.geo import place_centroid
from galewire.functions.text import is_blank, pytrim
from galewire.operators.joins import lookup_join


def location_key(location: Column) -> Column:
    return F.when(~is_blank(location), F.lower(pytrim(location)))


def _post_id(df: DataFrame) -> str:
    return "tweet_id" if "tweet_id" in df.columns else "id"


def join_place(posts: DataFrame, places: DataFrame) -> DataFrame:
    """Fill ``place`` of raw or parsed posts from their place id; unmatched posts keep what they
    have."""
    place_id = "place_id" if "place_id" in posts.columns else "geo.place_id"
    table = places.groupBy(F.col("id").alias("_place_id")).agg(
        F.min_by(F.struct("id", "full_name", "geo"), "full_name").alias("_place")
    )
    keyed = posts.withColumn("_place_id", F.col(place_id))
    found = lookup_join(keyed, table, ["_place_id"], spread=_post_id(posts))
    return found.withColumn("place", F.coalesce("_place", "place")).select(*posts.columns)


def join_user_location(posts: DataFrame, users: DataFrame) -> DataFrame:
    """Fill ``user_location`` from the users table (id, location); known authors override."""
    table = users.groupBy(F.col("id").alias("author_id")).agg(
        F.max("location").alias("_location"), F.lit(True).alias("_known")
    )
    found = lookup_join(posts, table, ["author_id"], spread=_post_id(posts))
    location = F.when(F.col("_known"), F.col("_location")).otherwise(F.col("user_location"))
    return found.withColumn("user_location", location).select(*posts.columns)


def gazetteer_join(df: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Adds ``gaz_lat`` and ``gaz_lon`` for location texts found in the gazetteer."""
    table = gazetteer.groupBy("location_key").agg(
        F.min(F.struct("lat", "lon")).alias("_gaz")
    )
    found = lookup_join(df, table, ["location_key"], spread="tweet_id")
    return found.withColumns({"gaz_lat": F.col("_gaz.lat"), "gaz_lon": F.col("_gaz.lon")}).drop("_gaz")


def resolve_geo(df: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Coordinates (high), else centre of the place (medium), else gazetteer (low)."""
    point = F.col("coordinates")
    exact = point["lat"].isNotNull() & point["lon"].isNotNull()
    centre = place_centroid(F.col("place.geo"))
    # Only posts without point and place need the gazetteer; the others go in with a null key.
    keyed = df.withColumn("_centre", F.when(~F.coalesce(exact, F.lit(False)), centre)).withColumn(
        "location_key",
        F.when(
            ~F.coalesce(exact, F.lit(False)) & F.col("_centre.lat").isNull(),
            location_key(F.col("user_location")),
        ),
    )
    found = gazetteer_join(keyed, gazetteer)
    tier = (
        F.when(exact, F.lit("high"))
        .when(F.col("_centre.lat").isNotNull(), F.lit("medium"))
        .when(F.col("gaz_lat").isNotNull(), F.lit("low"))
        .otherwise(F.lit("unavailable"))
    )
    source = (
        F.when(tier == "high", "coordinates")
        .when(tier == "medium", "place_centroid")
        .when(tier == "low", "user_location_geocoded")
        .otherwise("unavailable")
    )
    resolved = found.withColumns(
        {
            "geo_lat": F.coalesce(F.when(exact, point["lat"]), "_centre.lat", "gaz_lat"),
            "geo_lon": F.coalesce(F.when(exact, point["lon"]), "_centre.lon", "gaz_lon"),
            "geo_confidence": tier,
            "geo_source": source,
            "place_name": F.when(
                tier == "medium", F.coalesce(F.col("place.full_name"), F.lit("unknown"))
            ),
            "user_location_string": F.when(tier == "low", F.col("user_location")),
            "processing_stage": F.lit("geo_resolved"),
        }
    )
    return resolved.drop("_centre", "location_key", "gaz_lat", "gaz_lon")
