"""Nearest weather station, its observations around the post, and the classes made from them."""

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galewire.functions.geo import cells_within, grid_column, grid_row, haversine_km
from galewire.functions.text import stable_round
from galewire.functions.times import iso_seconds, parse_timestamp
from galewire.operators.asof import SLICE, as_of, sliced
from galewire.operators.joins import lookup_join
from galewire.schemas import OBSERVED_ON
from galewire.sources.scratch import materialize

MAX_DISTANCE_KM = 50.0
# Search radius and grid cell of each pass: near stations first, then the full radius.
NEAR_KM = 10.0
NEAR_CELL_DEGREES = 0.125
FAR_CELL_DEGREES = 0.5

# The measures and the raw unit (tenths).
MEASURES = {
    "TMAX": "temperature_max_c",
    "TMIN": "temperature_min_c",
    "PRCP": "precipitation_mm",
    "AWND": "wind_speed_ms",
}
UNIT_DIVISOR = 10.0
DAY = 86_400_000_000  # in microseconds
SLICE_MICROS = DAY // 96  # a quarter of an hour

WEATHER_COLUMNS = [
    "weather_station_id", "weather_station_name", "weather_station_distance_km",
    "weather_temp_c", "weather_temp_max_c", "weather_temp_min_c", "weather_precip_mm",
    "weather_wind_speed_ms", "weather_event_type", "weather_observation_time",
    "noaa_match_quality",
]


# ---------------------------------------------------------------- nearest station


def _nearest_pass(points: DataFrame, stations: DataFrame, radius_km: float, cell: float) -> DataFrame:
    """One search pass: ``_best`` of the points that have none yet."""
    cells = F.when(
        F.col("_best").isNull(), cells_within(F.col("lat"), F.col("lon"), radius_km, cell)
    )
    probes = points.withColumn("_cell", F.explode_outer(cells)).select(
        "lat", "lon", "_best", "_cell.cell_row", "_cell.cell_col"
    )
    table = stations.withColumns(
        {
            "cell_row": grid_row(F.col("latitude"), cell),
            "cell_col": grid_column(F.col("longitude"), cell),
        }
    )
    pairs = lookup_join(probes, table, ["cell_row", "cell_col"], spread="lat")
    distance = haversine_km(F.col("lat"), F.col("lon"), F.col("latitude"), F.col("longitude"))
    hit = F.struct(
        distance.alias("distance"), "name", "id", "latitude", "longitude", "elevation", "dataset_id"
    )
    best = F.coalesce(F.col("_best"), F.when(distance <= radius_km, hit))
    return pairs.select("lat", "lon", best.alias("_best")).groupBy("lat", "lon").agg(
        F.min("_best").alias("_best")
    )


def nearest_station(
    points: DataFrame,
    stations: DataFrame,
    max_distance_km: float = MAX_DISTANCE_KM,
    dataset_id: str | None = None,
) -> DataFrame:
    """The nearest station of each distinct (lat, lon), or null when none is in reach.

    A grid turns the range condition into an equality on cells. The first pass looks only a
    few kilometres far, so points in regions full of stations meet few of them; only the points
    it leaves open search the full radius. Stations sharing one position are folded into the
    one that wins the tie (lowest name, then id). Candidates are reduced per point in the task
    that made them. Ties between positions go to the lowest name, then id.
    """
    table = stations.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    if dataset_id is not None:
        table = table.where(F.col("dataset_id") == dataset_id)
    table = (
        table.withColumn("name", F.coalesce("name", F.lit("Unknown")))
        .groupBy("latitude", "longitude")
        .agg(F.min(F.struct("name", "id", "elevation", "dataset_id")).alias("_s"))
        .select("latitude", "longitude", "_s.*")
    )
    empty = F.lit(None).cast(
        "struct<distance: double, name: string, id: string, latitude: double, longitude: double,"
        " elevation: double, dataset_id: string>"
    )
    best = points.select("lat", "lon").distinct().withColumn("_best", empty)
    if max_distance_km > NEAR_KM:
        best = _nearest_pass(best, table, NEAR_KM, NEAR_CELL_DEGREES)
    best = _nearest_pass(best, table, max_distance_km, FAR_CELL_DEGREES)
    return best.select(
        "lat",
        "lon",
        F.col("_best.id").alias("station_id"),
        F.col("_best.name").alias("station_name"),
        F.round("_best.distance", 2).alias("distance_km"),
        F.col("_best.latitude").alias("station_lat"),
        F.col("_best.longitude").alias("station_lon"),
        F.col("_best.elevation").alias("station_elevation"),
    )


# ---------------------------------------------------------------- observations


def observation_units(observations: DataFrame, divisor: float = UNIT_DIVISOR) -> DataFrame:
    """Raw observations with one converted column per measure; null values are dropped."""
    value = F.col("value")
    converted = {
        column: F.when(F.col("datatype") == code, value / divisor)
        for code, column in MEASURES.items()
    }
    converted["snowfall_mm"] = F.when(F.col("datatype") == "SNOW", value)
    return observations.where(value.isNotNull()).withColumns(converted)


def window_days(created_at: Column) -> tuple[Column, Column]:
    """First and last UTC date touched by the hour before and after a post."""
    hour = F.expr("INTERVAL 1 HOUR")
    return F.to_date(created_at - hour), F.to_date(created_at + hour)


def observations_between(observations: DataFrame, first: date, last: date) -> DataFrame:
    """Observations that can matter to posts written between two UTC dates. The condition is on
    the ISO text, so it reaches the Parquet scan; one more day on each side covers offsets. A store
    cut by date has it on the folders, too."""
    low, high = first - timedelta(days=2), last + timedelta(days=3)
    stamp = F.col("timestamp")
    bounded = observations.where((stamp >= low.isoformat()) & (stamp < high.isoformat()))
    if OBSERVED_ON in observations.columns:
        bounded = bounded.where(F.col(OBSERVED_ON).between(first - timedelta(days=1), last + timedelta(days=1)))
    return bounded


def timed(observations: DataFrame) -> DataFrame:
    """Observations with a value, a station and a readable time, as ``at`` in microseconds."""
    return observations.where(F.col("value").isNotNull() & F.col("station_id").isNotNull()).withColumn(
        "at", F.unix_micros(parse_timestamp(F.col("timestamp")))
    ).where(F.col("at").isNotNull())


def needed_days(posts: DataFrame) -> DataFrame:
    """Each (station_id, day) that a post (station_id, created_at) looks at, once."""
    first, last = window_days(F.col("created_at"))
    return (
        posts.where(F.col("station_id").isNotNull())
        .select("station_id", F.explode(F.array_distinct(F.array(first, last))).alias("day"))
        .where(F.col("day").isNotNull())
        .distinct()
    )


def observations_needed(observations: DataFrame, needed: DataFrame) -> DataFrame:
    """The observations of the needed (station_id, day).

    A store cut by ``obs_date`` is pruned at run time: the days that are needed, few as days are, are
    broadcast, and the scan opens the folders of these days only. Stations are met by a semi-join.
    """
    if OBSERVED_ON in observations.columns:
        days = F.broadcast(needed.groupBy(F.col("day").alias("_day")).agg(F.count("*").alias("_n")).where("_n > 0"))
        of_days = observations.join(days, F.col(OBSERVED_ON) == F.col("_day"), "left_semi")
        on = (F.col("o.station_id") == F.col("n.station_id")) & (F.col(f"o.{OBSERVED_ON}") == F.col("n.day"))
        return of_days.alias("o").join(needed.alias("n"), on, "left_semi")
    day = F.to_date(parse_timestamp(F.col("o.timestamp")))
    on = (F.col("o.station_id") == F.col("n.station_id")) & (day == F.col("n.day"))
    return observations.alias("o").join(needed.alias("n"), on, "left_semi")


def observation_slices(observations: DataFrame) -> DataFrame:
    """One row per station and occupied time slice: sums of the measures, first and last time.

    Maximum, minimum, sum and count all combine; sums are decimal, so order cannot change them.
    """
    exact = F.col("value").cast("decimal(18,6)")

    def of(code: str) -> Column:
        return F.when(F.col("datatype") == code, exact)

    return (
        sliced(timed(observations), "at", SLICE_MICROS)
        .groupBy("station_id", SLICE)
        .agg(
            F.max(of("TMAX")).alias("tmax"),
            F.min(of("TMIN")).alias("tmin"),
            F.sum(of("PRCP")).alias("prcp"),
            F.sum(of("AWND")).alias("wind"),
            F.count(of("AWND")).alias("wind_n"),
            F.count(F.lit(1)).alias("n_obs"),
            F.min("at").alias("first_at"),
            F.max("at").alias("last_at"),
        )
    )


def observation_windows(slices: DataFrame) -> DataFrame:
    """Weather per station and post window, made once instead of once per post.

    A window is one whole UTC day or two consecutive ones, because the source answers by date.
    """
    def summed(rows: DataFrame, *keys: Column | str) -> DataFrame:
        return rows.groupBy(*keys).agg(
            F.max("tmax").alias("tmax"),
            F.min("tmin").alias("tmin"),
            F.sum("prcp").alias("prcp"),
            F.sum("wind").alias("wind"),
            F.sum("wind_n").alias("wind_n"),
            F.sum("n_obs").alias("n_obs"),
        )

    number = F.floor(F.col(SLICE) / (DAY // SLICE_MICROS)).cast("int")
    days = summed(slices, "station_id", F.date_add(F.lit(date(1970, 1, 1)), number).alias("day"))
    day = F.col("day")
    spans = F.array(
        F.struct(day.alias("first_day"), day.alias("last_day")),
        F.struct(day.alias("first_day"), F.date_add(day, 1).alias("last_day")),
        F.struct(F.date_sub(day, 1).alias("first_day"), day.alias("last_day")),
    )
    return summed(
        days.withColumn("_span", F.explode(spans)), "station_id", "_span.first_day", "_span.last_day"
    )


def rollup_columns(divisor: float = UNIT_DIVISOR) -> dict[str, Column]:
    """Window sums to the reported metrics, one decimal each."""

    def metric(c: Column) -> Column:
        return stable_round(c.cast("double") / divisor, 1)

    tmax, tmin = F.col("tmax").cast("double"), F.col("tmin").cast("double")
    return {
        "weather_temp_c": stable_round((tmax / divisor + tmin / divisor) / 2, 1),
        "weather_temp_max_c": metric(F.col("tmax")),
        "weather_temp_min_c": metric(F.col("tmin")),
        "weather_precip_mm": metric(F.col("prcp")),
        "weather_wind_speed_ms": stable_round(
            F.when(F.col("wind_n") > 0, F.col("wind").cast("double") / F.col("wind_n")) / divisor, 1
        ),
    }


def closest(before: Column, after: Column, post: Column, first: Column, last: Column) -> Column:
    """``{diff, at}``: distance and time of the nearest observation, all in microseconds, between two
    moments, the last excluded; the earlier one wins a tie."""
    def candidate(at: Column) -> Column:
        return F.when((at >= first) & (at < last), F.struct(F.abs(at - post).alias("diff"), at.alias("at")))

    return F.least(candidate(before), candidate(after))


def join_observations(df: DataFrame, observations: DataFrame, slot: str | None = None) -> DataFrame:
    """Adds the sums of their window and ``closest`` to posts that have ``station_id`` and ``created_at``.

    Both are looked up once per distinct station and moment; ``slot`` names a place of the
    intermediate tables to be used again.
    """
    station_and_time = F.col("station_id").isNotNull() & F.col("created_at").isNotNull()
    first_day, last_day = window_days(F.col("created_at"))
    asked = materialize(
        df.where(station_and_time).select("station_id", "created_at").distinct()
        .withColumns({"at": F.unix_micros("created_at"), "first_day": first_day, "last_day": last_day}),
        "asked", slot,
    )
    needed = observations_needed(observations, needed_days(asked))
    slices = materialize(observation_slices(needed), "slices", slot)
    moments = as_of(asked, timed(needed), ["station_id"], "at", SLICE_MICROS, slices)
    start = F.unix_micros(F.col("first_day").cast("timestamp"))
    end = F.unix_micros(F.date_add("last_day", 1).cast("timestamp"))
    found = (
        asked.join(observation_windows(slices), ["station_id", "first_day", "last_day"])
        .join(moments, ["station_id", "at"])
        .withColumn("closest", closest(F.col("before"), F.col("after"), F.col("at"), start, end))
        .drop("before", "after", "at", "first_day", "last_day")
    )
    return lookup_join(df, found, ["station_id", "created_at"], spread="tweet_id")


# ---------------------------------------------------------------- classes


def weather_event(precip: Column, wind: Column, tmax: Column) -> Column:
    """Event class from the rounded metrics: rain first, then wind, then temperature."""
    rain, gust = F.coalesce(precip, F.lit(0.0)), F.coalesce(wind, F.lit(0.0))
    return (
        F.when(rain > 25, "heavy_rain")
        .when(rain > 10, "rain")
        .when(rain > 0, "light_rain")
        .when(gust > 20, "high_wind")
        .when(gust > 10, "windy")
        .when(tmax > 35, "extreme_heat")
        .when(tmax > 30, "heat")
        .when(tmax < 0, "freezing")
        .when(tmax < 5, "cold")
        .otherwise("normal")
    )


def match_quality(distance_km: Column, minutes: Column) -> Column:
    return (
        F.when((distance_km < 10) & (minutes < 30), "high")
        .when((distance_km < 30) & (minutes < 60), "medium")
        .otherwise("low")
    )


def enrich_weather(
    df: DataFrame,
    stations: DataFrame,
    observations: DataFrame,
    divisor: float = UNIT_DIVISOR,
    dataset_id: str | None = None,
    slot: str | None = None,
) -> DataFrame:
    """Weather columns for posts with tweet_id, created_at, geo_lat, geo_lon, geo_confidence;
    with ``dataset_id`` from the stations of that dataset only. ``slot`` as in ``join_observations``."""
    usable = (F.col("geo_confidence") != "unavailable") & F.col("created_at").isNotNull()
    located = df.withColumns(
        {"lat": F.when(usable, F.col("geo_lat")), "lon": F.when(usable, F.col("geo_lon"))}
    )
    points = located.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select("lat", "lon")
    nearest = nearest_station(points, stations, dataset_id=dataset_id).select(
        "lat", "lon", "station_id", "station_name", "distance_km"
    )
    placed = materialize(lookup_join(located, nearest, ["lat", "lon"], spread="tweet_id"), "placed", slot)
    found = join_observations(placed, observations, slot)
    station, observed = F.col("station_id").isNotNull(), F.col("n_obs").isNotNull()
    rolled = found.withColumns(rollup_columns(divisor))
    event = weather_event(
        F.col("weather_precip_mm"), F.col("weather_wind_speed_ms"), F.col("weather_temp_max_c")
    )
    quality = match_quality(F.col("distance_km"), F.col("closest.diff") / 60e6)
    return rolled.withColumns(
        {
            "weather_station_id": F.col("station_id"),
            "weather_station_name": F.col("station_name"),
            "weather_station_distance_km": F.col("distance_km"),
            "weather_event_type": F.when(observed, event),
            "weather_observation_time": iso_seconds(F.timestamp_micros("closest.at")),
            "noaa_match_quality": F.when(~station, "no_geolocation")
            .when(~observed, "no_observations")
            .otherwise(quality),
            "weather_outcome": F.when(F.col("lat").isNull() | F.col("lon").isNull(), "no_geo")
            .when(~station, "no_station")
            .when(~observed, "no_observations")
            .otherwise("enriched"),
            "processing_stage": F.lit("noaa_enriched"),
        }
    ).select(
        *[c for c in df.columns if c != "processing_stage"],
        *WEATHER_COLUMNS,
        "weather_outcome",
        "processing_stage",
    )
