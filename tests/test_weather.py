import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from galewire.operators import weather as W
from galewire.operators.asof import as_of
from galewire.schemas import OBSERVATION, STATION
from galewire.sources import storage

POST = "tweet_id string, created_at timestamp, geo_lat double, geo_lon double, geo_confidence string"
NOON = dt.datetime(2024, 1, 15, 12, 0)


def stations(spark):
    return spark.createDataFrame([("S1", "One", 40.0, -74.0, 5.0, "D"), ("S2", "Two", 60.0, 10.0, 5.0, "D")], STATION)


def observations(spark, rows):
    return spark.createDataFrame([(s, t, d, v, "") for s, t, d, v in rows], OBSERVATION)


BASIC = [("S1", "2024-01-15T00:00:00", "TMAX", 312.0), ("S1", "2024-01-15T11:50:00", "TMIN", 201.0),
         ("S1", "2024-01-15T13:00:00", "PRCP", 0.0), ("S1", "2024-01-15T13:00:00", "AWND", 30.0),
         ("S1", "2024-01-15T14:00:00", "AWND", 61.0), ("S1", "2024-01-15T15:00:00", "SNOW", 7.0),
         ("S1", "2024-01-15T16:00:00", "PRCP", None), ("S1", "2024-01-16T00:10:00", "TMAX", 400.0)]


def enrich(spark, posts, rows=BASIC):
    found = W.enrich_weather(spark.createDataFrame(posts, POST), stations(spark), observations(spark, rows))
    return {r.tweet_id: r for r in found.collect()}


def test_enrich_branches(spark):
    rows = enrich(spark, [
        ("hit", NOON, 40.03, -74.0, "high"), ("far", NOON, 10.0, 10.0, "high"),
        ("nogeo", NOON, None, None, "unavailable"), ("odd", NOON, 40.0, -74.0, "unavailable"),
        ("notime", None, 40.0, -74.0, "high"), ("empty", NOON, 60.0, 10.0, "low"),
    ])
    hit = rows["hit"]
    assert (hit.weather_station_id, hit.weather_station_name) == ("S1", "One")
    assert hit.weather_station_distance_km == 3.34
    assert (hit.weather_temp_max_c, hit.weather_temp_min_c, hit.weather_temp_c) == (31.2, 20.1, 25.7)
    assert (hit.weather_precip_mm, hit.weather_wind_speed_ms) == (0.0, 4.6)
    assert hit.weather_event_type == "heat"
    assert hit.weather_observation_time == "2024-01-15T11:50:00"
    assert (hit.noaa_match_quality, hit.weather_outcome) == ("high", "enriched")
    assert hit.processing_stage == "noaa_enriched"
    for name, outcome in (("far", "no_station"), ("nogeo", "no_geo"), ("odd", "no_geo"), ("notime", "no_geo")):
        row = rows[name]
        assert (row.noaa_match_quality, row.weather_outcome) == ("no_geolocation", outcome)
        assert row.weather_station_id is None and row.weather_event_type is None
    empty = rows["empty"]
    assert (empty.weather_station_id, empty.noaa_match_quality) == ("S2", "no_observations")
    assert empty.weather_temp_c is None and empty.weather_event_type is None
    assert len(rows) == 6


def test_window_covers_both_days_near_midnight(spark):
    late = dt.datetime(2024, 1, 15, 23, 30)
    row = enrich(spark, [("1", late, 40.0, -74.0, "high")])["1"]
    assert row.weather_temp_max_c == 40.0
    assert row.weather_observation_time == "2024-01-16T00:10:00"
    assert row.noaa_match_quality == "medium"


def test_earlier_observation_wins_a_tie(spark):
    rows = [("S1", "2024-01-15T12:10:00", "TMAX", 1.0), ("S1", "2024-01-15T11:50:00", "TMIN", 1.0)]
    row = enrich(spark, [("1", NOON, 40.0, -74.0, "high")], rows)["1"]
    assert row.weather_observation_time == "2024-01-15T11:50:00"


def test_units(spark):
    converted = W.observation_units(observations(spark, BASIC)).collect()
    assert len(converted) == 7
    assert {r.temperature_max_c for r in converted} == {31.2, 40.0, None}
    assert {r.snowfall_mm for r in converted} == {7.0, None}
    assert {r.wind_speed_ms for r in converted} == {3.0, 6.1, None}


@pytest.mark.parametrize(("precip", "wind", "tmax", "want"), [
    (25.1, 99, 50, "heavy_rain"), (25.0, 0, 0, "rain"), (10.0, 0, 0, "light_rain"), (0.0, 20.1, 0, "high_wind"),
    (None, 20.0, 40, "windy"), (0.0, None, 35.1, "extreme_heat"), (0.0, 10.0, 35.0, "heat"),
    (0.0, 0.0, -0.1, "freezing"), (0.0, 0.0, 4.9, "cold"), (0.0, 0.0, 30.0, "normal"), (None, None, None, "normal"),
])
def test_event_classes(spark, precip, wind, tmax, want):
    def lit(v):
        return F.lit(v).cast("double")
    assert spark.range(1).select(W.weather_event(lit(precip), lit(wind), lit(tmax))).first()[0] == want


@pytest.mark.parametrize(("km", "minutes", "want"), [
    (9.9, 29.9, "high"), (10.0, 29.0, "medium"), (9.0, 30.0, "medium"), (29.9, 59.9, "medium"),
    (30.0, 1.0, "low"), (1.0, 60.0, "low"), (1.0, None, "low"),
])
def test_match_quality(spark, km, minutes, want):
    got = W.match_quality(F.lit(km), F.lit(minutes).cast("double"))
    assert spark.range(1).select(got).first()[0] == want


def test_repeated_observations_do_not_multiply_posts(spark):
    posts = [(str(i), NOON, 40.0, -74.0, "high") for i in range(50)]
    assert len(enrich(spark, posts, BASIC * 40)) == 50


def test_observations_of_the_days_around(spark):
    day = dt.date(2024, 1, 15)
    stamps = ["2024-01-12T23:59:59", "2024-01-13T00:00:00", "2024-01-15T23:30:00-05:00", "2024-01-17T23:59:59",
              "2024-01-18T00:00:00"]
    rows = observations(spark, [("S1", s, "TMAX", 1.0) for s in stamps])
    kept = W.observations_between(rows, day, day)
    assert [r.timestamp for r in kept.collect()] == stamps[1:4]


def joined(spark, asked, rows):
    posts = spark.createDataFrame(
        [(str(k), t, "S1") for k, t in enumerate(asked)], "tweet_id string, created_at timestamp, station_id string"
    )
    return W.join_observations(posts, rows)


def test_closest_observation_below_a_second(spark):
    rows = observations(spark, [("S1", "2024-05-01T12:00:00.100000", "TMAX", 1.0),
                                ("S1", "2024-05-01T12:00:01.950000", "TMAX", 1.0)])
    best = joined(spark, [dt.datetime(2024, 5, 1, 12, 0, 0, 900_000)], rows).first().closest
    assert best.diff == 800_000 and best.at % 1_000_000 == 100_000


def test_nearest_time_of_a_crowded_station_is_exact(spark):
    """Many times within few minutes, posts inside, before and after them."""
    start = dt.datetime(2024, 1, 15, 11, 59)
    moments = [start + dt.timedelta(microseconds=(k * 7919 * 131) % 150_000_000) for k in range(3000)]
    rows = observations(spark, [("S1", t.isoformat(timespec="microseconds"), "TMAX", 1.0) for t in moments])
    asked = [start + dt.timedelta(microseconds=k * 1_234_567 - 20_000_000) for k in range(160)]
    asked += [start + dt.timedelta(hours=h) for h in (-9, -2, 3, 11)]
    got = {r.tweet_id: r.diff for r in joined(spark, asked, rows).select("tweet_id", "closest.diff").collect()}
    want = {str(k): min(abs(t - m) for m in moments) // dt.timedelta(microseconds=1) for k, t in enumerate(asked)}
    assert got == want


def test_observation_outside_the_window_is_not_the_closest(spark):
    """The nearest time is on the day before, which the post's window leaves out."""
    rows = observations(spark, [("S1", "2024-01-14T23:59:59", "TMAX", 1.0), ("S1", "2024-01-15T20:00:00", "TMIN", 2.0)])
    row = joined(spark, [dt.datetime(2024, 1, 15, 1, 0, 1), dt.datetime(2024, 1, 15, 0, 59)], rows).orderBy("tweet_id").collect()
    assert [r.closest.diff // 1_000_000 for r in row] == [18 * 3600 + 59 * 60 + 59, 3541]
    assert [r.n_obs for r in row] == [1, 2]


@pytest.mark.parametrize("width", [1, 7, 50, 10_000])
def test_as_of_against_plain_search(spark, width):
    rng = random.Random(width)
    seen = [(rng.choice("ab"), rng.randrange(-300, 300)) for _ in range(120)] + [("c", 5)]
    asked = sorted({(rng.choice("abcd"), rng.randrange(-350, 350)) for _ in range(150)})
    got = as_of(spark.createDataFrame(asked, "k string, at long"), spark.createDataFrame(seen, "k string, at long"), ["k"], "at", width)
    rows = {(r.k, r.at): (r.before, r.after) for r in got.collect()}
    assert rows == {
        (k, t): (max((x for s, x in seen if s == k and x <= t), default=None),
                 min((x for s, x in seen if s == k and x >= t), default=None)) for k, t in asked
    }


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_plan_has_no_arrays_of_times(spark):
    found = joined(spark, [NOON], observations(spark, BASIC))
    text = plan_of(found)
    assert "Window" in text
    for word in ("collect_list", "collect_set", "array_min", "array_append"):
        assert word not in text


def test_store_by_date_opens_needed_days_only(spark, tmp_path):
    """The plan prunes at run time, and a broken file of another day is not noticed."""
    days = [dt.datetime(2024, 1, d, 12) for d in range(1, 20)]
    rows = observations(spark, [(s, t.isoformat(), "TMAX", float(t.day)) for t in days for s in ("S1", "S2")])
    path = f"{tmp_path}/store"
    storage.write_observations(rows, path)
    for k in (1, 5, 6, 8, 19):
        for file in (tmp_path / "store" / f"obs_date=2024-01-{k:02}").glob("*.parquet"):
            file.write_bytes(b"broken")
    posts = spark.createDataFrame([("1", dt.datetime(2024, 1, 7, 9), "S1"), ("2", dt.datetime(2024, 1, 14, 23, 30), "S2"),
                                   ("3", None, "S1"), ("4", NOON, None)],
                                  "tweet_id string, created_at timestamp, station_id string")
    found = W.observations_needed(storage.scan_observations(spark, path), W.needed_days(posts))
    assert sorted((r.station_id, r.value) for r in found.collect()) == [("S1", 7.0), ("S2", 14.0), ("S2", 15.0)]
    assert "dynamicpruning" in plan_of(found)
    best = W.join_observations(posts, storage.scan_observations(spark, path))
    assert {r.tweet_id: r.n_obs for r in best.collect()} == {"1": 1, "2": 2, "3": None, "4": None}


def test_store_of_observations_keeps_other_days(spark, tmp_path):
    path = f"{tmp_path}/store"
    storage.write_observations(observations(spark, BASIC), path)
    storage.write_observations(observations(spark, BASIC[-1:]), path)
    assert storage.scan_observations(spark, path).count() == len(BASIC)
    storage.write_observations(observations(spark, [("S1", "2024-01-16T09:00:00Z", "PRCP", 1.0)]), path)
    left = storage.scan_observations(spark, path)
    assert left.count() == len(BASIC) and left.where("obs_date = '2024-01-16'").first().value == 1.0
