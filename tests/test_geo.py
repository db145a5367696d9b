import math
import random

from pyspark.sql import functions as F

from galewire.functions.geo import haversine_km
from galewire.operators.geo import join_place, join_user_location, resolve_geo
from galewire.operators.weather import nearest_station
from galewire.schemas import GAZETTEER, PLACE, RAW_POST, STATION

POST = ("tweet_id string, coordinates struct<lat: double, lon: double>, "
        "place struct<id: string, full_name: string, geo: struct<type: string, bbox: array<double>, "
        "coordinates: array<array<array<double>>>>>, user_location string")
HOBART = [147.1, -43.0, 147.5, -42.7]


def place(name="Hobart", bbox=None, ring=None):
    return ("p1", name, ("Feature", bbox, ring))


def resolve(spark, point=None, spot=None, location=None):
    posts = spark.createDataFrame([("1", point, spot, location)], POST)
    gazetteer = spark.createDataFrame([("quito", -0.18, -78.47)], GAZETTEER)
    return resolve_geo(posts, gazetteer).first()


def test_point_is_high(spark):
    row = resolve(spark, (-33.9, 18.4), place(bbox=HOBART), "Quito")
    assert (row.geo_lat, row.geo_lon, row.geo_confidence) == (-33.9, 18.4, "high")
    assert row.geo_source == "coordinates" and row.place_name is None


def test_place_is_medium(spark):
    row = resolve(spark, None, place(bbox=HOBART), "Quito")
    assert HOBART[1] < row.geo_lat < HOBART[3] and HOBART[0] < row.geo_lon < HOBART[2]
    assert (row.geo_confidence, row.geo_source, row.place_name) == ("medium", "place_centroid", "Hobart")
    assert row.user_location_string is None


def test_centroids(spark):
    box = resolve(spark, None, place(bbox=[10.0, 60.0, 14.0, 61.0]))
    ring = resolve(spark, None, place(ring=[[[10.0, 60.0], [14.0, 60.0], [14.0, 61.0], [10.0, 61.0]]]))
    assert (box.geo_lat, box.geo_lon) == (ring.geo_lat, ring.geo_lon) == (60.5, 12.0)
    assert resolve(spark, None, place(bbox=[1.0, 2.0])).geo_confidence == "unavailable"


def test_location_text_is_low(spark):
    row = resolve(spark, None, None, "  Quito ")
    assert (row.geo_lat, row.geo_lon, row.geo_confidence) == (-0.18, -78.47, "low")
    assert row.user_location_string == "  Quito "


def test_unavailable_and_fallbacks(spark):
    assert resolve(spark).geo_confidence == "unavailable"
    assert resolve(spark, location="   ").geo_confidence == "unavailable"
    assert resolve(spark, location="Atlantis").geo_source == "unavailable"
    assert resolve(spark, (None, None), place(bbox=HOBART)).geo_confidence == "medium"
    assert resolve(spark, (None, 1.0), None, "quito").geo_confidence == "low"


def test_place_and_user_joins(spark):
    raw = spark.createDataFrame(
        [("1", "u1", None, ("p1", None), None), ("2", "u2", "Old", ("zz", None), None),
         ("3", "u9", "Kept", (None, None), place("Own"))],
        "id string, author_id string, user_location string, "
        "geo struct<place_id: string, coordinates: struct<type: string, coordinates: array<double>>>, "
        "place struct<id: string, full_name: string, geo: struct<type: string, bbox: array<double>, "
        "coordinates: array<array<array<double>>>>>")
    places = spark.createDataFrame([place(bbox=HOBART)], PLACE)
    users = spark.createDataFrame([("u1", "Oslo"), ("u2", None)], "id string, location string")
    got = {r.id: r for r in join_user_location(join_place(raw, places), users).collect()}
    assert got["1"].place.full_name == "Hobart" and got["2"].place is None
    assert got["3"].place.full_name == "Own"
    assert [got[i].user_location for i in "123"] == ["Oslo", None, "Kept"]


def km(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = (math.sin((q - p) / 2) ** 2
         + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2)
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(h)))


def test_haversine(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (52.52, 13.405, 48.8566, 2.3522)],
                               "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_km(*map(F.col, "abcd"))).collect()]
    assert abs(got[0] - math.pi * 6371) < 1e-6 and abs(got[1] - 877.46) < 0.1


def test_nearest_station_equals_brute_force(spark):
    rng = random.Random(5)
    regions = [(45, 10), (0, 179.8), (-60, -179.9), (88.9, 30), (-89.7, 0), (67, -150)]

    def around(lat, lon):
        span = 40 if abs(lat) > 85 else 1.2
        return (max(-90.0, min(90.0, lat + rng.uniform(-0.8, 0.8))),
                (lon + rng.uniform(-span, span) + 180) % 360 - 180)

    stations = [(f"S{i}", f"N{i % 40}", *around(*regions[i % 6])) for i in range(300)]
    stations += [(f"T{i}", f"A{9 - i}", 45.1, 10.1) for i in range(8)]
    points = [around(*regions[i % 6]) for i in range(240)] + [(45.1, 10.1), (10.0, 50.0)]
    table = spark.createDataFrame([(i, n, la, lo, None, "D") for i, n, la, lo in stations], STATION)
    found = nearest_station(spark.createDataFrame(points + points[:5], "lat double, lon double"), table)
    got = {(r.lat, r.lon): (r.station_id, r.distance_km) for r in found.collect()}
    assert len(got) == len(set(points))
    for p in points:
        near = min(((km(p, (la, lo)), n, i) for i, n, la, lo in stations), default=None)
        if near[0] <= 50:
            station, distance = got[p]
            assert abs(distance - near[0]) < 0.011
            assert station == near[2]
        else:
            assert got[p] == (None, None)
    assert sum(1 for v in got.values() if v[0]) > 100


def test_short_reach_and_dataset(spark):
    table = spark.createDataFrame(
        [("a", "A", 10.0, 10.0, 1.0, "X"), ("b", None, 10.02, 10.0, 1.0, "Y")], STATION)
    points = spark.createDataFrame([(10.03, 10.0)], "lat double, lon double")
    assert nearest_station(points, table).first().station_name == "Unknown"
    assert nearest_station(points, table, max_distance_km=1.0).first().station_id is None
    assert nearest_station(points, table, dataset_id="X").first().station_id == "a"
