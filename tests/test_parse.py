import json

from pyspark.sql import functions as F

from galewire.functions.times import parse_timestamp
from galewire.operators import filters
from galewire.operators.parse import flatten_posts, parse_posts, reject_reason, rejected_posts
from galewire.schemas import RAW_POST
from galewire.sources.posts import read_posts, save_posts, split_corrupt

# One post with everything, and one for each way a post can be incomplete.
FULL = {
    "id": "70368744177664",
    "text": "Hail the size of walnuts over Graz #Hail #Styria",
    "created_at": "2023-08-02T05:06:07.250Z",
    "author_id": "u-314",
    "lang": "de",
    "geo": {"coordinates": {"type": "Point", "coordinates": [15.44, 47.07]}},
    "entities": {
        "hashtags": [{"tag": "Hail"}, {"tag": "Styria"}],
        "mentions": [{"username": "zamg"}],
        "urls": [{"url": "https://hail.example/1"}, {"url": "https://hail.example/2"}, {"url": "https://hail.example/3"}],
    },
    "public_metrics": {"retweet_count": 6},
}
POSTS = [
    FULL,
    {"id": "2", "text": "RT @neighbour: windows gone", "created_at": "2023-08-02T09:30:00+02:00"},
    {"id": "3", "text": "   ", "created_at": "2023-08-02T09:31:00Z"},
    {"id": "4", "text": "windows gone", "created_at": "this morning"},
    {"text": "who am I", "created_at": "2023-08-02T09:32:00Z"},
    {"id": "6", "created_at": "2023-08-02T09:33:00Z",
     "geo": {"coordinates": {"type": "Polygon", "coordinates": [1.0, 2.0]}}},
]


def raw(spark):
    return spark.read.schema(RAW_POST).json(
        spark.sparkContext.parallelize([json.dumps(p) for p in POSTS])
    )


def test_flatten(spark):
    rows = {r.tweet_id: r for r in flatten_posts(raw(spark)).collect()}
    assert set(rows) == {FULL["id"], "2", "3", "4", "6"}
    full, repost, no_text = rows[FULL["id"]], rows["2"], rows["6"]
    assert (full.coordinates.lat, full.coordinates.lon) == (47.07, 15.44)
    assert full.retweet_count == 6 and full.retweet_status is False and full.lang == "de"
    assert json.loads(full.raw_json)["entities"]["mentions"] == FULL["entities"]["mentions"]
    assert repost.retweet_status is True and repost.lang == "unknown"
    assert repost.retweet_count == 0 and repost.coordinates is None
    assert no_text.text == "" and no_text.coordinates is None


def test_parse(spark):
    rows = {r.tweet_id: r for r in parse_posts(flatten_posts(raw(spark))).collect()}
    assert set(rows) == {FULL["id"], "2"}
    full, repost = rows[FULL["id"]], rows["2"]
    assert full.hashtags == ["Hail", "Styria"] and full.mentions == ["zamg"]
    assert (full.hashtag_count, full.mention_count, full.url_count) == (2, 1, 3)
    assert full.processing_stage == "parsed"
    assert repost.created_at.isoformat() == "2023-08-02T07:30:00"
    assert repost.author_id == "unknown" and repost.hashtags == []


def test_rejects_carry_a_reason(spark):
    bad = rejected_posts(flatten_posts(raw(spark))).select("tweet_id", "reject_reason").collect()
    assert {tuple(r) for r in bad} == {("3", "blank_text"), ("4", "bad_timestamp"), ("6", "blank_text")}


def test_missing_fields(spark):
    flat = spark.createDataFrame(
        [(None, "a", "2024-01-01"), ("1", None, "2024-01-01"), ("1", "a", None), ("1", "a", "2024-01-01")],
        "tweet_id string, text string, created_at string",
    )
    reasons = [r.reject_reason for r in reject_reason(flat).collect()]
    assert reasons == ["missing_tweet_id", "missing_text", "missing_created_at", None]


def test_timestamps(spark):
    texts = ["2021-06-30T23:59:59.125Z", "2021-07-01T01:00:00+02:00", "2021-07-01", "2021-07-01 08:09:10",
             "2021", "noon", "", "2021-00-01T00:00:00Z", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] and r[0].isoformat() for r in df.select(parse_timestamp(F.col("t"))).collect()]
    assert got == ["2021-06-30T23:59:59.125000", "2021-06-30T23:00:00", "2021-07-01T00:00:00",
                   "2021-07-01T08:09:10", None, None, None, None, None]


def test_json_files(spark, tmp_path):
    lines = tmp_path / "lines"
    save_posts(raw(spark), str(lines))
    good, bad = split_corrupt(read_posts(spark, str(lines)))
    assert good.count() == len(POSTS) and bad.count() == 0

    (tmp_path / "array.json").write_text(json.dumps(POSTS))
    assert read_posts(spark, str(tmp_path / "array.json"), json_array=True).count() == len(POSTS)

    (tmp_path / "broken.json").write_text('{"id": "1", "text": "ok"}\n{"id": "2", "te\n')
    good, bad = split_corrupt(read_posts(spark, str(tmp_path / "broken.json")))
    assert [r.id for r in good.collect()] == ["1"]
    assert [r[0] for r in bad.collect()] == ['{"id": "2", "te']


def test_topic_filter(spark):
    texts = ["A Storm is coming", "stormy", "#ClimateChange now", "climate talk", "RT @x: flood", "heatwave!", None]
    df = spark.createDataFrame([(str(i), t, "en" if i else "es") for i, t in enumerate(texts)],
                               "id string, text string, lang string")
    assert [r.id for r in filters.topic_filter(df).collect()] == ["0", "2", "5"]
    assert [r.id for r in filters.topic_filter(df, lang="en").collect()] == ["2", "5"]
    assert [r.id for r in filters.topic_filter(df, words=["talk"], hashtags=["none"]).collect()] == ["3"]


def test_since_id_compares_numbers(spark):
    df = spark.createDataFrame([("9",), ("10",), ("11",)], "id string")
    seen = spark.createDataFrame([("9",), ("10",)], "id string")
    mark = filters.next_high_water_mark(seen)
    assert mark.first()[0] == "10"
    assert [r.id for r in filters.newer_than(df, mark).collect()] == ["11"]
    nothing = filters.next_high_water_mark(seen.where("false"))
    assert filters.newer_than(df, nothing).count() == 3


def test_ids_that_are_no_numbers_do_not_stop_a_read(spark):
    df = spark.createDataFrame([("9",), ("x9",), (None,), ("12",)], "id string")
    mark = filters.next_high_water_mark(df.where("id <> '12'"))
    assert mark.first()[0] == "9"
    assert [r.id for r in filters.newer_than(df, mark).collect()] == ["12"]
    assert {r.id for r in filters.without_number(df).collect()} == {"x9", None}


def test_array_elements_are_read_alone(spark, tmp_path):
    good = json.dumps(POSTS[0])
    files = {"mixed": f"[{good}, 7, {good}, null]", "none": "[]", "one": good, "cut": f"[{good}, {{"}
    found = {}
    for name, body in files.items():
        (tmp_path / f"{name}.json").write_text(body)
        read = read_posts(spark, str(tmp_path / f"{name}.json"), json_array=True)
        posts, bad = split_corrupt(read)
        found[name] = ([r.id for r in posts.collect()], [r[0] for r in bad.collect()])
    first = POSTS[0]["id"]
    assert found["mixed"] == ([first, first], ["7", "null"])
    assert found["none"] == ([], [])
    assert found["one"] == ([first], [])
    assert found["cut"] == ([], [files["cut"]])
