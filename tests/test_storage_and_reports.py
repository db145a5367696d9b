import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from galewire.plans import quality, reports
from galewire.schemas import ANALYTICS_COLUMNS, PROCESSED, RAW_POST
from galewire.sources import storage
from galewire.sources.scratch import materialize, shared_dir
from galewire.workload import adapter as A
from galewire.workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def processed(spark):
    return A.processed(spark, FOLDER)


def test_partitioned_write_read_prune(spark, processed, tmp_path):
    path = str(tmp_path / "processed")
    storage.write_processed(processed, path, many_dates=True)
    assert any(f.startswith("processing_date=2024-01-") for f in os.listdir(path))
    back = storage.scan_processed(spark, path)
    assert back.columns == processed.columns and back.count() == processed.count()
    one = back.where("processing_date = '2024-01-02' AND sentiment_score < 0").select("tweet_id")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(processing_date" in plan and "LessThan(sentiment_score,0.0)" in plan
    assert "text_clean" not in plan.split("ReadSchema")[1]
    # Dates that are written again are replaced, others stay; append adds.
    storage.write_processed(processed.where("processing_date = '2024-01-02'"), path)
    assert storage.scan_processed(spark, path).count() == processed.count()
    storage.write_processed(processed, path, mode="append")
    assert storage.scan_processed(spark, path).count() == 2 * processed.count()


def test_repeated_run_of_a_date_leaves_one_copy(spark, tmp_path):
    from galewire.plans.enrich import store
    out, refs = str(tmp_path / "out"), A.references(spark, FOLDER)
    raw = A.faulty_posts(spark, FOLDER).drop("_key")

    def counts():
        return {part: spark.read.json(f"{out}/{part}").groupBy("processing_date").count().collect() for part in ("raw", "rejects")} | {
            "processed": storage.scan_processed(spark, f"{out}/processed").groupBy("processing_date").count().collect()}

    store(raw, refs, out, processing_date="2024-01-30")
    once = counts()
    store(raw, refs, out, processing_date="2024-01-31")
    store(raw, refs, out, processing_date="2024-01-31")
    for part, rows in counts().items():
        assert len(once[part]) == 1 and {r["count"] for r in rows} == {once[part][0]["count"]} and len(rows) == 2


def test_tables_answer_plain_sql(spark, processed, tmp_path):
    path = str(tmp_path / "processed")
    storage.write_processed(processed, path)
    storage.create_processed_table(spark, path)
    storage.create_analytics_table(spark, str(tmp_path / "analytics"))
    n = spark.sql("SELECT COUNT(*) AS n FROM processed_tweets").first().n
    assert n == processed.count()
    assert spark.table("final_analytics").columns == ANALYTICS_COLUMNS
    got = spark.sql("""
        WITH sure AS (SELECT geo_confidence = 'high' AS exact, sentiment_label AS label FROM final_analytics)
        SELECT label, count_if(exact) AS n_exact, count(*) AS n FROM sure GROUP BY label""").collect()
    rows = storage.quality_rows(processed).select("sentiment_label", "geo_confidence").collect()
    assert {r.label: (r.n_exact, r.n) for r in got} == {
        x: (sum(r.geo_confidence == "high" for r in rows if r.sentiment_label == x),
            sum(r.sentiment_label == x for r in rows))
        for x in {r.sentiment_label for r in rows}}
    shown = {r[0] for r in spark.sql("SHOW PARTITIONS processed_tweets").collect()}
    counts = {f"processing_date={r.processing_date}" for r in storage.partition_counts(processed).collect()}
    assert shown == counts
    names = [r[0] for r in spark.sql("DESCRIBE FORMATTED processed_tweets").collect()]
    assert "Location" in names and "tweet_id" in names
    spark.sql("DROP TABLE processed_tweets")
    spark.sql("DROP TABLE final_analytics")


def test_quality_rows(processed):
    rows = storage.quality_rows(processed)
    assert rows.columns == ANALYTICS_COLUMNS and len(ANALYTICS_COLUMNS) == 27
    bad = rows.where("geo_confidence NOT IN ('high', 'medium') OR weather_station_id IS NULL "
                     "OR sentiment_confidence <= 0.5")
    assert rows.count() > 0 and bad.count() == 0


def test_end_to_end_has_the_table_schema(spark, tmp_path):
    from galewire.workload.queries import enriched
    full = storage.to_processed(enriched(spark, FOLDER), "2024-02-01")
    assert full.columns == [c.split()[0] for c in PROCESSED.replace("\n", " ").split(",")]
    path = str(tmp_path / "out")
    storage.write_processed(full, path)
    back = storage.scan_processed(spark, path)
    assert {r.processing_stage for r in back.select("processing_stage").distinct().collect()} == {"sentiment_computed"}
    assert back.where("processing_date = '2024-02-01'").count() == back.count() > 100
    assert quality.geo_tier_report(back).first().processed == back.count()
    assert reports.emoji_buckets(back).count() >= 1


def test_top_k_is_a_take_ordered(processed):
    plan = reports.negative_locations(storage.quality_rows(processed))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_percentages_of_nothing(spark, processed):
    empty = processed.where("false")
    assert quality.sentiment_report(empty).first().positive_pct == 0.0
    assert [r.passed for r in quality.quality_gate(empty).collect()] == [False, False]
    assert quality.label_counts(empty).collect()[0].n == 0


def test_unsorted_averages_do_not_depend_on_partitions(spark, processed):
    one = reports.chart_daily_trend(processed.coalesce(1)).collect()
    many = reports.chart_daily_trend(processed.repartition(7)).collect()
    assert one == many


def test_materialize_uses_the_shared_folder(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "a int, b timestamp")
    kept = materialize(df, "unit")
    assert kept.collect() == df.collect()
    assert kept.inputFiles()[0].removeprefix("file://").startswith(shared_dir(spark))


@pytest.mark.parametrize("name", ["weather_enrich", "dedup_outcomes", "geo_resolve", "q9_weather_severity",
                                  "stats_language_share", "lexicon_sentiment_joined", "dedup_vs_history"])
def test_no_pairwise_joins(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_lookup_join_spreads_null_keys_and_keeps_all_rows(spark):
    from galewire.operators.joins import lookup_join
    facts = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.when(F.col("id") % 3 == 1, F.col("id").cast("string"))).alias("key"))
    table = spark.createDataFrame([("hot", 1), ("4", 2)], "key string, v int")
    got = lookup_join(facts, table, ["key"], spread="id")
    assert got.count() == 1000 and got.where("v = 1").count() == 334 and got.where("v = 2").count() == 1


def test_null_keys_are_part_of_the_shuffle_key(spark):
    from galewire.operators.joins import lookup_join
    facts = spark.range(1000).select("id", F.when(F.col("id") < 0, 1.0).alias("lat"), F.rand(1).alias("lon"))
    table = spark.createDataFrame([(1.0, 2.0, 3)], "lat double, lon double, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(facts, table, ["lat", "lon"], spread="id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2 and all("_slot" in line for line in exchanges)


def test_references_from_folders(spark, tmp_path):
    from galewire.functions.emoji import base_weights
    from galewire.sources.tables import emoji_lexicon, read_references
    for name in ("stations", "observations", "gazetteer", "places"):
        getattr(A, name)(spark, FOLDER).write.parquet(str(tmp_path / name))
    emoji_lexicon(spark).write.parquet(str(tmp_path / "lexicon"))
    refs = read_references(spark, str(tmp_path), dataset_id="GHCND")
    for name in ("stations", "observations", "gazetteer", "places"):
        want = getattr(A, name)(spark, FOLDER)
        assert getattr(refs, name).exceptAll(want).isEmpty() and getattr(refs, name).count() == want.count()
    assert {r.token: r.weight for r in refs.lexicon.collect()} == base_weights()
    assert refs.users is None and refs.profiles is None and refs.dataset_id == "GHCND"
    # Users and profiles where there are any, and a store of observations cut by date.
    A.users(spark, FOLDER).write.parquet(str(tmp_path / "users"))
    A.profiles(spark, FOLDER).write.parquet(str(tmp_path / "profiles"))
    storage.write_observations(A.observations(spark, FOLDER), str(tmp_path / "observations"))
    more = read_references(spark, str(tmp_path))
    assert more.users.count() == A.users(spark, FOLDER).count() and more.profiles.count() > 100
    assert set(more.users.columns) == {"id", "location"} and "obs_date" in more.observations.columns


def test_only_stations_of_the_dataset_count(spark):
    from galewire.operators.weather import enrich_weather
    posts = spark.createDataFrame([("1", dt.datetime(2024, 1, 1), 10.0, 20.0, "high")],
                                  "tweet_id string, created_at timestamp, geo_lat double, geo_lon double, "
                                  "geo_confidence string")
    stations = spark.createDataFrame([("a", "A", 10.0, 20.0, 0.0, "X"), ("b", "B", 10.1, 20.0, 0.0, "Y")],
                                     A.stations(spark, FOLDER).schema)
    found = [enrich_weather(posts, stations, A.observations(spark, FOLDER), dataset_id=d).first().weather_station_id
             for d in (None, "Y", "Z")]
    assert found == ["a", "b", None]


def test_dedup_does_not_shuffle_raw_json(spark):
    from galewire.operators.dedup import dedup_chain
    from galewire.plans.enrich import UNUSED_PARSED, parsed_posts
    plan = dedup_chain(parsed_posts(A.raw_posts(spark, FOLDER)).drop(*UNUSED_PARSED))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Window" in text and "raw_json" not in text


def test_processing_date_is_given_or_the_day_of_the_run(spark, processed):
    from galewire.streaming.run import trigger_options
    day = spark.range(1).select(storage.today().alias("d"), storage.today("2024-01-31").alias("g")).first()
    assert day.g == "2024-01-31" and day.d == dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d")
    assert trigger_options(True, "5 seconds") == {"availableNow": True}
    assert trigger_options(False, "5 seconds") == {"processingTime": "5 seconds"}


def _shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_store_holds_texts_once_on_scratch_and_no_shuffle_files(spark, tmp_path, monkeypatch):
    from galewire.plans.enrich import store
    from galewire.sources import scratch
    monkeypatch.setattr(scratch, "shared_dir", lambda _: f"{tmp_path}/scratch")
    refs, raw = A.references(spark, FOLDER), A.raw_posts(spark, FOLDER)
    before = _shuffle_files(spark)
    store(raw, refs, f"{tmp_path}/out", processing_date="2024-01-31")
    for _ in range(50):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    texts = {"text", "text_clean", "text_original", "raw_json"}
    held = [c for t in os.listdir(tmp_path / "scratch") for c in spark.read.parquet(f"{tmp_path}/scratch/{t}").columns if c in texts]
    assert held == ["text"]
    files = [f for _, _, names in os.walk(tmp_path / "out" / "raw") for f in names if f.startswith("part-")]
    assert files and all(f.endswith(".json.gz") for f in files)


def test_raw_copies_are_those_of_the_posts_kept(spark, tmp_path):
    """Raw posts of one id, time and text: the copy is that of the post in the table, field for field."""
    from galewire.plans.enrich import store
    raw = A.raw_posts(spark, FOLDER)
    other = raw.withColumns({"author_id": F.lit(None).cast("string"), "text": F.upper("text")})
    late = raw.withColumn("author_id", F.concat(F.lit("v"), F.col("id")))
    out = f"{tmp_path}/out"
    stored = store(raw.unionByName(late).unionByName(other), A.references(spark, FOLDER), out, processing_date="2024-01-31")
    copies = spark.read.schema("tweet_id string, created_at timestamp, raw_json string").json(f"{out}/raw")
    copies = copies.withColumn("p", F.from_json("raw_json", RAW_POST))
    pairs = stored.join(copies, "tweet_id", "full").select(
        "text_original", "p.text", "author_id", F.coalesce("p.author_id", F.lit("unknown")), "created_at_str", "p.created_at").collect()
    assert len(pairs) > 50 and all(tuple(r)[::2] == tuple(r)[1::2] for r in pairs)
    given = {r[0] for r in raw.select(F.to_json(F.struct(*raw.columns))).collect()}
    alone = store(raw, A.references(spark, FOLDER), f"{tmp_path}/alone", processing_date="2024-01-31").count()
    kept = {r.raw_json for r in spark.read.json(f"{tmp_path}/alone/raw").collect()}
    assert len(kept) == alone and kept < given
