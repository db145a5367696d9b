import datetime as dt
import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from galewire.functions.text import text_hash
from galewire.operators.dedup import dedup_chain
from galewire.plans.enrich import add_weather, run, text_models
from galewire.schemas import RAW_POST
from galewire.sources.posts import save_posts, stream_posts
from galewire.sources.scratch import forget_shuffles, materialize
from galewire.sources.since import save_numbered, stream_since
from galewire.sources.storage import batch_date
from galewire.streaming import run as R
from galewire.streaming.bounded import first_of_key, stream_dedup_lru
from galewire.streaming.dedup import SALTS, stream_dedup
from galewire.streaming.late import marked_late, start_split
from galewire.streaming.metrics import StageTotals, count_stage
from galewire.workload import adapter as A
from galewire.workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def refs(spark):
    return A.references(spark, FOLDER)


def line(i, text, minute=0):
    at = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)
    return json.dumps({"id": str(i), "text": text, "created_at": at.isoformat() + "Z"})


def arrive(folder, n, *lines):
    """File number n; files are read in the order of their times."""
    path = folder / f"{n}.json"
    path.write_text("\n".join(lines))
    os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))


def drain(writer, checkpoint):
    query = writer.option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def test_stream_equals_batch(spark, refs, tmp_path):
    raw = A.raw_posts(spark, FOLDER).dropDuplicates(["text"])
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    save_posts(raw, source)
    stored = spark.read.schema(RAW_POST).json(source)
    query = R.start(spark, source, refs, out, str(tmp_path / "log"), once=True, delay="60 days",
                    files_per_trigger=3, models=text_models(refs))
    query.awaitTermination()
    columns = ["tweet_id", "text_clean", "detected_lang", "geo_confidence", "weather_station_id",
               "weather_temp_c", "noaa_match_quality", "sentiment_label", "sentiment_score"]
    got = R.read_output(spark, out).select(*columns)
    want = run(stored, refs).select(*columns)
    assert got.count() == want.count() > 100
    assert got.exceptAll(want).count() == 0


def test_replayed_batch_leaves_one_copy(spark, refs, tmp_path):
    posts = A.raw_posts(spark, FOLDER)
    tagged = R.tag_texts(R.clean_posts(dedup_chain(R.parse_posts(R.flatten_posts(posts)))), text_models(refs))
    out = str(tmp_path / "out")
    R.write_batch(tagged, refs, out, 0)
    first = R.read_output(spark, out).count()
    R.write_batch(tagged, refs, out, 0)
    assert R.read_output(spark, out).count() == first
    assert spark.read.json(f"{out}/raw").count() == first


def test_resumes_after_what_it_has_read(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for n, posts in enumerate(([line(1, "a"), line(2, "b")], [line(3, "c")])):
        arrive(source, n, *posts)
        stream = stream_posts(spark, str(source)).select("id")
        drain(stream.writeStream.format("parquet").option("path", out), tmp_path / "log")
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["1", "2", "3"]


def test_stream_dedup_across_batches(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    arrive(source, 0, line(1, "A"), line(1, "A", 1), line(2, " a ", 2), line(3, "RT @x: A"))
    arrive(source, 1, line(1, "later", 3), line(4, "A", 4), line(5, "new", 5))
    parsed = R.parse_posts(R.flatten_posts(stream_posts(spark, str(source), 1)))
    kept = stream_dedup(parsed, "1 day").select("tweet_id", text_hash(F.col("text")).alias("h"))
    drain(kept.writeStream.format("parquet").option("path", out), tmp_path / "log")
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 2 and {r.tweet_id for r in rows} in ({"1", "5"}, {"2", "5"})


def test_state_is_bounded_by_the_watermark(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for n, (i, minute) in enumerate(((1, 0), (2, 600), (3, 1200), (1, 1300))):
        arrive(source, n, line(i, f"text {n}", minute))
    parsed = R.parse_posts(R.flatten_posts(stream_posts(spark, str(source), 1)))
    query = drain(stream_dedup(parsed, "1 hour").select("tweet_id").writeStream.format("parquet")
                  .option("path", out), tmp_path / "log")
    assert sorted(r.tweet_id for r in spark.read.parquet(out).collect()) == ["1", "1", "2", "3"]
    state = query.lastProgress["stateOperators"]
    assert all(s["numRowsTotal"] <= 2 for s in state)


def test_rejects_keep_lines_and_reasons(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    arrive(source, 0, line(1, "fine"), '{"id": "2", "te', line(3, " "), json.dumps({"text": "no id"}))
    arrive(source, 1, json.dumps({"id": "4", "text": "x", "created_at": "soon"}))
    for log in ("log", "again"):  # a second run from the start writes the same batches again
        R.start_rejects(spark, str(source), out, str(tmp_path / log), once=True,
                        files_per_trigger=1).awaitTermination()
    rows = R.read_rejects(spark, out).collect()
    assert sorted((r.tweet_id or "", r.reject_reason) for r in rows) == [
        ("", "corrupt_record"), ("", "missing_tweet_id"), ("3", "blank_text"), ("4", "bad_timestamp")]
    assert {r.raw_json for r in rows if r.reject_reason == "corrupt_record"} == {'{"id": "2", "te'}


def test_replay_on_a_later_day_keeps_the_first_date(spark, tmp_path):
    out = str(tmp_path / "out")
    first = batch_date(spark, out, 3)
    note = spark.createDataFrame([("2024-01-31",)], "day string")
    note.write.mode("overwrite").json(f"{out}/batches/batch_id=3")
    assert batch_date(spark, out, 3) == "2024-01-31" != first


def test_viral_text_meets_in_small_numbers(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    arrive(source, 0, *[line(i, "everybody says this", i) for i in range(2000)])
    parsed = R.parse_posts(R.flatten_posts(stream_posts(spark, str(source), 1)))
    query = drain(stream_dedup(parsed, "1 day").select("tweet_id").writeStream.format("parquet")
                  .option("path", out), tmp_path / "log")
    assert spark.read.parquet(out).count() == 1
    batch = max(query.recentProgress, key=lambda p: p["numInputRows"])
    dropped = [s["customMetrics"]["numDroppedDuplicateRows"] for s in batch["stateOperators"]]
    assert sum(dropped) == 1999 and min(dropped) == 0
    assert sorted(dropped)[1] == SALTS - 1  # what was left for the last step, by text alone


def test_late_rows_are_counted(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for n, (i, minute) in enumerate(((1, 600), (2, 1200), (3, 5))):
        arrive(source, n, line(i, f"text {n}", minute))
    totals = StageTotals()
    spark.streams.addListener(totals)
    try:
        kept = stream_dedup(R.parse_posts(R.flatten_posts(stream_posts(spark, str(source), 1))), "1 hour")
        drain(kept.select("tweet_id").writeStream.format("parquet").option("path", str(tmp_path / "out")),
              tmp_path / "log")
        for _ in range(50):
            if "late" in totals.totals:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(totals)
    assert totals.totals["late"] == {"dropped": 1}


def test_stage_counters(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    arrive(source, 0, line(1, "A"), line(2, "RT @x: b"))
    arrive(source, 1, line(3, "C"))
    totals = StageTotals()
    spark.streams.addListener(totals)
    try:
        flat = R.flatten_posts(stream_posts(spark, str(source), 1))
        counted = count_stage(flat, "flatten", reposts=F.col("retweet_status")).select("tweet_id")
        drain(counted.writeStream.format("parquet").option("path", str(tmp_path / "out")), tmp_path / "log")
        for _ in range(50):
            if totals.totals.get("flatten", {}).get("processed") == 3:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(totals)
    assert totals.totals["flatten"] == {"processed": 3, "reposts": 1}


# ---------------------------------------------------------------- bounded memory, late rows, windows


POST = "tweet_id string, created_at timestamp, text string, retweet_status boolean"


def put(spark, folder, n, rows, schema=POST):
    """File number n of a stream, read after those before it."""
    part = folder / f"tmp{n}"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(part))
    source = folder / "in"
    source.mkdir(exist_ok=True)
    file = next(part.glob("*.parquet"))
    target = source / f"{n}.parquet"
    target.write_bytes(file.read_bytes())
    os.utime(target, (1_700_000_000 + n, 1_700_000_000 + n))
    return str(source)


def plain_last_used(keys, most):
    used, passed = {}, []
    for k in keys:
        passed.append(k not in used)
        used.pop(k, None)
        used[k] = None
        if len(used) > most:
            del used[next(iter(used))]
    return passed


def test_last_used_keys_over_batches_and_a_restart(spark, tmp_path):
    """One shard: the same rows pass as with a plain memory, though the stream stops after each file."""
    rng = random.Random(2)
    start = dt.datetime(2024, 1, 1)
    rows = [(str(k), start + dt.timedelta(seconds=k), f"t{rng.randrange(14)}", False) for k in range(120)]
    want = [r[0] for r, ok in zip(rows, plain_last_used([r[2] for r in rows], 8)) if ok]
    out = str(tmp_path / "out")
    for n in range(3):
        source = put(spark, tmp_path, n, rng.sample(rows[n * 40:(n + 1) * 40], 40))
        stream = spark.readStream.schema(POST).option("maxFilesPerTrigger", 1).parquet(source)
        kept = first_of_key(stream, "text", ["created_at", "tweet_id"], 8, 1)
        drain(kept.writeStream.format("parquet").option("path", out), tmp_path / "log")
    got = [r.tweet_id for r in spark.read.parquet(out).collect()]
    assert sorted(got, key=int) == want and len(want) > 40


def test_memory_by_count_drops_ids_texts_and_reposts(spark, tmp_path):
    at = dt.datetime(2024, 1, 1)
    rows = [("1", at, "a", False), ("1", at + dt.timedelta(1), "b", False), ("2", at, " A ", False), ("3", at, "c", True),
            (None, at, "d", False), (None, at + dt.timedelta(1), "e", False), ("4", at, None, False), ("5", at, "f", False)]
    stream = spark.readStream.schema(POST).parquet(put(spark, tmp_path, 0, rows))
    out = str(tmp_path / "out")
    drain(stream_dedup_lru(stream).writeStream.format("parquet").option("path", out), tmp_path / "log")
    got = sorted(repr(r.text) for r in spark.read.schema(POST).parquet(out).collect())
    assert got in ([repr("a"), repr("d"), repr("f"), "None"], sorted([repr(" A "), repr("d"), repr("f"), "None"]),
                   sorted([repr("a"), repr("d"), repr("f"), "None"]))


def test_each_row_is_in_time_or_late(spark, tmp_path):
    day = lambda d: dt.datetime(2024, 1, d)
    batches = [[("a", day(10)), ("b", day(2)), ("n", None)], [("c", day(9)), ("d", day(7)), ("e", day(8)), ("f", day(20))],
               [("g", day(18)), ("h", day(19)), ("i", None)]]
    out = str(tmp_path / "out")
    for n, rows in enumerate(batches):
        source = put(spark, tmp_path, n, rows, "k string, at timestamp")
        stream = spark.readStream.schema("k string, at timestamp").option("maxFilesPerTrigger", 1).parquet(source)
        start_split(marked_late(stream, "at", "2 days", "k", 4), out, str(tmp_path / "log")).awaitTermination()
    read = lambda x: sorted(r.k for r in spark.read.schema("k string, at timestamp").parquet(f"{out}/{x}").collect())
    # After the first batch the watermark is the 8th, after the second the 18th.
    assert read("late") == ["d", "e", "g"] and read("in_time") == ["a", "b", "c", "f", "h", "i", "n"]


def test_timed_trigger_goes_on_after_a_restart(spark, refs, tmp_path):
    """The chain on a clock: it takes a file that comes while it runs, stops, and goes on from its
    checkpoint with files that came meanwhile."""
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()

    def start():
        return R.start(spark, str(source), refs, out, str(tmp_path / "log"), interval="1 second", models=text_models(refs))

    def written():
        try:
            return R.read_output(spark, out).count()
        except Exception:  # noqa: BLE001  a batch is just being written
            return 0

    def wait(n):
        for _ in range(240):
            if (found := written()) >= n:
                return found
            time.sleep(0.5)
        return -1

    arrive(source, 0, line(1, "first text here"), line(2, "second text here"))
    query = start()
    assert wait(2) == 2
    arrive(source, 1, line(3, "third text here"), line(1, "first text here"))
    assert wait(3) == 3
    query.stop()
    arrive(source, 2, line(4, "fourth text here"), line(5, "second text here"))
    query = start()
    assert wait(4) == 4
    query.stop()
    assert sorted(r.tweet_id for r in R.read_output(spark, out).collect()) == ["1", "2", "3", "4"]


def test_stream_since_id_goes_on_after_a_restart(spark, tmp_path):
    fields = "id string, text string"
    post = lambda *ids: spark.createDataFrame([(str(i), f"t{i}") for i in ids], fields)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def drained():
        stream = stream_since(spark, source, fields, since=9)
        drain(stream.writeStream.format("parquet").option("path", out), tmp_path / "log")
        return sorted(int(r.id) for r in spark.read.schema(fields).parquet(out).collect())

    save_numbered(post(3, 9, 10, 100, 11, 70), source)
    save_numbered(spark.createDataFrame([("x", "no number"), (None, "none")], fields), source)
    assert drained() == [10, 11, 70, 100]
    save_numbered(post(50, 101, 4000000000000), source)
    assert drained() == [10, 11, 70, 100, 101, 4000000000000]
    assert drained() == [10, 11, 70, 100, 101, 4000000000000]


STREAMS = ["stream_daily_trend", "stream_sliding_trend", "stream_sessions", "stream_dedup_lru", "stream_dedup_posts"]


@pytest.mark.parametrize("name", STREAMS)
def test_stream_reads_a_table_of_several_files(spark, tmp_path, name):
    """A table may be a folder of part files, whose names do not say what table they belong to."""
    whole = A.table(spark, FOLDER, "documents")
    whole.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    want = QUERIES[name](spark, FOLDER).collect()
    assert want and sorted(QUERIES[name](spark, str(tmp_path)).collect()) == sorted(want)


def test_files_are_grouped_by_rows():
    assert R.file_groups({}) == []
    assert R.file_groups({"a": 3, "b": 4, "c": 9, "d": 1, "e": 1, "f": 5}, 7) == [["a", "b"], ["c"], ["d", "e", "f"]]


def test_weather_meets_a_batch_part_by_part(spark, refs, tmp_path, monkeypatch):
    """No text is shuffled, whatever the number of parts, and the posts are those of one join."""
    posts = dedup_chain(R.parse_posts(R.flatten_posts(A.raw_posts(spark, FOLDER), rest=True)))
    tagged = R.tag_texts(R.clean_posts(posts), text_models(refs))
    path, out = f"{tmp_path}/a staged", f"{tmp_path}/out"
    tagged.drop("raw_rest").repartition(5).write.parquet(path)
    staged = spark.read.parquet(path)
    monkeypatch.setattr(R.file_groups, "__defaults__", (60,))
    parts = list(R.with_weather(staged, refs, "unit"))
    assert len(parts) > 2
    for part in parts:
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    files = [r._file for r in staged.selectExpr(R.FILE).distinct().collect()]
    some = R.of_files(staged, files[:2]).select("text")._jdf.queryExecution().executedPlan()
    some.executeCollect()
    assert len(files) == 5 and some.collectLeaves().apply(0).metrics().apply("numFiles").value() == 2
    want = R.to_processed(add_weather(staged, refs), "2024-01-31").drop("processing_ts", "processing_date")
    R.write_batch(tagged, refs, out, 0)
    got = R.read_output(spark, out).drop("processing_ts", "processing_date")
    assert got.count() == want.count() > 100 and got.select(*want.columns).exceptAll(want).isEmpty()
    given = {r[0] for r in A.raw_posts(spark, FOLDER).select(F.to_json(F.struct("*"))).collect()}
    kept = {r.raw_json for r in spark.read.json(f"{out}/raw").collect()}
    assert len(kept) == got.count() and kept <= given
    files = [f for _, _, names in os.walk(f"{out}/raw") for f in names if f.startswith("part-")]
    assert files and all(f.endswith(".json.gz") for f in files)


def test_an_empty_batch_leaves_a_table_without_rows(spark, refs, tmp_path):
    posts = dedup_chain(R.parse_posts(R.flatten_posts(A.raw_posts(spark, FOLDER).where("id < '0'"))))
    R.write_batch(R.tag_texts(R.clean_posts(posts), text_models(refs)), refs, f"{tmp_path}/out", 0)
    assert R.read_output(spark, f"{tmp_path}/out").count() == 0


def test_shuffle_files_of_a_batch_go_before_its_end(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    arrive(source, 0, *[line(i, f"text {i}", i) for i in range(50)])
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    seen = []

    def shuffles():
        found = files.getAllFiles()
        names = [found.apply(i).getName() for i in range(found.size())]
        return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}

    def write(batch, _):
        rows = materialize(batch, "unit").count()
        left = shuffles() - before
        forget_shuffles(batch)
        for _ in range(50):
            if not (shuffles() & left):
                break
            time.sleep(0.1)
        # The batch can still be read, if it must be.
        seen.append((rows, len(left), len(shuffles() & left), batch.count()))

    before = shuffles()
    kept = R.cleaned_stream(stream_posts(spark, str(source)))
    assert "raw_json" not in kept.columns and kept.columns.count("text") == 1
    drain(kept.select("tweet_id", "text_clean").writeStream.foreachBatch(write), tmp_path / "log")
    rows, left, after, again = seen[0]
    assert (rows, after, again) == (50, 0, 50) and left >= 3


def test_packed_posts_come_in_as_they_were(spark, tmp_path):
    raw, source, out = A.raw_posts(spark, FOLDER), f"{tmp_path}/in", f"{tmp_path}/out"
    save_posts(raw, source, codec="gzip")
    assert all(f.endswith(".json.gz") for f in os.listdir(source) if f.startswith("part-"))
    drain(stream_posts(spark, source).select(*raw.columns).writeStream.format("parquet").option("path", out), tmp_path / "log")
    assert spark.read.schema(raw.schema).parquet(out).exceptAll(raw).isEmpty()
    assert spark.read.parquet(out).count() == raw.count()
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.allowFAllocate") == "false"
