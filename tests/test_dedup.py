import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from galewire.functions.text import text_hash
from galewire.operators import dedup
from galewire.operators.groups import components
from galewire.plans.quality import dedup_report

SCHEMA = "tweet_id string, created_at timestamp, text string, retweet_status boolean"


def at(minute):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


def posts(spark, rows):
    return spark.createDataFrame([(i, at(t), x, x.startswith("RT @")) for i, t, x in rows], SCHEMA)


def pairs(df):
    return sorted((r.tweet_id, r.text) for r in df.collect())


EXAMPLE = [("123", 0, "Original post"), ("123", 1, "Original post"), ("124", 2, "Original post"),
           ("125", 3, "RT @user: again"), ("126", 4, "Unique post"), ("127", 5, "  unique POST ")]


def test_hash_ignores_case_and_space(spark):
    df = spark.createDataFrame([("Test Post",), ("test post",), ("\t Test Post  ",)], "t string")
    assert len({r[0] for r in df.select(text_hash(F.col("t"))).collect()}) == 1


def test_chain_and_outcomes(spark):
    df = posts(spark, EXAMPLE)
    want = [("123", "Original post"), ("126", "Unique post")]
    assert pairs(dedup.dedup_chain(df)) == want
    assert pairs(dedup.dedup_greedy(df)) == want
    outcomes = dedup.dedup_outcomes(df)
    got = {(r.tweet_id, r.dedup_outcome): r.n_rows for r in outcomes.collect()}
    assert got == {("123", "kept"): 1, ("123", "dup_id"): 1, ("124", "dup_text"): 1,
                   ("125", "repost"): 1, ("126", "kept"): 1, ("127", "dup_text"): 1}
    report = dedup_report(outcomes).first()
    assert report.asDict() == {"processed": 6, "unique_emitted": 2, "duplicates_dropped": 3,
                               "retweets_dropped": 1, "drop_rate": 66.7}


def test_chain_is_idempotent(spark):
    once = dedup.dedup_chain(posts(spark, EXAMPLE))
    assert pairs(dedup.dedup_chain(once)) == pairs(once)


def test_greedy_differs_from_chain_when_an_id_has_two_texts(spark):
    df = posts(spark, [("1", 0, "A"), ("2", 1, "A"), ("2", 2, "B")])
    assert pairs(dedup.dedup_chain(df)) == [("1", "A")]
    assert pairs(dedup.dedup_greedy(df)) == [("1", "A"), ("2", "B")]


def walk(rows):
    ids, texts, kept = set(), set(), []
    for tweet_id, _, text in sorted(rows, key=lambda r: r[1]):
        if tweet_id not in ids and text not in texts:
            ids.add(tweet_id)
            texts.add(text)
            kept.append((tweet_id, text))
    return sorted(kept)


@pytest.mark.parametrize("seed", range(3))
def test_greedy_equals_row_by_row_pass(spark, seed):
    rng = random.Random(seed)
    rows = [(str(rng.randrange(12)), t, f"text {rng.randrange(12)}") for t in range(60)]
    assert pairs(dedup.dedup_greedy(posts(spark, rows))) == walk(rows)


@pytest.mark.parametrize("task_pairs", [0, 3, 20])
def test_greedy_by_components_equals_row_by_row_pass(spark, task_pairs):
    """Components of all sizes: some are walked through, larger ones settle step by step."""
    rng = random.Random(9)
    rows = [(f"{k}-{rng.randrange(n)}", t, f"text {k}-{rng.randrange(n)}")
            for t, (k, n) in enumerate((k, n) for _ in range(12) for k, n in enumerate((1, 2, 3, 5, 8)))]
    kept = dedup.greedy_pairs(posts(spark, rows).select("tweet_id", F.col("text").alias("text_hash"), "created_at"), task_pairs)
    assert sorted((r.tweet_id, r.text_hash) for r in kept.collect()) == walk(rows)


def test_greedy_chain_takes_few_jobs(spark):
    """Pairs that each touch the next one: what is left after the first step is one pass."""
    rows = [(str((t + 1) // 2), t, f"text {t // 2}") for t in range(1000)]
    df = posts(spark, rows).select("tweet_id", F.col("text").alias("text_hash"), "created_at").persist()
    df.count()
    spark.sparkContext.setJobGroup("chain", "chain")
    kept = dedup.greedy_pairs(df)
    found = sorted((r.tweet_id, r.text_hash) for r in kept.collect())
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("chain")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found == walk(rows) and len(jobs) <= 40


def test_components_against_plain_search(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(-400, 400), rng.randrange(-400, 400)) for _ in range(330)] + [(k, k + 1) for k in range(1000, 1200)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_greedy_of_nothing(spark):
    assert dedup.dedup_greedy(posts(spark, [("1", 0, "RT @a: b")])).count() == 0


def test_history(spark):
    df = posts(spark, EXAMPLE)
    seen = spark.createDataFrame([("126", None)], "tweet_id string, text_hash string").unionByName(
        df.where("tweet_id = '124'").select(
            F.lit(None).cast("string").alias("tweet_id"), text_hash(F.col("text")).alias("text_hash"))
    )
    kept = dedup.dedup_vs_history(df, seen)
    assert pairs(kept) == [("125", "RT @user: again"), ("127", "  unique POST ")]


def test_hot_text_is_cut_before_the_shuffle(spark):
    """A text held by most rows reaches the shuffle at most once per input partition."""
    df = spark.range(0, 4000, 1, 4).select(
        F.col("id").cast("string").alias("tweet_id"),
        F.timestamp_seconds(F.col("id")).alias("created_at"),
        F.when(F.col("id") % 3 > 0, "same").otherwise(F.col("id").cast("string")).alias("text"),
        F.lit(False).alias("retweet_status"),
    )
    kept = dedup.dedup_by_text(df)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan and "row_number(), 1, Final" in plan
    assert kept.count() == 1334 + 1
    assert kept.where("text = 'same'").first().tweet_id == "1"


def test_greedy_keeps_one_of_equal_rows_and_shuffles_wide_rows_once(spark):
    rows = [("1", 0, "Storm"), ("1", 0, "storm "), ("1", 0, "STORM"), ("1", 0, "STORM"), ("2", 1, "storm"),
            ("2", 2, "rain"), (None, 0, "hail"), ("3", 1, None)]
    df = spark.createDataFrame([(i, at(t), x, False) for i, t, x in rows], SCHEMA)
    got = dedup.dedup_greedy(df)
    assert pairs(got) == [("1", "STORM"), ("2", "rain")]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # The window is below the join, on the same three columns.
    assert plan.index("Join LeftSemi") < plan.index("Window [row_number()")


def test_rows_of_the_chain_are_those_of_the_wide_one(spark):
    """Same ids, times and texts up to case, in many spellings and with other fields that differ."""
    rng = random.Random(7)
    start = dt.datetime(2024, 1, 1)
    rows = [(str(rng.randrange(40)), start + dt.timedelta(hours=rng.randrange(3)),
             rng.choice(["Aa", "aA", " aa", "aa"]) + str(rng.randrange(12)), rng.random() < 0.1, rng.randrange(3))
            for _ in range(1500)]
    posts = spark.createDataFrame(rows, "tweet_id string, created_at timestamp, text string, retweet_status boolean, n int")
    posts = posts.withColumn("_row", F.md5(F.concat_ws("|", "created_at", "text", "retweet_status", "n")))
    narrow = dedup.dedup_chain_rows(posts, "_row", ["n"])
    assert "text" not in narrow.columns
    got = dedup.whole_rows(posts.drop("n"), "_row", narrow.drop("created_at")).select("tweet_id", "created_at", "text").collect()
    want = dedup.dedup_chain(posts).select("tweet_id", "created_at", "text").collect()
    assert sorted(got) == sorted(want) and len(got) > 3


def test_whole_rows_shuffles_texts_once(spark):
    posts = spark.range(10).select(F.col("id").cast("string").alias("tweet_id"), F.lit("x").alias("text"), F.md5(F.col("id").cast("string")).alias("_row"))
    kept = posts.select("tweet_id", "_row")
    plan = dedup.whole_rows(posts, "_row", kept)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.count("Exchange hashpartitioning(tweet_id") <= 2
