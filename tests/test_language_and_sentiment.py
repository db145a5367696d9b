import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galewire.functions.text import CHUNK_CHARS, chunks
from galewire.operators import lang as L
from galewire.operators import sentiment as S
from galewire.sources.tables import lexicon_table

ENGLISH = "the weather is getting worse and the storm is coming over the hills this evening"
SPANISH = "el tiempo está empeorando y la tormenta viene sobre las colinas esta noche con lluvia"


@pytest.fixture(scope="module")
def detector(spark):
    rows = [(ENGLISH, "en"), ("there is heavy rain in the valley and the river is rising", "en"),
            (SPANISH, "es"), ("hay mucha lluvia en el valle y el río está subiendo", "es")]
    return L.profile_detector(L.train_profiles(spark.createDataFrame(rows, "text string, lang string")))


def texts(spark, *rows):
    return spark.createDataFrame([(str(i), t, g) for i, (t, g) in enumerate(rows)],
                                 "tweet_id string, text_clean string, lang string")


def tags(df):
    return [(r.detected_lang, r.lang_confidence, r.lang_method) for r in df.orderBy("tweet_id").collect()]


def test_profiles_hold_the_most_frequent_pieces(spark):
    rows = [("aaaa b", "x"), ("aaa", "x")]
    got = L.train_profiles(spark.createDataFrame(rows, "text string, lang string"), size=2).collect()
    assert [(r.gram, r.weight) for r in got if r.gram == "aaa"] == [("aaa", -511 - L.FLOOR)]
    assert {r.gram for r in got} == {"aaa", "a b"}


def test_trigrams_count_code_points(spark):
    df = spark.createDataFrame([("Ab😢c",), ("ab",)], "t string")
    assert [r[0] for r in df.select(L.char_trigrams(F.col("t"))).collect()] == [["ab😢", "b😢c"], []]


def test_cascade(spark, detector):
    df = texts(spark, ("the river is rising in this storm", "fr"), ("la lluvia viene sobre el valle", "fr"),
               ("Short", "de"), ("", "en"), (None, None), ("9999999999999999", "pt"))
    got = tags(L.detect_language(df, detector))
    assert got[0][0] == "en" and got[0][1] > 0.5 and got[0][2] == "ngram_profile"
    assert got[1][0] == "es"
    assert got[2:5] == [("de", 0.5, "twitter_short_text"), ("en", 0.5, "twitter_short_text"),
                        ("unknown", 0.5, "twitter_short_text")]
    assert got[5] == ("pt", 0.3, "twitter_fallback")


def test_second_detector_takes_what_the_first_leaves(spark):
    def fixed(lang, confidence):
        return lambda text: F.when(text.isNotNull(), F.struct(
            F.lit(lang).alias("lang"), F.lit(confidence).alias("confidence")))
    df = texts(spark, ("a text that is long enough", "de"))
    unsure, sure = fixed("en", 0.4), fixed("es", 0.2)
    assert tags(L.detect_language(df, unsure, sure)) == [("es", 0.2, "second_detector")]
    assert tags(L.detect_language(df, fixed("en", 0.5), sure)) == [("en", 0.5, "ngram_profile")]
    assert tags(L.detect_language(df, secondary=sure)) == [("es", 0.2, "second_detector")]
    assert tags(L.detect_language(df, unsure)) == [("de", 0.3, "twitter_fallback")]
    assert tags(L.detect_language(df)) == [("de", 0.3, "twitter_fallback")]


def lexicon(spark):
    return lexicon_table(spark, {"good": 1.9, "bad": -2.5, "storm": -0.9})


def posts(spark, *rows):
    return spark.createDataFrame(
        [(str(i), *row) for i, row in enumerate(rows)],
        "tweet_id string, text_clean string, detected_lang string, emoji_sentiment_score double")


def scored(df):
    return [(r.sentiment_score, r.sentiment_label, r.sentiment_method, r.sentiment_confidence)
            for r in df.orderBy("tweet_id").collect()]


def test_lexicon_both_ways(spark):
    rows = [("Good day", "en", 0.0), ("not a good day", "en", 0.0), ("never one two good", "en", 0.0),
            ("not one two three good", "en", 0.0), ("BAD bad, storm", "en", 0.0), ("nothing found", "en", 0.0),
            ("  ", "en", 0.0)]
    df = posts(spark, *rows)
    carried = scored(S.score_sentiment(df, fallback=S.lexicon_scorer(lexicon(spark))))
    joined = scored(S.score_sentiment(df, fallback=S.joined_lexicon_scorer(lexicon(spark))))
    assert carried == joined

    def compound(total):
        return round(total / (total * total + 15) ** 0.5, 4)
    wants = [1.9, -0.74 * 1.9, -0.74 * 1.9, 1.9, -5.9 - 0.733, 0.0]
    for got, total in zip(carried, wants):
        assert got[0] == pytest.approx(compound(total), abs=6e-4)
        assert got[2] == "lexicon"
        assert got[3] == pytest.approx(abs(compound(total)), abs=6e-4)
    assert carried[6] == (0.0, "neutral", "empty_text", 0.0)


@pytest.mark.parametrize(("raw", "emoji", "score", "label"), [
    (0.25, 0.5, 0.35, "positive"), (0.3, 0.0, 0.3, "neutral"), (-0.3, 0.0, -0.3, "neutral"),
    (-0.2, -5.0, -0.4, "negative"), (0.95, 3.0, 1.0, "positive"), (-0.95, -3.0, -1.0, "negative"),
    (0.3004, 0.0, 0.3, "positive"), (0.2, None, 0.2, "neutral"),
])
def test_finalize(spark, raw, emoji, score, label):
    got = S.finalize_sentiment(F.lit(raw), F.lit(emoji).cast("double"))
    assert tuple(spark.range(1).select(*got).first()) == (score, label)


def test_label_to_score(spark):
    df = spark.createDataFrame([("positive",), ("POS",), ("LABEL_NEGATIVE",), ("neg",), ("neutral",)], "l string")
    got = [r[0] for r in df.select(S.label_to_score(F.col("l"), F.lit(0.9))).collect()]
    assert got == [0.9, 0.9, -0.9, -0.9, 0.0]


def test_routing_and_plug_in(spark):
    schema = T.StructType().add("label", T.StringType()).add("score", T.DoubleType())

    @F.pandas_udf(schema)
    def model(text: pd.Series) -> pd.DataFrame:
        known = [t is not None and "broken" not in t for t in text]
        return pd.DataFrame({"label": ["POSITIVE" if k else None for k in known],
                             "score": [0.9876 if k else None for k in known]})

    english = S.classifier_scorer(lambda t: model(t), "model_en")
    df = posts(spark, ("a b", "en", 0.0), ("a b", "es", 0.0), ("a good storm", "de", 0.0), ("broken good", "en", 0.0),
               ("a b", None, 0.0))
    got = scored(S.score_sentiment(df, english=english, fallback=S.lexicon_scorer(lexicon(spark))))
    assert got[0] == (0.988, "positive", "model_en", 0.988)
    assert [g[2] for g in got] == ["model_en", "lexicon", "lexicon", "lexicon", "model_en"]
    only = scored(S.score_sentiment(df, english=english))
    assert [g[2] for g in only] == ["model_en", "unavailable", "unavailable", "error", "model_en"]
    assert scored(S.score_sentiment(df))[0] == (0.0, "neutral", "unavailable", 0.0)


def test_joined_lexicon_scores_texts_not_ids(spark):
    df = spark.createDataFrame(
        [("1", "good day"), ("1", "bad day"), (None, "great"), (None, "not good"), ("2", None)],
        "tweet_id string, text_clean string")

    def scores(make):
        out = make(lexicon(spark))(df, "s", F.lit(True))
        return {r.text_clean: r.s.score for r in out.collect()}

    assert scores(S.lexicon_scorer) == scores(S.joined_lexicon_scorer)
    found = scores(S.joined_lexicon_scorer)
    assert found["good day"] > 0 > found["bad day"] and found[None] is None


def test_texts_are_chunked_whole():
    from galewire.functions.text import chunks
    assert list(chunks([])) == []
    runs = list(chunks([3, 3, 9, 0, 1, 20, 2], limit=6))
    assert [i for r in runs for i in range(r.start, r.stop)] == list(range(7))
    assert [(r.start, r.stop) for r in runs] == [(0, 2), (2, 3), (3, 5), (5, 6), (6, 7)]


def plain_total(text, weights, rules):
    """The lexicon method word by word."""
    words = [w for w in re.split(r"[\W]+", text) if w]
    low = [w.lower() for w in words]
    caps = [w.isupper() for w in words]
    turn = next((i for i, w in enumerate(low) if w in rules.turns), None)
    total = 0.0
    for i, w in enumerate(low):
        v = weights.get(w, 0.0)
        sign = (v > 0) - (v < 0)
        if caps[i] and not all(caps):
            v += sign * 0.733
        for back, share in ((1, 1), (2, 0.95), (3, 0.9)):
            if i >= back:
                v += sign * rules.boosters.get(low[i - back], 0) * 0.293 * share
        if any(x in rules.negations for x in low[max(0, i - 3):i]):
            v *= -0.74
        if turn is not None and i != turn:
            v *= 0.5 if i < turn else 1.5
        total += v
    asks = text.count("?")
    more = min(text.count("!"), 4) * 0.292 + (0 if asks < 2 else asks * 0.18 if asks < 4 else 0.96)
    total += more if total > 0 else -more if total < 0 else 0
    return total / (total * total + 15) ** 0.5


def test_each_rule_of_the_lexicon_against_plain(spark):
    texts = [
        "good", "very good", "very, very good", "slightly good", "very bad", "very one two good", "very one two three good",
        "GOOD day", "GOOD DAY", "good STORM", "not very good", "very not good", "I good", "good but bad", "bad but good but storm",
        "BUT good", "good!", "good!!!!!!", "bad?", "bad??", "bad???", "good?????!", "storm!?", "", "!!!", "but", "VERY bad", None,
        "not GOOD, but so BAD!", "great_good good_ good", "Tür good é", "so so so so good",
    ]
    rng = random.Random(3)
    pool = "good bad storm GOOD Bad very not but slightly so x, y! Z? never".split()
    texts += [" ".join(rng.choice(pool) for _ in range(rng.randint(1, 14))) for _ in range(150)]
    texts = list(dict.fromkeys(texts))
    df = spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)], "tweet_id string, text_clean string")
    weights = {"good": 1.9, "bad": -2.5, "storm": -0.9}
    for make in (S.lexicon_scorer, S.joined_lexicon_scorer):
        got = {r.text_clean: r.s.score for r in make(lexicon(spark))(df, "s", F.lit(True)).collect()}
        for t in texts:
            want = None if t is None else pytest.approx(plain_total(t, weights, S.Rules()), abs=6e-5)
            assert got[t] == want, t


def test_carried_tables_have_a_bound(spark):
    with pytest.raises(ValueError, match="joined_lexicon_scorer"):
        S.lexicon_scorer(lexicon(spark), most=2)
    profiles = L.train_profiles(spark.createDataFrame([("abcdefgh", "x")], "text string, lang string"))
    with pytest.raises(ValueError, match="profile_language"):
        L.profile_detector(profiles, most=3)


def test_joined_profiles_give_the_same_answers(spark):
    rows = [("the cat and the dog are in the house", "en"), ("le chat et le chien sont dans la maison", "fr"),
            ("der Hund und die Katze sind im Haus", "de")]
    profiles = L.train_profiles(spark.createDataFrame(rows, "text string, lang string"))
    texts = [r[0] for r in rows] + ["the house", "la maison", "Katze \U0001f600 Haus", "", "ab", None, "zzz qqq", "THE DOG", "a\0b the"]
    df = spark.createDataFrame([(str(k % 4), t) for k, t in enumerate(texts)], "tweet_id string, text_clean string")
    carried = df.withColumn("d", L.profile_detector(profiles)(F.col("text_clean")))
    answers = [sorted((repr(r.text_clean), r.d.lang, r.d.confidence) for r in x.collect())
               for x in (carried, L.profile_language(df, profiles, "d"))]
    assert answers[0] == answers[1] and {a[1] for a in answers[0]} == {"en", "fr", "de", None}


@pytest.mark.parametrize("held", [3, 4_000_000])
def test_counted_trigrams_against_plain(monkeypatch, held):
    monkeypatch.setattr(L, "HELD_GRAMS", held)
    monkeypatch.setattr(L, "chunks", lambda sizes: chunks(sizes, 10))
    rows = [("x", "ab😢c ab😢c"), ("y", "abc\0\0"), ("x", None), (None, "abcd"), ("x", ""), ("y", "ab"), ("y", "ﬁne abc"),
            ("x", "aaaa" * 20)]
    plain = Counter(
        (lang, text[i : i + 3]) for lang, text in rows if lang and text for i in range(len(text) - 2)
    )
    batches = [
        pa.RecordBatch.from_pydict({"lang": [r[0] for r in part], "text": [r[1] for r in part]}, pa.schema(
            [("lang", pa.string()), ("text", pa.string())]))
        for part in (rows[:3], rows[3:], [])
    ]
    got = Counter()
    for batch in L._count_grams(iter(batches)):
        for row in batch.to_pylist():
            got[row["lang"], row["gram"]] += row["n"]
    assert got == plain


def test_profiles_of_nothing(spark):
    assert L.train_profiles(spark.createDataFrame([(None, "x"), ("ab", "x"), ("abc", None)], "text string, lang string")).count() == 0


def many_texts(n=400, words=400):
    pick = random.Random(5)
    vocabulary = [f"{a}{b}é{c}" for a in "abcdef" for b in "uvwxyz" for c in "stormflid"]
    return [" ".join(pick.choice(vocabulary) for _ in range(words)) for _ in range(n)]


def test_joined_profiles_meet_texts_by_buckets(spark):
    """However many buckets a table of profiles has, the answers are those of the carried one."""
    some = many_texts(60, 80) + ["", "ab", None, "zzzz", "a😢bc"]
    learned = spark.createDataFrame([(t, "xyz"[k % 3]) for k, t in enumerate(some)], "text string, lang string")
    profiles = L.train_profiles(learned).localCheckpoint()
    df = texts(spark, *[(t, "en") for t in [*some, *some[:5]]])
    carried = df.select("tweet_id", L.profile_detector(profiles)(F.col("text_clean")).alias("d"))
    want = {r.tweet_id: (r.d.lang, r.d.confidence) for r in carried.collect()}
    for held in (1_000_000, 100):
        got = L.profile_language(df, profiles, "d", held=held).collect()
        assert {r.tweet_id: (r.d.lang, r.d.confidence) if r.d.lang else (None, None) for r in got} == want


def test_trigrams_of_a_batch_are_packed_run_by_run():
    """A batch of 400 texts (0.9 million characters) leaves a task in rows of bounded size, as it is read."""
    some = many_texts()
    batch = pa.RecordBatch.from_arrays(
        [pa.array([bytes(28) + k.to_bytes(4, "big") for k in range(len(some))]), pa.array(some)], names=["_text_key", "_text"]
    )
    rows = list(L._pack_texts(1, 4)(iter([batch])))
    assert len(rows) >= 3 and sum(len(r.column("keys")[0].as_py()) for r in rows) == 32 * len(some)
    most = max(len(r.column("numbers")[0].as_py()) // 8 for r in rows)
    assert most <= CHUNK_CHARS


def test_joined_scorer_makes_its_posts_once(spark):
    """Posts are needed for their words and for their answers, and cost a cleaning each."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def cleaned(text):
        made.add(1)
        return text

    df = spark.range(40).select(
        F.col("id").cast("string").alias("tweet_id"), cleaned(F.concat(F.lit("good day "), F.col("id"))).alias("text_clean")
    )
    scored_rows = S.joined_lexicon_scorer(lexicon(spark))(df, "s", F.lit(True)).collect()
    assert len(scored_rows) == 40 and made.value == 40


def test_texts_cross_to_python_as_arrow():
    """Whole batches are not turned into objects: workers take a run of texts out of Arrow at a time."""
    from pyspark.util import PythonEvalType

    from galewire.functions.text import _nfkc

    assert _nfkc.evalType == PythonEvalType.SQL_SCALAR_ARROW_UDF


def test_emphasis_is_worked_out_once_a_post(spark):
    texts = ["fine", "fine!", "fine!!!!!!", "fine?", "fine??", "fine???", "fine????? !", "bad!?!?"]
    df = spark.createDataFrame([(t,) for t in texts], "text_clean string")
    extra = [r[0] for r in df.select(S.emphasis(F.col("text_clean"))).collect()]
    bangs, asked = [t.count("!") for t in texts], [t.count("?") for t in texts]
    assert extra == [
        min(b, S.MOST_EXCLAMATIONS) * S.EXCLAMATION
        + (0 if a < 2 else a * S.QUESTION if a < 4 else S.MANY_QUESTIONS)
        for b, a in zip(bangs, asked)
    ]
    scored_posts = S.lexicon_scorer(lexicon(spark))(df, "s", F.lit(True))
    plan = scored_posts._jdf.queryExecution().optimizedPlan().toString()
    # Its text is searched for each mark in one place of the plan.
    assert plan.count("replace(") == 2


def test_trigrams_that_share_a_slot_are_told_apart():
    rng = np.random.default_rng(5)
    grams = np.unique(rng.integers(0, 1 << 62, 5000))
    table = L._gram_slots(grams)
    # A full table: every slot is shared.
    crowded = np.full(16, len(grams), np.int32)
    crowded[L._slots(grams, 4)] = np.arange(len(grams))
    seen = np.concatenate([grams, grams + 1, rng.integers(0, 1 << 62, 2000)])
    at = np.minimum(np.searchsorted(grams, seen), len(grams) - 1)
    expected = np.where(grams[at] == seen, at, len(grams))
    assert (L._gram_places(seen, grams, table) == expected).all()
    assert (L._gram_places(seen, grams, crowded) == expected).all()


def test_scores_do_not_depend_on_the_pieces_texts_are_added_in(spark, monkeypatch):
    rows = [(i % 3 and "the river runs over the bank " * (i % 5 + 1) or "le vent du nord est froid " * 3, ["en", "fr"][i % 3 == 0])
            for i in range(30)]
    posts = spark.createDataFrame(rows, "text string, lang string")
    profiles = L.train_profiles(posts).localCheckpoint()
    found = [r.d for r in posts.select(L.profile_detector(profiles)(F.col("text")).alias("d")).collect()]
    monkeypatch.setattr(L, "ADDED", 7)
    again = [r.d for r in posts.select(L.profile_detector(profiles)(F.col("text")).alias("d")).collect()]
    assert found == again and [d.lang for d in found] == [lang for _, lang in rows]


def test_workers_of_the_chain_take_small_batches(spark):
    from galewire.session import configure
    from galewire.workload import adapter

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    adapter.table(spark, "/root/testdata/sf0.001", "nation")
    try:
        n = [r.n for r in spark.range(0, 5000, 1, 1).mapInArrow(sizes, "n long").collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        configure(spark)
    assert sum(n) == 5000 and max(n) <= 1000


def test_words_are_counted_once_a_post(spark):
    from galewire.operators.clean import clean_posts

    df = spark.createDataFrame([("1", "a b  c", [], 0)], "tweet_id string, text string, hashtags array<string>, url_count int")
    plan = clean_posts(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("replace(text_clean") == 1
    assert clean_posts(df).first().word_count == 3
