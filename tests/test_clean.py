import unicodedata

from pyspark.sql import functions as F

from galewire.functions import emoji as E
from galewire.functions import text as X
from galewire.operators.clean import clean_posts

SCHEMA = ("tweet_id string, text string, hashtags array<string>, hashtag_count int, "
          "mention_count int, url_count int")


def one(spark, make, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r[0] for r in df.select(make(F.col("t"))).collect()]


def clean(spark, text, tags=(), urls=0, **options):
    df = spark.createDataFrame([("1", text, list(tags), len(tags), 0, urls)], SCHEMA)
    return clean_posts(df, **options).first()


def test_camel_case(spark):
    assert one(spark, X.split_camel, "SnowLineRising", "Season1998", "dew", "NASAEarth") == [
        "snow line rising", "season 1998", "dew", "nasaearth"]


def test_urls(spark):
    got = one(spark, X.strip_urls, "map: http://maps.example/a?b=c#d, mirror www.maps.example/x y", "no link")
    assert got == ["map:  mirror  y", "no link"]


def test_white_space(spark):
    assert one(spark, X.normalize_ws, "\tdry   \n heat ", "p\x1cq\u3000r", "") == ["dry heat", "p q r", ""]
    assert one(spark, X.pytrim, "  x y \x1d\n") == ["x y"]
    every = "".join(map(chr, range(0x3100)))
    blank = [c for c in every if c.isspace()]
    assert one(spark, X.pytrim, "".join(blank) + "x\x1cy" + "".join(blank), *blank, "", None) == (
        ["x\x1cy"] + [""] * len(blank) + ["", None])
    assert one(spark, X.pytrim, *[c + "x" for c in every if not c.isspace()]) == [
        c + "x" for c in every if not c.isspace()]
    assert one(spark, X.is_blank, " \t　\x1f", "", "a") == [True, True, False]


def test_contractions(spark):
    got = one(spark, X.expand_contractions, "Roads aren't dry and we're late", "She’ll say it won't last",
              "nothing short here", "I'd go, you've gone, let's stay")
    assert got == ["Roads are not dry and we are late", "She will say it will not last", "nothing short here",
                   "I would go, you have gone, let us stay"]


def test_double_and_spoken_forms(spark):
    got = one(spark, X.expand_contractions, "Y'all couldn't've known", "see 'em at six o'clock, ma’am",
              "'Tis what they'd've wanted", "Gonna rain, wanna wait, gotta go, gimme shade", "lasagna")
    assert got == ["You all could not have known", "see them at six of the clock, madam",
                   "it is what they would have wanted", "Going to rain, want to wait, got to go, give me shade",
                   "lasagna"]


def test_only_emoji_are_emoji(spark):
    assert one(spark, E.emoji_list, "🌢🎔🔾🥆🛓 ok", "💪🏽🫠🥇") == [[], ["💪", "🏽", "🫠", "🥇"]]
    got = one(spark, lambda c: E.emoji_tokens(c, E.emoji_list(c)), "strong 💪 day")
    assert got == ["strong  :flexed_biceps:  day"]


def test_nfkc(spark):
    texts = ["ﬁne ① ½ plain", "plain", "é", None]
    want = [t and unicodedata.normalize("NFKC", t) for t in texts]
    assert one(spark, X.nfkc, *texts) == want


def test_emoji(spark):
    text = "snow day 🌞 at last 😊😊"
    assert one(spark, E.emoji_list, text, "none 12 #*", "❤️☀ ok") == [["🌞", "😊", "😊"], [], ["❤", "☀"]]
    weights = E.base_weights()
    scores = one(spark, lambda c: E.emoji_score(E.emoji_list(c)), text, "❤️", "plain")
    assert [round(x, 6) for x in scores] == [round(weights["🌞"] + 2 * weights["😊"], 6), weights["❤"], 0.0]
    strict = E.base_weights(strict_codepoint=True)
    assert one(spark, lambda c: E.emoji_score(E.emoji_list(c), strict), "❤️😊") == [0.8]
    assert one(spark, lambda c: E.emoji_tokens(c, E.emoji_list(c)), "so❤️ 🌞!") == [
        "so :red_heart:   :sun_with_face: !"]


def test_lexicon_covers_its_names():
    assert set(E.base_weights()) == set(E.EMOJI_NAMES) and len(E.EMOJI_WEIGHTS) == 48
    assert len(E.base_weights(strict_codepoint=True)) == 40


def test_hashtags_fold_in_list_order(spark):
    df = spark.createDataFrame(
        [("#FloodRelief after #Flood", ["Flood", "FloodRelief"]), ("# a #B", ["", "B"]), ("x", None)],
        "t string, tags array<string>")
    got = [r[0] for r in df.select(X.expand_hashtags(F.col("t"), F.col("tags"))).collect()]
    assert got == ["floodRelief after flood", "# a b", "x"]


def test_full_clean(spark):
    row = clean(spark, "We can't   leave 😊 #RiverWatch http://river.example/now", ["RiverWatch"], 1)
    words = ["We", "cannot", "leave", ":smiling_face_with_smiling_eyes:", "river", "watch"]
    assert row.text_clean == " ".join(words)
    assert row.text_original.startswith("We can't   leave")
    assert (row.emoji_count, row.emoji_sentiment_score, row.has_media) == (1, E.base_weights()["😊"], True)
    assert (row.text_length, row.word_count) == (len(row.text_clean), len(words))
    assert row.avg_word_length == round(len(row.text_clean) / len(words), 2)
    assert row.processing_stage == "cleaned"


def test_empty_text(spark):
    row = clean(spark, "https://example.com")
    assert (row.text_clean, row.text_length, row.word_count, row.avg_word_length) == ("", 0, 0, 0.0)
    assert row.has_media is False


def test_strict_emoji_flag(spark):
    assert clean(spark, "❤️").emoji_sentiment_score == 0.9
    assert clean(spark, "❤️", strict_codepoint=True).emoji_sentiment_score == 0.0


def test_steps_are_not_copied(spark):
    df = spark.createDataFrame([("1", "x", [], 0, 0, 0)], SCHEMA)
    plan = clean_posts(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("https?") == 1


def test_rules_are_tried_only_on_texts_that_hold_what_they_need(spark):
    texts = [
        "I WON’T say she'd go", "y'all shan't, ma’am", "won't've let's", "'tis at six o'clock, 'cause",
        "gonna WANNA gotta Gimme Anna comme", "no rule here", "ain’t it? they're, I'm, who’ll", "", None, "'em n’t",
    ]

    def every(c):
        for pattern, replacement in X.CONTRACTIONS:
            c = F.regexp_replace(c, pattern, replacement)
        return c

    assert one(spark, X.expand_contractions, *texts) == one(spark, every, *texts)
    # A rule whose need is not met is not tried, and one without a need always is.
    rules = [("needed", "x"), ("free", "y")]
    gated = one(spark, lambda c: X.expand_contractions(c, rules, ".", {"needed": "!"}), "needed free", "needed free!")
    assert gated == ["needed y", "x y!"]


def test_even_white_space_is_left_alone(spark):
    texts = ["a b  c", " a  b\n", "a\x1c\x1d b \t", "　", "a b c", "x  y z", None]
    tidy = [None if t is None else " ".join(t.split()) for t in texts]
    assert one(spark, X.normalize_ws, *texts) == tidy
    # Only runs that are no single blank are replaced.
    touched = one(spark, lambda c: F.regexp_replace(c, X.UNEVEN_SPACE, "#"), "a b c", "a  b \t", "a\x1cb")
    assert touched == ["a b c", "a#b#", "a#b"]


def test_length_without_outer_white_space(spark):
    texts = ["", " \t ", "a", "123456789", " 123456789 ", "1 3 5 7 9 ", "　1 3 5 7 90\x1f", "a\n\n\n\n\n\n\n\nb",
             "a" + " " * 5000, "😢" * 9, "😢" * 10, "x" * 4000]
    assert one(spark, lambda c: X.stripped_length_is(c, 10), *texts) == [len(t.strip()) >= 10 for t in texts]
