"""Sentiment: routing to scorers by language, emoji adjustment, labels.

A scorer adds, under a given name, ``struct<score, confidence, method>`` to the posts that meet a
condition, from their text_clean; other posts get null.
"""

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from galewire.functions.text import chunks, is_blank, stable_round
from galewire.operators.clean import once
from galewire.operators.joins import lookup_join
from galewire.sources.scratch import materialize
from galewire.sources.tables import lexicon_table

Scorer = Callable[[DataFrame, str, Column], DataFrame]

# Words of a lexicon that travels with a function, at most.
CARRIED_WORDS = 1_000_000

# Label thresholds and emoji share.
POSITIVE_THRESHOLD = 0.3
NEGATIVE_THRESHOLD = -0.3
EMOJI_SHARE = 0.2

# The constants of the lexicon method (Hutto and Gilbert 2014). Weights, boosts and
# capitals are in units of 10^-5, the factors in hundredths and tenths, so that all sums are whole.
LEXICON_ALPHA = 15
WEIGHT = 100_000
BOOSTS = (29_300, 27_835, 26_370)  # 0.293 one word before, 95 % of it two, 90 % three before
CAPITALS = 73_300
NEGATED, PLAIN = -74, 100
BEFORE_TURN, NO_TURN, AFTER_TURN = 5, 10, 15
TOTAL = WEIGHT * 100 * 10
EXCLAMATION, MOST_EXCLAMATIONS = 29_200_000, 4  # in units of a total
QUESTION, MANY_QUESTIONS = 18_000_000, 96_000_000

NEGATIONS = [
    "not", "no", "never", "none", "nobody", "nothing", "neither", "nor", "nowhere", "cannot",
    "without", "hardly", "rarely", "seldom", "barely",
]

# Words that strengthen (1) or weaken (-1) the word after them.
BOOSTERS = {
    "absolutely": 1, "amazingly": 1, "awfully": 1, "completely": 1, "considerably": 1, "deeply": 1,
    "enormously": 1, "entirely": 1, "especially": 1, "exceptionally": 1, "extremely": 1, "fully": 1,
    "greatly": 1, "highly": 1, "hugely": 1, "incredibly": 1, "intensely": 1, "more": 1, "most": 1,
    "particularly": 1, "purely": 1, "quite": 1, "really": 1, "remarkably": 1, "so": 1,
    "substantially": 1, "thoroughly": 1, "totally": 1, "tremendously": 1, "unbelievably": 1,
    "unusually": 1, "utterly": 1, "very": 1, "almost": -1, "kinda": -1, "less": -1, "little": -1,
    "marginally": -1, "occasionally": -1, "partly": -1, "scarcely": -1, "slightly": -1,
    "somewhat": -1, "sorta": -1,
}


@dataclass(frozen=True)
class Rules:
    """The word lists of the lexicon method; a turn is a word like "but"."""

    negations: tuple[str, ...] = tuple(NEGATIONS)
    boosters: dict[str, int] = field(default_factory=lambda: dict(BOOSTERS))
    turns: tuple[str, ...] = ("but",)


# A small general and weather lexicon; real work passes its own (token, weight) table.
DEFAULT_LEXICON = {
    "amazing": 2.8, "awful": -2.0, "bad": -2.5, "beautiful": 2.9, "best": 3.2, "better": 1.9,
    "calm": 1.3, "catastrophe": -3.4, "clean": 1.7, "crisis": -3.1, "damage": -2.2,
    "damaged": -1.9, "danger": -2.4, "dangerous": -2.1, "dead": -3.3, "destroyed": -2.2,
    "devastating": -2.3, "disaster": -3.1, "enjoy": 2.2, "evacuate": -1.3, "excellent": 2.7,
    "fear": -2.2, "fine": 0.8, "flood": -1.2, "fun": 2.3, "glad": 2.0, "good": 1.9,
    "great": 3.1, "happy": 2.7, "hate": -2.7, "healing": 1.7, "help": 1.7, "hope": 1.9,
    "horrible": -2.5, "hurt": -2.4, "injured": -1.7, "kill": -3.7, "killed": -3.5, "lost": -1.3,
    "love": 3.2, "miss": -0.6, "nice": 1.8, "panic": -2.3, "perfect": 2.7, "rescue": 2.3,
    "sad": -2.1, "safe": 1.9, "scary": -2.2, "severe": -1.6, "storm": -0.9, "sunny": 1.7,
    "terrible": -2.1, "thank": 1.5, "thanks": 1.9, "threat": -2.4, "tragic": -2.0, "warning": -1.4,
    "wonderful": 2.7, "worry": -1.9, "worse": -2.1, "worst": -3.1,
}


# What lies between two words, for Java's and Arrow's patterns alike.
NO_WORD = r"[^\p{L}\p{N}_]+"


def default_lexicon(spark) -> DataFrame:
    return lexicon_table(spark, DEFAULT_LEXICON)


def finalize_sentiment(raw_score: Column, emoji_score: Column) -> tuple[Column, Column]:
    """Final score and label. The label looks at the score before it is rounded."""
    share = F.coalesce(emoji_score, F.lit(0.0)) * EMOJI_SHARE
    shift = F.greatest(F.lit(-EMOJI_SHARE), F.least(F.lit(EMOJI_SHARE), share))
    score = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), raw_score + shift))
    label = (
        F.when(score > POSITIVE_THRESHOLD, "positive")
        .when(score < NEGATIVE_THRESHOLD, "negative")
        .otherwise("neutral")
    )
    return stable_round(score, 3), label


def label_to_score(label: Column, confidence: Column) -> Column:
    """Signed score of a classifier's label; no label, no score."""
    name = F.upper(label)
    return (
        F.when(label.isNull(), F.lit(None).cast("double"))
        .when(name.contains("POSITIVE") | (name == "POS"), confidence)
        .when(name.contains("NEGATIVE") | (name == "NEG"), -confidence)
        .otherwise(F.lit(0.0))
    )


def classifier_scorer(classify: Callable[[Column], Column], method: str) -> Scorer:
    """Scorer from a classifier column: text in, ``struct<label, score>`` out.

    Use an iterator pandas UDF that loads its model once per Python worker. The classifier sees
    the whole text; cutting it to a model's input size is the classifier's business.
    """

    def score(df: DataFrame, name: str, chosen: Column) -> DataFrame:
        out = df.withColumn("_class", classify(F.when(chosen, F.col("text_clean"))))
        answer = F.struct(
            label_to_score(F.col("_class.label"), F.col("_class.score")).alias("score"),
            F.round("_class.score", 3).alias("confidence"),
            F.lit(method).alias("method"),
        )
        return out.withColumn(name, F.when(chosen, answer)).drop("_class")

    return score


def word_tokens(text: Column) -> Column:
    """The words of a text as they are written."""
    return F.filter(F.split(text, NO_WORD), lambda w: w != "")


def emphasis(text: Column) -> Column:
    """What exclamation and question marks add to the size of a total."""
    def count(mark: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))

    # One to three question marks and many, looked up: the text is searched once.
    asked = F.array(*[F.lit(x).cast("long") for x in (0, 0, 2 * QUESTION, 3 * QUESTION, MANY_QUESTIONS)])
    exclaimed = F.least(count("!"), F.lit(MOST_EXCLAMATIONS)).cast("long") * EXCLAMATION
    return exclaimed + F.get(asked, F.least(count("?"), F.lit(4)))


def _moved(total: Column, text: Column) -> Column:
    """A total moved away from zero by the emphasis of its text."""
    return total + F.signum(total).cast("long") * emphasis(text)


def _compound(moved: Column, method: str) -> Column:
    """The squashed total of a text."""
    whole = moved / float(TOTAL)
    squashed = stable_round(whole / F.sqrt(whole * whole + LEXICON_ALPHA), 4)
    return F.struct(
        squashed.alias("score"),
        F.round(F.abs(squashed), 3).alias("confidence"),
        F.lit(method).alias("method"),
    )


def _weights(lexicon: DataFrame) -> DataFrame:
    return lexicon.groupBy("token").agg(
        F.max(F.round(F.col("weight") * 1000).cast("long") * (WEIGHT // 1000)).alias("weight")
    )


def lexicon_scorer(
    lexicon: DataFrame, method: str = "lexicon", rules: Rules = Rules(), most: int = CARRIED_WORDS
) -> Scorer:
    """Rule-based scorer over the words of a text in their order. A word of the lexicon counts its
    weight; boosters among the three words before strengthen or weaken it, less from further off;
    written in capitals in a text that is not all in capitals, it counts more; a negation among the
    three words before turns it round; before the first "but" it counts half, after it half as much
    again. The sum is moved away from zero by exclamation and question marks and squashed to [-1, 1].

    The lexicon, a word list of ``most`` words at most, travels to the tasks and posts are scored in
    the row. For larger tables ``joined_lexicon_scorer`` gives the same scores.
    """
    rows = _weights(lexicon).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a lexicon of over {most} words is not carried: use joined_lexicon_scorer")
    return _carried_lexicon({row.token: row.weight for row in rows}, method, rules)


def joined_lexicon_scorer(lexicon: DataFrame, method: str = "lexicon", rules: Rules = Rules()) -> Scorer:
    """``lexicon_scorer`` for a lexicon of any size, by a join on words."""
    return _joined_lexicon(_weights(lexicon), method, rules)


def _carried_lexicon(weights: dict[str, int], method: str, rules: Rules) -> Scorer:
    tokens, boosters = list(weights), list(rules.boosters)
    values = np.array([weights[t] for t in tokens] + [0], np.int64)
    signs = np.array([rules.boosters[t] for t in boosters] + [0], np.int64)

    def sums(texts: pa.Array) -> np.ndarray:
        """The words of all texts in one column; each distinct word is looked up once."""
        split = pc.split_pattern_regex(texts.cast(pa.large_string()), NO_WORD)
        coded, row = pc.list_flatten(split).dictionary_encode(), pc.list_parent_indices(split).to_numpy()
        written, word, n = coded.dictionary, coded.indices.to_numpy(), len(texts)
        real = pc.not_equal(written, "").to_numpy(zero_copy_only=False)[word]
        word, row = word[real], row[real]
        words = pc.utf8_lower(written)

        def where(names: list[str]) -> np.ndarray:
            return pc.fill_null(pc.index_in(words, pa.array(names, words.type)), len(names)).to_numpy()

        weight, boost = values[where(tokens)][word], signs[where(boosters)][word]
        negation = (where(list(rules.negations)) < len(rules.negations))[word]
        turn = (where(list(rules.turns)) < len(rules.turns))[word]
        negated, boosted = np.zeros(len(row), bool), np.zeros(len(row), np.int64)
        for back, size in enumerate(BOOSTS, 1):
            same = row[back:] == row[:-back]
            negated[back:] |= negation[:-back] & same
            boosted[back:] += size * boost[:-back] * same
        upper = pc.and_(pc.equal(pc.utf8_upper(written), written), pc.not_equal(words, written))
        upper = upper.to_numpy(zero_copy_only=False)[word]
        shouted = np.bincount(row, upper, minlength=n) == np.bincount(row, minlength=n)
        boosted += CAPITALS * (upper & ~shouted[row])
        at = np.arange(len(row))
        first = np.full(n, len(row))
        np.minimum.at(first, row[turn], at[turn])
        has_turn = first[row] < len(row)
        part = np.where(has_turn & (at < first[row]), BEFORE_TURN, np.where(has_turn & (at > first[row]), AFTER_TURN, NO_TURN))
        each = (weight + np.sign(weight) * boosted) * np.where(negated, NEGATED, PLAIN) * part
        # Whole numbers, added as such: exact in any order.
        out = np.zeros(n, np.int64)
        np.add.at(out, row, each)
        return out

    @F.arrow_udf(LongType())
    def totals(texts: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
        each = [sums(texts.slice(run.start, run.stop - run.start)) for run in chunks(sizes)]
        total = np.concatenate([np.empty(0, np.int64), *each])
        return pa.array(total, pa.int64(), mask=pc.is_null(texts).to_numpy(zero_copy_only=False))

    def score(df: DataFrame, name: str, chosen: Column) -> DataFrame:
        summed = df.withColumn("_total", totals(F.when(chosen, F.col("text_clean"))))
        moved = summed.transform(once, "_moved", _moved(F.col("_total"), F.col("text_clean")))
        answer = _compound(F.col("_moved"), method)
        return moved.withColumn(name, F.when(chosen, answer)).drop("_total", "_moved")

    return score


def _joined_lexicon(table: DataFrame, method: str, rules: Rules) -> Scorer:
    """Words as rows, met with the lexicon in an equality join. Scores belong to texts: each text
    is scored once and found again by its digest, so repeated and missing ids do not matter. The
    sum of a text is started in the task that read it. Posts are read twice, for their words and for
    their answers, so they are written once to the shared folder."""

    def before(tokens: Column, n: int) -> Column:
        return F.concat(F.array(*[F.lit("")] * n), tokens)

    def score(df: DataFrame, name: str, chosen: Column) -> DataFrame:
        written, words = F.col("_written"), F.col("_words")
        is_upper = lambda w: (F.upper(w) == w) & (F.lower(w) != w)
        upper = F.transform(written, is_upper)
        mixed = ~F.forall(written, is_upper)
        turn = F.array_position(F.transform(words, lambda w: w.isin(*rules.turns)), True)
        columns = [words.alias("token"), upper.alias("upper"), F.sequence(F.lit(1), F.size(words)).alias("at")]
        columns += [before(words, n).alias(f"p{n}") for n in (1, 2, 3)]
        keyed = materialize(df.withColumn("_text_key", F.when(chosen, F.sha2("text_clean", 256))), "keyed")
        texts = (
            keyed.where("_text_key IS NOT NULL").groupBy("_text_key")
            .agg(F.min("text_clean").alias("_text"))
            .select("_text_key", word_tokens(F.col("_text")).alias("_written"))
            .where(F.size("_written") > 0)
            .withColumn("_words", F.transform("_written", F.lower))
            .withColumns({"_mixed": mixed, "_turn": turn})
        )
        rows = texts.select("_text_key", "_mixed", "_turn", F.inline(F.arrays_zip(*columns))).where("token IS NOT NULL")
        negated, boosted = F.lit(False), F.when(F.col("upper") & F.col("_mixed"), F.lit(CAPITALS)).otherwise(F.lit(0))
        for n, size in enumerate(BOOSTS, 1):
            previous = F.col(f"p{n}")
            negated = negated | previous.isin(*rules.negations)
            for word_sign in (1, -1):
                named = [w for w, x in rules.boosters.items() if x == word_sign]
                if named:
                    boosted = boosted + F.when(previous.isin(*named), F.lit(word_sign * size)).otherwise(F.lit(0))
        part = (
            F.when((F.col("_turn") > 0) & (F.col("at") < F.col("_turn")), F.lit(BEFORE_TURN))
            .when((F.col("_turn") > 0) & (F.col("at") > F.col("_turn")), F.lit(AFTER_TURN))
            .otherwise(F.lit(NO_TURN))
        )
        weight = F.col("weight") + F.signum("weight").cast("long") * boosted
        each = weight * F.when(negated, F.lit(NEGATED)).otherwise(F.lit(PLAIN)) * part
        sums = rows.join(table, "token").groupBy("_text_key").agg(F.sum(each).alias("_total"))
        summed = lookup_join(keyed, sums, ["_text_key"], spread="tweet_id")
        total = F.when(F.col("_text_key").isNotNull(), F.coalesce("_total", F.lit(0).cast("long")))
        moved = summed.transform(once, "_moved", _moved(total, F.col("text_clean")))
        answer = _compound(F.col("_moved"), method)
        return moved.withColumn(name, F.when(chosen, answer)).drop("_total", "_moved", "_text_key")

    return score


def score_sentiment(
    df: DataFrame,
    english: Scorer | None = None,
    multilingual: Scorer | None = None,
    fallback: Scorer | None = None,
) -> DataFrame:
    """Adds the four sentiment columns to posts with text_clean, detected_lang and the emoji
    score.

    English posts go to the English scorer, others to the multilingual one; a missing scorer
    hands its posts to the next one in that order. Each scorer sees only its own posts. A post
    whose classifier gave no answer goes to the fallback, too.
    """
    blank = is_blank(F.coalesce("text_clean", F.lit("")))
    is_english = F.coalesce("detected_lang", F.lit("en")) == "en"
    out = df.withColumn("_open", ~blank)
    nothing = "struct<score: double, confidence: double, method: string>"
    answer, asked = F.lit(None).cast(nothing), F.lit(False)
    for name, scorer, mine in (
        ("_english", english, is_english),
        ("_multilingual", multilingual, ~is_english | F.lit(english is None)),
        ("_fallback", fallback, F.lit(True)),
    ):
        if scorer is None:
            continue
        unanswered = answer["score"].isNull()
        out = scorer(out, name, F.col("_open") & mine & unanswered)
        answer = F.when(unanswered, F.col(name)).otherwise(answer)
        asked = asked | mine
    known = answer["score"].isNotNull()
    final, label = finalize_sentiment(answer["score"], F.col("emoji_sentiment_score"))
    method = (
        F.when(blank, "empty_text")
        .when(known, answer["method"])
        .when(asked, "error")
        .otherwise("unavailable")
    )
    return out.withColumns(
        {
            "sentiment_score": F.when(known, final).otherwise(F.lit(0.0)),
            "sentiment_label": F.when(known, label).otherwise("neutral"),
            "sentiment_method": method,
            "sentiment_confidence": F.when(known, answer["confidence"]).otherwise(F.lit(0.0)),
            "processing_stage": F.lit("sentiment_computed"),
        }
    ).drop("_open", "_english", "_multilingual", "_fallback")
