"""Text cleaning and text features; every step is a projection, nothing is shuffled."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galewire.functions import emoji as E
from galewire.functions import text as X


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row.

    A projected column is copied by the optimizer into each place that uses it, and chains of
    text steps that look at their input twice would grow exponentially. A one-element generator
    is not inlined.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def text_features(text: Column, url_count: Column, words: Column | None = None) -> dict[str, Column]:
    """Features of a tidy text; ``words`` is the number of its words, where that is known."""
    length, words = F.length(text), X.word_count(text) if words is None else words
    return {
        "text_length": length,
        "word_count": words,
        "has_media": F.coalesce(url_count, F.lit(0)) > 0,
        "avg_word_length": F.round(
            F.when(words > 0, length / words).otherwise(F.lit(0.0)), 2
        ),
    }


def clean_posts(df: DataFrame, strict_codepoint: bool = False, contractions=X.CONTRACTIONS) -> DataFrame:
    """Normalise Unicode, spell out emoji and hashtags, remove links, expand contractions.

    Adds text_clean, text_original, the emoji columns and the text features.
    """
    weights = E.base_weights(strict_codepoint)
    spelled = X.expand_hashtags(
        E.emoji_tokens(F.col("_nfkc"), F.col("emoji_list")), F.col("hashtags")
    )
    steps = df.transform(once, "_nfkc", X.nfkc(F.col("text")))
    steps = steps.transform(once, "emoji_list", E.emoji_list(F.col("_nfkc")))
    steps = steps.transform(once, "_spelled", spelled)
    steps = steps.transform(once, "_plain", X.strip_urls(F.col("_spelled")))
    steps = steps.transform(once, "_full", X.expand_contractions(F.col("_plain"), contractions))
    steps = steps.transform(once, "text_clean", X.normalize_ws(F.col("_full")))
    steps = steps.transform(once, "word_count", X.word_count(F.col("text_clean")))
    return steps.withColumns(
        {
            "text_original": F.col("text"),
            "emoji_count": F.size("emoji_list"),
            "emoji_sentiment_score": E.emoji_score(F.col("emoji_list"), weights),
            **text_features(F.col("text_clean"), F.col("url_count"), F.col("word_count")),
            "processing_stage": F.lit("cleaned"),
        }
    ).drop("_nfkc", "_spelled", "_plain", "_full")
