"""Column helpers for text cleaning. All stay in the JVM except ``nfkc``."""

import unicodedata
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The URL pattern, and the control characters that count as white space.
URL_PATTERN = r"https?://\S+|www\.\S+"
SEPARATORS = "\x1c\x1d\x1e\x1f"
# All white space of Unicode, and the separators above.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r " + SEPARATORS + "\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# English contractions, applied in this order; groups keep the case of the first letters.
CONTRACTIONS = [
    (r"(?i)\b(w)on['’]t\b", "$1ill not"),
    (r"(?i)\b(ca)n['’]t\b", "$1nnot"),
    (r"(?i)\b(sha)n['’]t\b", "$1ll not"),
    (r"(?i)\b(a)in['’]t\b", "$1re not"),
    (r"(?i)n['’]t\b", " not"),
    (r"(?i)\b(not)['’]ve\b", "$1 have"),
    (r"(?i)\b(y)['’]all\b", "$1ou all"),
    (r"(?i)\b(ma)['’]am\b", "$1dam"),
    (r"(?i)\b(o)['’]clock\b", "$1f the clock"),
    (r"(?i)(^|\s)['’](em)\b", "$1th$2"),
    (r"(?i)(^|\s)['’]t(is|was)\b", "$1it $2"),
    (r"(?i)\b(let)['’]s\b", "$1 us"),
    (r"(?i)\b(he|she|it|that|there|here|what|where|who|how|when|why)['’]s\b", "$1 is"),
    (r"(?i)\b(i)['’]m\b", "$1 am"),
    (r"(?i)\b(you|we|they|who|what|there)['’]re\b", "$1 are"),
    (r"(?i)\b(i|you|we|they|who|would|could|should|might|must|all)['’]ve\b", "$1 have"),
    (r"(?i)\b(i|you|he|she|it|we|they|that|there|who|what|all)['’]ll\b", "$1 will"),
    (r"(?i)\b(i|you|he|she|it|we|they|that|there|who|all)['’]d\b", "$1 would"),
    (r"(?i)\b(i|you|he|she|it|we|they|that|there|who|all) would['’]ve\b", "$1 would have"),
    (r"(?i)['’](cause)\b", "be$1"),
    # Spoken forms without an apostrophe.
    (r"(?i)\b(go)nna\b", "$1ing to"),
    (r"(?i)\b(wan)na\b", "$1t to"),
    (r"(?i)\b(got)ta\b", "$1 to"),
    (r"(?i)\b(g)imme\b", "$1ive me"),
]

# What a text must hold for one of these rules to apply; most hold none and are searched once. One
# class of first letters stands before the cases, so that most characters cost one look.
CONTRACTION_HINT = (
    r"['’nNtTmM](?:(?<=['’])|(?<=[nN])[nN][aA]\b|(?<=[tT])[tT][aA]\b|(?<=[mM])[mM][eE]\b)"
)

# What a text, in lower case and with straight apostrophes, must hold for a rule to apply: a plain
# search costs a fraction of the pattern's. A rule that is not listed is always tried.
CONTRACTION_NEEDS = dict(
    zip(
        [pattern for pattern, _ in CONTRACTIONS],
        [
            "won't", "can't", "shan't", "n't", "n't", "not've", "y'all", "ma'am", "o'clock", "'em",
            "'t", "let's", "'s", "'m", "'re", "'ve", "'ll", "'d", "would've", "'cause", "nna",
            "nna", "tta", "mme",
        ],
        strict=True,
    )
)

# White space in patterns.
SPACE_CLASS = r"\s\x1c-\x1f"
# Runs of white space other than a single blank.
UNEVEN_SPACE = f"(?U) [{SPACE_CLASS}]+|[{SPACE_CLASS}&&[^ ]][{SPACE_CLASS}]*"


def pytrim(c: Column) -> Column:
    """Strip every kind of white space at both ends, not only blanks."""
    ends = [F.lit(WHITE_SPACE).contains(end) for end in (F.left(c, F.lit(1)), F.right(c, F.lit(1)))]
    return F.when(ends[0] | ends[1], F.btrim(c, F.lit(WHITE_SPACE))).otherwise(c)


def normalize_ws(c: Column) -> Column:
    """Each run of white space becomes one blank; none is left at the ends."""
    return F.trim(F.regexp_replace(c, UNEVEN_SPACE, " "))


def is_blank(c: Column) -> Column:
    return ~c.rlike(f"(?U)[^{SPACE_CLASS}]")


def stripped_length_is(c: Column, least: int) -> Column:
    """Whether a text has ``least`` characters (two or more) without the white space at its ends."""
    return c.rlike(f"(?s)[^{WHITE_SPACE}].{{{least - 2},}}?[^{WHITE_SPACE}]")


def text_hash(c: Column) -> Column:
    """Equal for texts that differ only in case or surrounding white space."""
    return F.md5(F.lower(pytrim(c)))


# Texts are worked on together, up to so many characters at a time; a longer one alone.
CHUNK_CHARS = 1 << 18


def chunks(sizes: Sequence[int], limit: int = CHUNK_CHARS) -> Iterator[slice]:
    """Consecutive runs of texts of about ``limit`` characters together."""
    start, held = 0, 0
    for at, size in enumerate(sizes):
        if at > start and held + size > limit:
            yield slice(start, at)
            start, held = at, 0
        held += size
    if start < len(sizes):
        yield slice(start, len(sizes))


@F.arrow_udf(StringType())
def _nfkc(texts: pa.Array) -> pa.Array:
    # One text at a time leaves Arrow's memory.
    normal = (unicodedata.normalize("NFKC", t.as_py()) if t.is_valid else None for t in texts)
    return pa.array(normal, pa.string(), size=len(texts))


def nfkc(c: Column) -> Column:
    """Unicode NFKC. Pure-ASCII texts are their own NFKC form, so only the others cross to Python."""
    other = F.when(c.rlike(r"[^\x00-\x7F]"), c)
    return F.coalesce(_nfkc(other), c)


def strip_urls(c: Column) -> Column:
    named = c.contains("://") | c.contains("www.")
    return F.when(named, F.regexp_replace(c, URL_PATTERN, "")).otherwise(c)


def expand_contractions(
    c: Column, rules=CONTRACTIONS, hint: str = CONTRACTION_HINT, needs: dict[str, str] = CONTRACTION_NEEDS
) -> Column:
    """Apply the rules one after the other, each to texts that hold what it needs."""
    table = F.array(
        *[
            F.struct(F.lit(needs.get(p, "")).alias("need"), F.lit(p).alias("pattern"), F.lit(r).alias("put"))
            for p, r in rules
        ]
    )

    def searched(text: Column) -> Column:
        low = F.replace(F.lower(text), F.lit("’"), F.lit("'"))
        return F.struct(text.alias("text"), low.alias("low"))

    def apply(acc: Column, rule: Column) -> Column:
        replaced = F.array(F.regexp_replace(acc["text"], rule["pattern"], rule["put"]))
        changed = F.get(F.transform(replaced, searched), F.lit(0))
        return F.when(F.contains(acc["low"], rule["need"]), changed).otherwise(acc)

    # What is searched is made anew only where a rule applied.
    done = F.aggregate(table, searched(c), apply, lambda acc: acc["text"]) if rules else c
    return F.when(c.rlike(hint), done).otherwise(c)


def split_camel(c: Column) -> Column:
    """``ClimateChange`` -> ``climate change``, ``Hurricane2024`` -> ``hurricane 2024``."""
    words = F.regexp_replace(c, "([a-z])([A-Z])", "$1 $2")
    return F.lower(F.regexp_replace(words, r"([a-zA-Z])(\d)", "$1 $2"))


def expand_hashtags(text: Column, tags: Column) -> Column:
    """Replace each ``#Tag`` by its words, tag after tag in list order. Empty tags are skipped."""
    named = F.filter(F.coalesce(tags, F.array().cast("array<string>")), lambda t: t != "")
    return F.aggregate(
        named, text, lambda acc, t: F.replace(acc, F.concat(F.lit("#"), t), split_camel(t))
    )


def word_count(c: Column) -> Column:
    """Number of words of a text whose white space is already normalised."""
    gaps = F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    return F.when(c == "", F.lit(0)).otherwise(gaps + 1)


def stable_round(c: Column, digits: int) -> Column:
    """Round away summation-order noise first, so a result does not depend on the partitioning."""
    return F.round(F.round(c, 10), digits)
