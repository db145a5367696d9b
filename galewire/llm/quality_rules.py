"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one long whose
bit k says that rule k failed. A policy is a version name and the set of rules it enforces; any
number of policies, and what each rule alone removes, are then answered from the bits without
looking at a text again.

All of it is row-wise column arithmetic over whole texts; only the ablation report shuffles, and
that one row per distinct bitmask and task.

Defined results: a null, empty or blank text has no words, all measurements 0, and fails
``too_few_words`` alone. Repeated rows are judged each for itself. Every column of the input is
carried in the struct ``row``, so its names cannot clash with the ledger's.
"""

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galewire.llm.text import BLANKS, bind, words

WINDOW = 5
SYMBOLS = "#*$%&|<>"


def repeated_words(w: Column, window: int = WINDOW) -> Column:
    """Words covered by runs of ``window`` words that occur twice or more in the same text.

    Runs are compared by 64-bit hash, within one text. Texts without a repeated run, nearly all,
    cost one hash set; only the others sort their runs.
    """
    n = F.size(w)

    def run_hash(i: Column) -> Column:
        return F.xxhash64(*[F.get(w, i + k) for k in range(window)])

    def equal(a: Column, b: Column) -> Column:
        return F.coalesce(a == b, F.lit(False))

    def covered(at: Column) -> Column:
        steps = F.transform(
            at, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(at, k + 1) - x, F.lit(window)))
        )
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def from_sorted(s: Column) -> Column:
        twice = F.filter(
            s,
            lambda x, k: equal(x["h"], F.get(s, k - 1)["h"]) | equal(x["h"], F.get(s, k + 1)["h"]),
        )
        return bind(F.sort_array(F.transform(twice, lambda x: x["i"])), covered)

    def from_hashes(h: Column) -> Column:
        order = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            bind(order, from_sorted)
        )

    hashes = F.transform(F.sequence(F.lit(0), n - window), run_hash)
    return F.when(n > window, bind(hashes, from_hashes)).otherwise(F.lit(0)).cast("long")


def _count(text: Column, wanted: str) -> Column:
    """Characters of a class; ``wanted`` is the inside of a regex class."""
    return F.length(F.regexp_replace(text, f"[^{wanted}]+", "")).cast("long")


@dataclass(frozen=True)
class Rule:
    name: str
    failed: str  # SQL over the measurements


# The order fixes the bits: new rules go to the end.
RULES = (
    Rule("too_few_words", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("many_symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 4 * n_lines"),
    Rule("short_words", "word_chars < 3 * n_words"),
    Rule("long_words", "word_chars > 10 * n_words"),
    Rule("upper_case", "n_words > 0 and 2 * n_upper > word_chars"),
)
BASE = ("too_few_words", "repeated_words")

# Policy versions: the rules each one enforces.
POLICIES: Mapping[str, tuple[str, ...]] = {
    "base-1": BASE,
    "web-1": (*BASE, "many_symbols", "repeated_lines", "short_words", "long_words"),
    "web-2": tuple(r.name for r in RULES),
}
POLICY = "web-2"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")


def mask(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    place = {r.name: k for k, r in enumerate(rules)}
    return sum(1 << place[n] for n in set(names))


def ledger(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``row`` (the input row), the measurements, and ``failed_bits``."""
    if len(rules) > 63:
        raise ValueError("a ledger holds 63 rules; use a second one beyond that")
    whole = F.coalesce(F.col(f"row.`{text}`"), F.lit(""))
    split = docs.select(F.struct("*").alias("row")).select(
        "row",
        whole.alias("_text"),
        words(whole).alias("_words"),
        F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "").alias("_lines"),
    )
    measures = F.struct(
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        _count(F.col("_text"), SYMBOLS).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        _count(F.col("_text"), r"\p{Lu}").alias("n_upper"),
    )
    # A one-row generator: as a plain projection the optimizer would copy the measurements, words
    # and all, into every filter on them.
    measured = split.select("row", F.explode(F.array(measures)).alias("_m")).select("row", "_m.*")
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.failed), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("failed_bits", bits)


def rejected(enforced: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> Column:
    """Whether a ledger row fails any enforced rule."""
    return F.col("failed_bits").bitwiseAND(F.lit(mask(enforced, rules))) != 0


def apply_policy(
    book: DataFrame,
    version: str = POLICY,
    policies: Mapping[str, tuple[str, ...]] = POLICIES,
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """The ledger with ``policy`` and ``kept``."""
    return book.withColumns(
        {"policy": F.lit(version), "kept": ~rejected(policies[version], rules)}
    )


def ablation(
    book: DataFrame,
    version: str = POLICY,
    policies: Mapping[str, tuple[str, ...]] = POLICIES,
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Per rule of a policy: documents, how many fail it, how many fail nothing else, and how many
    the policy would keep without it. An empty ledger gives no rows.

    The texts' bits are first counted per distinct bitmask; the rules are then read off those few
    rows.
    """
    enforced = mask(policies[version], rules)
    per_mask = book.groupBy("failed_bits").agg(F.count("*").alias("n"))
    tests = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(1 << k).cast("long").alias("bit"))
        for k, r in enumerate(rules)
        if r.name in policies[version]
    ])
    bits, bit = F.col("failed_bits"), F.col("t.bit")
    own = bits.bitwiseAND(F.lit(enforced))

    def count(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))

    return (
        per_mask.select("failed_bits", "n", F.explode(tests).alias("t"))
        .groupBy(F.col("t.rule").alias("rule"), bit.alias("bit"))
        .agg(
            F.sum("n").alias("n_docs"),
            count(bits.bitwiseAND(bit) != 0).alias("n_failed"),
            count(own == bit).alias("n_only"),
            count((own == 0) | (own == bit)).alias("n_kept_without"),
        )
        .withColumn("policy", F.lit(version))
    )


def keep_good(docs: DataFrame, version: str = POLICY) -> DataFrame:
    """The input rows that the policy keeps, with their columns."""
    return apply_policy(ledger(docs), version).filter("kept").select("row.*")
