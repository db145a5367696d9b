"""Mixing sources to target weights by a low-discrepancy schedule.

Slot n of the mix gets the golden-ratio point frac(n / phi), which is looked up in the cumulative
target shares of the sources; the slots of a source are ranked, and slot number k of a source
takes block k of it. A block is ``block_words`` words of the source's documents in seeded random
order, laid end to end and, where the target exceeds the source, read again from the front. What
the discrepancy leaves of a target, a few blocks, comes in tail slots, so every source gives its
target rounded down.

Column functions and joins only. A source is cut into slices of its random order to find where its
documents lie, slots are ranked in runs of consecutive numbers, and blocks meet documents on
(source, cell of block_words words): no step holds a whole source, whatever its share.

Defined results: null and empty texts have size 0 and take no part (taken 0); a null source is a
source of its own, the last; rows that agree in everything are taken in any order. An empty table
gives no rows. ``carry`` names what of the input travels along; its other columns are not read.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galewire.llm.rows import key_shift, order_key, ranked, with_row_id
from galewire.llm.text import word_count
from galewire.sources.scratch import materialize

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
BLOCK_WORDS = 1024
SEED = 17

# 2**32 divided by the golden ratio, as an odd integer: n * GOLDEN mod 2**32 visits every value.
GOLDEN = 2654435769
RANGE = 1 << 32


@dataclass(frozen=True)
class Mixture:
    sources: DataFrame  # source_key, source_no, weight, source_size, target, target_words
    schedule: DataFrame  # slot, source_no, block (rank of the slot), first, last: words of the source
    pieces: DataFrame  # slot, carry, doc_first, n_words: what of which document a slot takes
    documents: DataFrame  # carry, size, source_size, target, taken


def golden_point(n: Column) -> Column:
    """frac(n / phi) in units of 2**-32, in whole numbers; n below 2**51."""
    high = F.shiftright(n, 20) * F.lit(GOLDEN * (1 << 20) % RANGE)
    return F.pmod(high + F.pmod(n, F.lit(1 << 20)) * F.lit(GOLDEN), F.lit(RANGE))


def source_targets(sized: DataFrame, weights: Sequence[float], max_repeats: int) -> DataFrame:
    """One row per source: weight, size, and its target after the capped excess is shared anew.

    The level (words per unit of weight) is found by rounds over the source list; a round caps at
    least one more source or is the last.
    """
    per = sized.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy("source_key")) - 1
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), F.pmod(number, F.lit(len(weights))) + 1
    )
    listed = materialize(
        per.select("source_key", number.cast("long").alias("source_no"),
                   weight.alias("weight"), "source_size"),
        "mix-sources",
    )
    cap = F.lit(max_repeats) * F.col("source_size")
    total = listed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, capped = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > cap
        n, fixed, free = listed.agg(
            F.count(F.when(over, 1)),
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)),
        ).first()
        if n == capped or free == 0:
            break
        level, capped = (total - fixed) / free, n
    target = F.least(F.col("weight") * F.lit(float(level)), cap.cast("double"))
    return listed.withColumn("target", target).withColumn(
        "target_words", F.floor(F.col("target") + F.lit(1e-6)).cast("long")
    )


def _slots(sources: DataFrame, total: int, n_sources: int, block: int) -> DataFrame:
    """slot, source_no, block: the ranked schedule, before the tail."""
    spark = sources.sparkSession
    before = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum("target").over(before)
    everything = F.sum("target").over(Window.partitionBy(F.lit(0)))
    high = F.when(F.col("source_no") == n_sources - 1, F.lit(RANGE)).otherwise(
        F.round(upto / everything * RANGE).cast("long")
    )
    shares = sources.select("source_no", high.alias("_hi")).withColumn(
        "_lo", F.coalesce(F.lag("_hi").over(Window.orderBy("source_no")), F.lit(0))
    )
    # Both sides meet in cells of the unit interval, more cells than sources.
    shift = 32 - max(10, (4 * n_sources).bit_length())
    cells = shares.filter("_lo < _hi").withColumn(
        "_cell", F.explode(F.sequence(F.shiftright("_lo", shift), F.shiftright(F.col("_hi") - 1, shift)))
    )
    points = spark.range(total // block).select(F.col("id").alias("slot"), golden_point(F.col("id")).alias("_x"))
    points = points.withColumn("_cell", F.shiftright("_x", shift))
    hit = points.join(cells, "_cell").filter("_lo <= _x AND _x < _hi").select("slot", "source_no")
    return ranked(hit, ["source_no"], "slot", 15, []).select(
        "slot", "source_no", F.col("rank").alias("block"), F.col("group_rows").alias("_slots")
    )


def mix(
    docs: DataFrame,
    carry: Sequence[str] = ("doc_id",),
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
    order_by: Sequence[str] | None = None,
) -> Mixture:
    """The mix of all documents; 100 % of their words, shared by weight. The random order of a source
    follows from ``order_by`` (unless given: ``carry`` and the text), ties from ``carry``."""
    block = F.lit(block_words)
    src, whole = F.col(f"`{source}`"), F.col(f"`{text}`")
    kept = F.struct(*[F.col(f"`{c}`") for c in carry])
    by = [kept, F.crc32(whole)] if order_by is None else [F.col(f"`{c}`") for c in order_by]
    sized = materialize(
        docs.select(
            kept.alias("carry"),
            # Code point order with null last: a null gets a key above every string's.
            F.when(src.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), src)).alias("source_key"),
            word_count(whole).alias("size"),
            order_key(seed, *by).alias("order"),
        ),
        "mix-sized",
    )
    sources = materialize(source_targets(sized, weights, max_repeats), "mix-targets")
    rows, total = sized.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    n_sources = sources.count()

    main = _slots(sources, total, n_sources, block_words)
    counts = main.groupBy("source_no").agg(F.max("_slots").alias("_slots"))
    blocks = F.ceil(F.col("target_words") / block).cast("long")
    tail = (
        sources.join(counts, "source_no", "left")
        .withColumn("_slots", F.coalesce("_slots", F.lit(0).cast("long")))
        .filter(F.col("_slots") < blocks)
        .select("source_no", "_slots", F.explode(F.sequence("_slots", blocks - 1)).alias("block"))
        .select(
            (F.lit(total // block_words) + (F.col("block") - F.col("_slots")) * n_sources
             + F.col("source_no")).alias("slot"),
            "source_no", "block",
        )
    )
    schedule = (
        main.select("slot", "source_no", "block").unionByName(tail)
        .join(sources.select("source_no", "source_size", "target_words"), "source_no")
        .withColumn("first", F.col("block") * block)
        .withColumn("last", F.least(F.col("first") + block, "target_words"))
        .filter("first < last")
    )
    # A block may run past the end of its source: one interval for each time round.
    lap = F.explode(F.sequence(F.expr("first div source_size"), F.expr("(last - 1) div source_size")))
    laps = schedule.withColumn("_lap", lap).select(
        "slot", "source_no",
        F.greatest(F.col("first") - F.col("_lap") * F.col("source_size"), F.lit(0)).alias("_a"),
        F.least(F.col("last") - F.col("_lap") * F.col("source_size"), "source_size").alias("_b"),
    )

    def cells(first: str, last: str) -> Column:
        return F.sequence(F.expr(f"{first} div {block_words}"), F.expr(f"({last} - 1) div {block_words}"))

    numbered = sized.join(sources.select("source_key", "source_no", "source_size", "target"), "source_key")
    placed = ranked(
        numbered, ["source_no"], "order", key_shift(rows), ["carry", "size"], "size"
    ).withColumn("_end", F.col("start") + F.col("size"))
    slots_by_cell = laps.withColumn("_cell", F.explode(cells("_a", "_b")))
    doc_cells = F.when(F.col("size") > 0, cells("start", "_end"))
    by_cell = placed.withColumn("_cell", F.explode_outer(doc_cells))
    low = F.greatest("_a", "start", F.col("_cell") * block)
    # least() skips nulls: a cell that no slot takes must be told apart.
    overlap = F.when(F.col("_b").isNotNull(), F.least("_b", "_end", (F.col("_cell") + 1) * block) - low)
    met = by_cell.join(slots_by_cell, ["source_no", "_cell"], "left").withColumn("n_words", overlap)
    documents = (
        met.groupBy("source_no", "rank", "carry", "size", "source_size", "target")
        .agg(F.coalesce(F.sum(F.when(F.col("n_words") > 0, F.col("n_words"))), F.lit(0)).alias("taken"))
        .select("carry", "size", "source_size", "target", "taken")
    )
    pieces = met.filter("n_words > 0").select(
        "slot", "carry", (low - F.col("start")).alias("doc_first"), "n_words"
    )
    return Mixture(sources, schedule.select("slot", "source_no", "block", "first", "last"), pieces, documents)


def mixed_documents(docs: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """The input rows, each as often as the mix takes it to the nearest whole number: 0 to
    ``MAX_REPEATS`` times. Rows without words have no part in the shares and stay as they are."""
    named = with_row_id(docs)
    narrow = named.select(
        "rid", "digest", F.col(f"row.`{text}`").alias("text"), F.col(f"row.`{source}`").alias("source")
    )
    times = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.floor(F.col("taken") / F.col("size") + 0.5))
    # Which of two equal rows is taken makes no difference; all others are told apart by content.
    taken = mix(narrow, ["digest", "rid"], order_by=["digest"]).documents.select(
        F.col("carry.rid").alias("rid"), times.cast("int").alias("times")
    )
    return (
        named.join(taken.filter("times > 0"), "rid")
        .select("row", F.explode(F.array_repeat(F.lit(0), F.col("times"))))
        .select("row.*")
    )
