"""Phrases of two to four words by SON partitioning, scored by how their parts hold together.

A phrase with ``least`` occurrences in a language has at least its proportional share of them in one
of ``SHARDS`` shards of the corpus. So each shard is mined completely for phrases of that lower
support, the locally frequent phrases of all shards are united, and every one of them is counted over
all shards exactly. A shard is a set of slices of coded text; its mining is a grouping over slices,
not the work of one task, so the support is lowered by the number of shards, whatever the size.

Mining goes by length: a phrase is looked at only where the two phrases it is made of by leaving out
its last or first word were frequent themselves. Between the levels frequent phrases travel as 48-bit
hashes in a Bloom filter of at most ``TABLE_BITS`` bits (16 MB), the only thing that is broadcast: a
full filter lets more phrases through, none is lost. The last pass counts the phrases themselves, so
hashes decide nothing.

Texts are split into words once and written as word numbers of a slice with its word list; the
passes read these. A slice has about ``SLICE_WORDS`` words, so no row of the table is large, and what
a pass counts is added up over the slices of a task, up to ``HELD_ROWS`` rows, before it leaves it.

Defined results: null and empty texts have no words; a null language is ``und``; repeated rows count
each time; ties are broken by the order stated; an empty table gives no rows. A text is never cut, so
a slice is as long as its longest text.
"""

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galewire.sources.scratch import materialize, scratch_path

LEAST = 30
LONGEST = 4
SHARDS = 10
SLICE_WORDS = 1 << 18
SLICE_SPELLED = 3 << 14  # different words after which a slice ends, to stay below 1 << 16 mostly
TEXT_BYTES = 1 << 19  # texts split at once
HELD_ROWS = 1 << 20
BUCKET_WORDS = 1 << 21
TABLE_BITS = 1 << 27
PROBES, STEP = 4, 7
KEY_SHIFT = 16  # hashes travel as their first 48 bits
CLOSED_PERCENT = 80
SCORE_UNIT = 2_000_000
TOP = 2000
UNKNOWN = "und"
SEED = 47

BREAK = b"\xff"  # no byte of UTF-8
TABLE = bytes.maketrans(
    bytes(range(65, 91)) + b".,;:!?\n\x0b\x0c\r", bytes(range(97, 123)) + BREAK * 10
)


# ---------------------------------------------------------------- coded slices


class _Numbers(dict):
    """Word numbers in order of first use; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def tokens(texts: list[bytes]) -> list[bytes]:
    """The words of texts, with a break after each piece."""
    return BREAK.join([*texts, b""]).translate(TABLE).replace(BREAK, b" \xff ").split()


CODED = "shard int, lang string, n_words long, words string, codes binary"


def code_type(spelled: int) -> type:
    """Of the word numbers of a slice with so many different words."""
    return np.uint16 if spelled < 1 << 16 else np.int32


def coded(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Slices of one language each, written once: different words joined by spaces, word numbers, and
    their shard."""

    def sliced(shard: int, lang: str, numbers: _Numbers, codes: list[np.ndarray]) -> pa.RecordBatch:
        flat = np.concatenate(codes)
        words = b" ".join(list(numbers)[1:])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([shard], pa.int32()), pa.array([lang]), pa.array([int(np.count_nonzero(flat))]),
                pc.cast(pa.array([words], pa.binary()), pa.string()),
                pa.array([flat.astype(code_type(len(numbers) - 1)).tobytes()], pa.binary()),
            ],
            names=["shard", "lang", "n_words", "words", "codes"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() % SHARDS
        waiting: dict[str, list] = {}  # texts to be split, and their bytes
        held: dict[str, list] = {}  # word numbers, codes, and how many

        def split(name: str) -> None:
            found = tokens(waiting.pop(name)[0])
            part = held.setdefault(name, [_Numbers(), [], 0])
            part[1].append(np.fromiter(map(part[0].__getitem__, found), np.int32, len(found)))
            part[2] += len(found)

        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                batch = whole.slice(first, 256)
                texts = pc.cast(batch.column("text"), pa.binary())
                for name, value in zip(batch.column("lang").to_pylist(), texts):
                    some, value = waiting.setdefault(name, [[], 0]), value.as_py() or b""
                    some[0].append(value)
                    some[1] += len(value)
                    if some[1] >= TEXT_BYTES:
                        split(name)
                        if held[name][2] >= SLICE_WORDS or len(held[name][0]) >= SLICE_SPELLED:
                            yield sliced(shard, name, *held.pop(name)[:2])
        for name in list(waiting):
            split(name)
        for name, (numbers, codes, _) in held.items():
            yield sliced(shard, name, numbers, codes)

    source = docs.select(
        F.coalesce(F.col(f"`{lang}`"), F.lit(UNKNOWN)).alias("lang"), F.col(f"`{text}`").alias("text")
    )
    path = scratch_path(docs.sparkSession, "phrases-coded")
    # A reader holds a row group: these are small, and the writer looks at its size every few rows.
    source.mapInArrow(run, CODED).write.options(**{
        "parquet.block.size": 4 << 20, "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 4,
        "parquet.page.size.row.check.min": 1, "parquet.enable.dictionary": "false",
    }).parquet(path)
    return docs.sparkSession.read.schema(CODED).parquet(path)


# ---------------------------------------------------------------- candidates as bits


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Bits:
    """A Bloom filter of hashes: has all that were put in, and a few others. The places of a hash are
    ``PROBES`` runs of its own bits, ``size`` bits long and ``STEP`` apart."""

    size: int
    words: np.ndarray

    def has(self, keys: np.ndarray) -> np.ndarray:
        left = np.arange(len(keys))
        for probe in range(PROBES):
            at = (keys[left] >> np.uint64(probe * STEP)) & np.uint64((1 << self.size) - 1)
            bit = self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))
            left = left[bit & np.uint64(1) == 1]
        found = np.zeros(len(keys), bool)
        found[left] = True
        return found


def bit_table(keys: DataFrame) -> Bits:
    """The filter of a written table of hashes ``key``; 16 bits or more for each, up to ``TABLE_BITS``."""
    n = keys.count()
    size = max(10, min(int(math.log2(TABLE_BITS)), math.ceil(math.log2(16 * max(n, 1)))))
    mask = F.lit((1 << size) - 1)
    places = F.array(*[F.shiftrightunsigned("key", p * STEP).bitwiseAND(mask) for p in range(PROBES)])
    one = F.expr("shiftleft(1L, CAST(_at & 63 AS INT))")
    packed = keys.select(F.explode(places).alias("_at")).groupBy(F.shiftright("_at", 6).alias("at")).agg(
        F.bit_or(one).alias("bits")
    )
    words = np.zeros(1 << (size - 6), np.uint64)
    found = packed.toArrow()  # at most TABLE_BITS / 64 rows
    words[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return Bits(size, words)


class Slice:
    """A slice's places and the hashes of the phrases that start there."""

    def __init__(self, lang: str, words: str, codes: bytes):
        spelled = words.encode().split(b" ") if words else []
        self.words = pc.cast(pa.array(spelled, pa.binary()), pa.string())
        self.codes = np.frombuffer(codes, code_type(len(spelled)))
        seed = xxhash.xxh64_intdigest(lang.encode(), SEED)
        digest = xxhash.xxh64_intdigest
        self.word_keys = np.fromiter((digest(w, seed) for w in spelled), np.uint64, len(spelled))

    def places(self, tables: list[Bits], length: int) -> tuple[np.ndarray, np.ndarray]:
        """Where phrases of ``length`` words start all whose shorter parts are in the tables, of one
        word, two and so on, and the hashes of these phrases."""
        known = np.concatenate(([False], tables[0].has(self.word_keys >> np.uint64(KEY_SHIFT))))
        keys = np.concatenate(([np.uint64(0)], self.word_keys))
        at = np.flatnonzero(known[self.codes])
        key = keys[self.codes[at]]
        for k in range(2, length + 1):
            pair = np.flatnonzero(at[1:] == at[:-1] + 1)
            at = at[pair]
            key = _mixed(key[pair] * np.uint64(0x9E3779B97F4A7C15) + keys[self.codes[at + k - 1]])
            if k <= len(tables):
                good = tables[k - 1].has(key >> np.uint64(KEY_SHIFT))
                at, key = at[good], key[good]
        return at, key

    def counted(self, at: np.ndarray, length: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """The distinct phrases of ``length`` words that start at these places: the index of one place
        of each, its words, and how often it is there."""
        dense = self.codes[at].astype(np.int64)
        for k in range(1, length):
            dense = dense * (len(self.words) + 1) + self.codes[at + k]
            if k < length - 1:
                dense = np.unique(dense, return_inverse=True)[1]
        _, first, n = np.unique(dense, return_index=True, return_counts=True)
        parts = [self.words.take(pa.array(self.codes[at[first] + k] - 1)) for k in range(length)]
        return first, pc.binary_join_element_wise(*parts, " "), n


Columns = list[np.ndarray | pa.Array]


def _added_keys(parts: list[Columns]) -> Columns:
    """key, n of parts that have them, none empty: each key once, in order. The parts are let go."""
    if len(parts) == 1:
        return parts[0]
    key, n = (np.concatenate(x) for x in zip(*parts))
    parts.clear()
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    del order
    edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return [key[edge], np.add.reduceat(n, edge)]


def _added_phrases(parts: list[Columns]) -> Columns:
    """phrase, n and what depends on the phrase, of parts that have them: each phrase once."""
    if len(parts) == 1:
        return parts[0]
    names = [f"c{i}" for i in range(len(parts[0]))]
    table = pa.concat_tables([pa.table(dict(zip(names, part))) for part in parts])
    found = table.group_by([x for x in names if x != "c1"], use_threads=False).aggregate([("c1", "sum")])
    return [found.column("c1_sum" if x == "c1" else x).combine_chunks() for x in names]


def _over_slices(
    slices: DataFrame, body: Callable[[Slice], Columns], add: Callable[[list[Columns]], Columns], schema: str,
    names: list[str], packed: Callable[[Columns], Columns] = list,
) -> DataFrame:
    """Rows (shard, lang and what ``body`` counts in the slices), added up in a task by ``add`` while they
    are few enough; they leave it as ``packed`` makes them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, str], list[Columns]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            while held:
                (shard, lang), parts = held.popitem()
                columns = packed(add(parts))
                for first in range(0, len(columns[0]), 1 << 16):
                    some = [c[first : first + (1 << 16)] for c in columns]
                    n = len(some[0])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, shard, np.int32)), pa.array([lang] * n, pa.string()),
                         *(pa.array(c) if isinstance(c, np.ndarray) else c for c in some)],
                        names=["shard", "lang", *names],
                    )

        rows = 0
        for batch in batches:
            for k in range(batch.num_rows):
                shard, lang = batch.column("shard")[k].as_py(), batch.column("lang")[k].as_py()
                part = body(Slice(lang, batch.column("words")[k].as_py(), batch.column("codes")[k].as_buffer()))
                if len(part[0]):
                    held.setdefault((shard, lang), []).append(part)
                rows += len(part[0])
                if rows >= HELD_ROWS:
                    for at, parts in held.items():
                        held[at] = [add(parts)]
                    rows = sum(len(parts[0][0]) for parts in held.values())
                    if rows >= HELD_ROWS * 3 // 4:
                        yield from out()
                        rows = 0
        yield from out()
        pa.default_memory_pool().release_unused()  # the worker stays for other tasks

    return slices.select("shard", "lang", "words", "codes").mapInArrow(run, f"shard int, lang string, {schema}")


# ---------------------------------------------------------------- mining


@dataclass(frozen=True)
class Mined:
    totals: DataFrame  # lang, n: all word occurrences
    words: DataFrame  # lang, phrase, f: words with the support
    phrases: DataFrame  # lang, phrase, f, length: phrases of two words or more with the support


def local_supports(sizes: DataFrame, least: int) -> DataFrame:
    """lang, shard, support: the share of ``least`` that a shard has of its language, rounded up."""
    total = F.sum("n_words").over(Window.partitionBy("lang"))
    support = F.greatest(F.lit(1), F.ceil(F.lit(least) * F.col("n_words") / total)).cast("long")
    return sizes.select("lang", "shard", support.alias("support"))


def united(reported: DataFrame, supports: DataFrame, least: int) -> DataFrame:
    """``key`` of the phrases that are frequent in a shard, and in all shards together, from rows
    (shard, lang, key, n) of slices. One exchange: what all shards hold of a phrase lies together."""
    per_shard = reported.repartition("key").groupBy("key", "lang", "shard").agg(F.sum("n").alias("n"))
    return (
        per_shard.join(supports, ["lang", "shard"])
        .groupBy("key", "lang").agg(F.max(F.col("n") >= F.col("support")).alias("local"), F.sum("n").alias("n"))
        .filter("local").filter(F.col("n") >= least).select("key")
    )


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST) -> Mined:
    """All phrases of up to ``longest`` words with at least ``least`` occurrences in a language."""
    spark = docs.sparkSession
    slices = coded(docs, text, lang)
    sizes = materialize(
        slices.groupBy("lang", "shard").agg(F.sum("n_words").alias("n_words")), "phrase-shards"
    )
    supports = materialize(local_supports(sizes.filter("n_words > 0"), least), "phrase-supports")
    totals = sizes.groupBy("lang").agg(F.sum("n_words").alias("n"))

    def word_counts(part: Slice) -> Columns:
        n = np.bincount(part.codes, minlength=len(part.words) + 1)[1:]
        return [part.words, n.astype(np.int64)]

    words = materialize(
        _over_slices(slices, word_counts, _added_phrases, "phrase string, f long", ["phrase", "f"])
        .groupBy("lang", "phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= least),
        "phrase-words",
    )

    def word_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds: dict[str, int] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            seeds |= {x: xxhash.xxh64_intdigest(x.encode(), SEED) for x in set(langs) - set(seeds)}
            spelled = pc.cast(batch.column("phrase"), pa.binary()).to_pylist()
            keys = [xxhash.xxh64_intdigest(w, seeds[x]) for x, w in zip(langs, spelled)]
            short = np.array(keys, np.uint64) >> np.uint64(KEY_SHIFT)
            yield pa.RecordBatch.from_arrays([pa.array(short.view(np.int64))], names=["key"])

    tables = [bit_table(materialize(words.select("lang", "phrase").mapInArrow(word_keys, "key long"), "phrase-keys"))]
    for length in range(2, longest + 1):
        sent = spark.sparkContext.broadcast(tables)

        def local(part: Slice, length: int = length, sent=sent) -> Columns:
            key, n = np.unique(part.places(sent.value, length)[1] >> np.uint64(KEY_SHIFT), return_counts=True)
            return [key.view(np.int64), n.astype(np.int64)]

        reported = _over_slices(slices, local, _added_keys, "key long, n long", ["key", "n"])
        tables = [*tables, bit_table(materialize(united(reported, supports, least), "phrase-keys"))]

    sent = spark.sparkContext.broadcast(tables)

    # Phrases leave a task in one row for each bucket of hashes; a bucket holds about what BUCKET_WORDS
    # words have, however many words there are.
    buckets = max(1, (sizes.agg(F.sum("n_words")).first()[0] or 0) // BUCKET_WORDS)

    def exact(part: Slice) -> Columns:
        phrases, counts, lengths, keys = [], [], [], []
        for length in range(2, longest + 1):
            at, key = part.places(sent.value[:length], length)
            first, phrase, n = part.counted(at, length)
            phrases.append(phrase)
            counts.append(n)
            lengths.append(np.full(len(n), length, np.int32))
            keys.append((key[first] % np.uint64(buckets)).astype(np.int32))
        return [pa.concat_arrays(phrases), *(pa.array(np.concatenate(x)) for x in (counts, lengths, keys))]

    def by_bucket(columns: Columns) -> Columns:
        # In order of their words, phrases that lie together share their beginnings.
        bucket, words = columns[3].to_numpy(), pc.sort_indices(columns[0]).to_numpy()
        order = words[np.argsort(bucket[words], kind="stable")]
        edge = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        offsets = pa.array(np.append(edge, len(order)).astype(np.int32))
        flat = [c.take(pa.array(order)) for c in columns[:3]]
        return [bucket[order[edge]], *(pa.ListArray.from_arrays(offsets, c) for c in flat)]

    def added(group: pa.Table) -> pa.Table:
        flat = pa.table({c: pc.list_flatten(group.column(c)) for c in ("phrase", "f", "length")})
        total = flat.group_by(["phrase", "length"]).aggregate([("f", "sum")])
        total = total.filter(pc.greater_equal(total.column("f_sum"), least))
        lang = pa.array([group.column("lang")[0].as_py()] * len(total), pa.string())
        return pa.table({"lang": lang, "phrase": total.column("phrase"), "f": total.column("f_sum"), "length": total.column("length")})

    packed = _over_slices(
        slices, exact, _added_phrases, "bucket int, phrase array<string>, f array<long>, length array<int>",
        ["bucket", "phrase", "f", "length"], by_bucket,
    ).drop("shard")
    phrases = materialize(
        packed.groupBy("lang", "bucket").applyInArrow(added, "lang string, phrase string, f long, length int"), "phrases"
    )
    return Mined(totals, words, phrases)


# ---------------------------------------------------------------- scores


def _part(first: Column, n: Column) -> Column:
    return F.array_join(F.slice("_words", first, n), " ")


def scored(mined: Mined) -> DataFrame:
    """lang, phrase, a, l, r, score for every phrase: the cut that holds it together least."""
    counts = mined.words.select("lang", "phrase", "f").unionByName(mined.phrases.select("lang", "phrase", "f"))
    cut = (
        mined.phrases.withColumn("_words", F.split("phrase", " "))
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("length") - 1)))
        .select(
            "lang", "phrase", F.col("f").alias("a"), "k",
            _part(F.lit(1), F.col("k")).alias("left"), _part(F.col("k") + 1, F.col("length") - F.col("k")).alias("right"),
        )
    )
    for side, name in (("left", "l"), ("right", "r")):
        cut = cut.join(counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    whole = F.expr(f"CAST(a AS DECIMAL(20, 0)) * {SCORE_UNIT} div CAST(l + r AS DECIMAL(20, 0))")
    least = F.min(F.struct(whole.cast("long").alias("score"), "k", "l", "r")).alias("least")
    return cut.groupBy("lang", "phrase", "a").agg(least).select(
        "lang", "phrase", "a", "least.l", "least.r", "least.score"
    )


def unclosed(mined: Mined, percent: int = CLOSED_PERCENT) -> DataFrame:
    """lang, phrase of those that a longer phrase around them accounts for nearly always."""
    inner = F.col("length") - F.col("n") + 1
    inside = (
        mined.phrases.filter("length > 2").withColumn("_words", F.split("phrase", " "))
        .withColumn("n", F.explode(F.sequence(F.lit(2), F.col("length") - 1)))
        .withColumn("at", F.explode(F.sequence(F.lit(1), inner)))
        .select("lang", _part(F.col("at"), F.col("n")).alias("phrase"), F.col("f").alias("longer"))
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    )
    decimal = "CAST({} AS DECIMAL(20, 0))".format
    return mined.phrases.join(inside, ["lang", "phrase"]).filter(
        f"100 * {decimal('longer')} >= {percent} * {decimal('f')}"
    ).select("lang", "phrase")


def top_phrases(mined: Mined, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best of each language."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        scored(mined).join(unclosed(mined), ["lang", "phrase"], "left_anti")
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        .join(mined.totals, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
