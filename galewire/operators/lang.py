"""Language tags: a cascade over detectors, and a trainable n-gram detector.

A detector turns a text column into ``struct<lang: string, confidence: double>``; null texts give
null. Detectors run in the row, so tagging shuffles nothing.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galewire.functions.text import chunks, stripped_length_is
from galewire.operators.joins import lookup_join
from galewire.sources.scratch import materialize

Detector = Callable[[Column], Column]

# Cascade thresholds and fallback confidences.
MIN_TEXT_LENGTH = 10
MIN_CONFIDENCE = 0.5
SHORT_TEXT_CONFIDENCE = 0.5
FALLBACK_CONFIDENCE = 0.3

# The log-probability (in thousandths, like all weights here) of an n-gram outside the profile.
FLOOR = -12000
# Rows of a profile table that travels with a function, at most.
CARRIED_ROWS = 2_000_000
# Counted trigrams that a task holds before it hands them on.
HELD_GRAMS = 1_000_000

PRIMARY_METHOD = "ngram_profile"
SECONDARY_METHOD = "second_detector"
DETECTED = T.StructType().add("lang", T.StringType()).add("confidence", T.DoubleType())


# Three characters from every position on; the look-ahead takes no character away, and a position
# inside a surrogate pair does not count.
TRIGRAM = r"(?s)(?=\P{Cs})(?=(...))"


def char_trigrams(text: Column) -> Column:
    """All overlapping three-character pieces of the whole text, lower-cased."""
    return F.regexp_extract_all(F.lower(text), F.lit(TRIGRAM), F.lit(1))


def _gram_code(a, b, c):
    """One number for three code points of 21 bits each."""
    return (a << 42) | (b << 21) | c


def _gram_text(code: int) -> str:
    low = (1 << 21) - 1
    return chr(code >> 42) + chr(code >> 21 & low) + chr(code & low)


def _gram_runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The trigrams of texts taken together: their codes, and the number of the text each is in."""
    joined = "".join(texts).encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(joined, np.uint32).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    inside = owner[:-2] == owner[2:]
    return _gram_code(points[:-2], points[1:-1], points[2:])[inside], owner[:-2][inside]


def _long_texts(batch: pa.RecordBatch, text: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The rows whose text has a trigram, in runs of some hundred thousand characters: only one run at a time is
    taken out of Arrow's memory, whatever the size of the batch."""
    long = batch.filter(pc.fill_null(pc.greater(pc.utf8_length(batch.column(text)), 2), False))
    for run in chunks(pc.utf8_length(long.column(text)).to_pylist()):
        part = long.slice(run.start, run.stop - run.start)
        yield part, part.column(text).to_pylist()


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of the texts a task reads, each gram of a language once or a few times."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def compact() -> int:
        for lang, parts in held.items():
            codes, back = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
            n = np.bincount(back, np.concatenate([n for _, n in parts]), len(codes)).astype(np.int64)
            held[lang] = [(codes, n)]
        return sum(len(parts[0][0]) for parts in held.values())

    def out() -> Iterator[pa.RecordBatch]:
        compact()
        for lang, ((codes, n),) in held.items():
            grams = [_gram_text(c) for c in codes.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.string()), pa.array(n)],
                names=["lang", "gram", "n"],
            )
        held.clear()

    waiting = 0
    for batch in batches:
        named = batch.filter(pc.is_valid(batch.column("lang")))
        for part, texts in _long_texts(named, "text"):
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(part.column("lang").to_pylist(), texts):
                by_lang.setdefault(lang, []).append(text)
            for lang, own in by_lang.items():
                found, n = np.unique(_gram_runs(own)[0], return_counts=True)
                held.setdefault(lang, []).append((found, n))
                waiting += len(found)
            if waiting > HELD_GRAMS:
                waiting = compact()
                if waiting > HELD_GRAMS // 2:
                    yield from out()
                    waiting = 0
    yield from out()
    pa.default_memory_pool().release_unused()  # the worker stays for other tasks


def train_profiles(labelled: DataFrame, size: int | None = None) -> DataFrame:
    """Trigrams per language with their weight, from (text, lang) rows: all of them, or the
    ``size`` most frequent where a model of fixed size is wanted.

    A trigram is three code points in a row of the lower-cased text, at every position. They are
    counted in the task that reads the texts, so what is shuffled grows with the distinct trigrams
    of a task, not with its characters. Rows without text or language teach nothing.
    """
    counts = (
        labelled.select("lang", F.lower("text").alias("text"))
        .mapInArrow(_count_grams, "lang string, gram string, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    top = counts
    if size is not None:
        rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
        top = counts.withColumn("rank", rank).where(F.col("rank") <= size)
    log_p = F.round(F.log(F.col("n") / F.col("total")) * 1000).cast("long")
    return top.join(totals, "lang").select("lang", "gram", (log_p - FLOOR).alias("weight"))


def _gram_codes(grams: list[str]) -> np.ndarray:
    points = np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    a, b, c = points.reshape(-1, 3).T
    return _gram_code(a, b, c)


MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
# Weights that are added up together, at most.
ADDED = 1 << 18


def _slots(codes: np.ndarray, bits: int) -> np.ndarray:
    return (codes.astype(np.uint64) * MULTIPLIER >> np.uint64(64 - bits)).astype(np.int64)


def _gram_slots(grams: np.ndarray) -> np.ndarray:
    """A table of some four slots to a gram: in the slot of a gram its place, or that of another one."""
    bits = max(4, (4 * len(grams)).bit_length())
    table = np.full(1 << bits, len(grams), np.int32)
    table[_slots(grams, bits)] = np.arange(len(grams))
    return table


def _gram_places(seen: np.ndarray, grams: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The place of each code among the sorted grams, their number if it is none of them. Most are
    found in their slot; where that holds another gram the sorted array is searched."""
    none = len(grams)
    places = table[_slots(seen, len(table).bit_length() - 1)]
    other = np.flatnonzero(np.append(grams, -1)[places] != seen)
    other = other[places[other] < none]
    if len(other):
        at = np.minimum(np.searchsorted(grams, seen[other]), none - 1)
        places[other] = np.where(grams[at] == seen[other], at, none)
    return places


def profile_detector(profiles: DataFrame, most: int = CARRIED_ROWS) -> Detector:
    """Naive Bayes over the trigram profiles.

    The profiles travel with the function, so they may have ``most`` rows at most (some megabytes);
    ``profile_language`` takes tables of any size. The trigrams of a text are looked up together in
    a table of slots; exploding them into rows costs ten times the CPU. Weights are whole
    numbers: sums are exact in any order.
    """
    rows = profiles.select("lang", "gram", "weight").limit(most + 1).toArrow()
    if len(rows) > most:
        raise ValueError(f"profiles of over {most} rows are not carried: use profile_language")
    names = rows.column("lang").to_pylist()
    langs = sorted(set(names))
    codes = _gram_codes(rows.column("gram").to_pylist())
    grams = np.unique(codes)
    # The last row is for trigrams of no profile.
    weights = np.zeros((len(grams) + 1, len(langs)), dtype=np.int64)
    place = {name: k for k, name in enumerate(langs)}
    weights[np.searchsorted(grams, codes), [place[n] for n in names]] = rows.column("weight").to_numpy()
    table = _gram_slots(grams)

    def scored(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Best language (-1: none) and its probability, for texts taken together."""
        seen, owner = _gram_runs(texts)
        at = _gram_places(seen, grams, table)
        # Sums of whole numbers, a piece of the texts at a time: exact in any order.
        scores = np.zeros((len(texts), len(langs)), np.int64)
        step = -(-ADDED // len(langs))
        for start in range(0, len(at), step):
            own = owner[start : start + step]
            first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            scores[own[first]] += np.add.reduceat(weights[at[start : start + step]], first, axis=0)
        known = np.where(scores != 0, scores, -np.inf)
        # Of equal scores the last language in order wins.
        top = len(langs) - 1 - np.argmax(known[:, ::-1], axis=1)
        best = known[np.arange(len(texts)), top]
        found = np.isfinite(best)
        odds = np.exp((known - np.where(found, best, 0)[:, None]) / 1000.0).sum(axis=1)
        return np.where(found, top, -1), np.where(found, odds, np.nan)

    @F.arrow_udf(DETECTED)
    def detect(texts: pa.Array) -> pa.Array:
        numbered = pa.RecordBatch.from_arrays([texts, pa.array(np.arange(len(texts)))], names=["text", "at"])
        names, sure = np.full(len(texts), None, object), np.full(len(texts), np.nan)
        for part, own in _long_texts(numbered, "text") if langs else ():
            at = part.column("at").to_numpy()
            top, odds = scored(own)
            names[at] = np.array([*langs, None], object)[top]
            sure[at] = 1.0 / odds
        confidence = pa.array(sure, pa.float64(), from_pandas=True)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), confidence], names=["lang", "confidence"])

    def detector(text: Column) -> Column:
        found = detect(F.lower(text))
        return F.struct(
            found["lang"].alias("lang"), F.round(found["confidence"], 3).alias("confidence")
        )

    return detector


# Rows of a profile table that a task holds at a time, where it does not travel with a function, and
# in how many parts the texts are dealt to each part of the table.
HELD_ROWS = 1_000_000
SALTS = 64

PACKED = "bucket int, salt int, of_text boolean, lang string, keys binary, codes binary, owners binary, numbers binary"
KEY = 32  # bytes of a text's digest


def _packed(bucket: int, salt: int, codes: np.ndarray, numbers: np.ndarray, lang=None, keys=b"", owners=None):
    of_text = owners is not None
    parts = [codes.astype(np.int64).tobytes(), owners.astype(np.int32).tobytes() if of_text else b"",
             numbers.astype(np.int64).tobytes()]
    kinds = [pa.int32(), pa.int32(), pa.bool_(), pa.string(), *[pa.binary()] * 4]
    values = [bucket, salt, of_text, lang, keys, *parts]
    names = ["bucket", "salt", "of_text", "lang", "keys", "codes", "owners", "numbers"]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=names)


def _bucket_of(codes: np.ndarray, buckets: int) -> np.ndarray:
    return (codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(buckets)


def _pack_profiles(buckets: int, salts: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            codes, weights = _gram_codes(batch.column("gram").to_pylist()), batch.column("weight").to_numpy()
            where = _bucket_of(codes, buckets)
            for lang in sorted(set(langs.tolist())):
                for bucket in np.unique(where[langs == lang]).tolist():
                    own = (langs == lang) & (where == bucket)
                    for salt in range(salts):
                        yield _packed(bucket, salt, codes[own], weights[own], lang)

    return pack


def _pack_texts(buckets: int, salts: int):
    """The distinct trigrams of each text with their numbers, a row per run of texts and bucket."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, own in _long_texts(batch, "_text"):
                seen, owner = _gram_runs(own)
                grams, place = np.unique(seen, return_inverse=True)
                pairs, n = np.unique(owner * len(grams) + place, return_counts=True)
                codes, owner = grams[pairs % len(grams)], pairs // len(grams)
                where = _bucket_of(codes, buckets)
                digests = b"".join(part.column("_text_key").to_pylist())
                salt = int.from_bytes(digests[:4], "little") % salts
                for bucket in np.unique(where).tolist():
                    at = where == bucket
                    yield _packed(bucket, salt, codes[at], n[at], None, digests, owner[at])

    return pack


def _score_packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per text and language from one sorted stream: of each bucket its part of the profiles
    comes first, is held, and the texts pass by it."""
    at, learned, tables = None, {}, None
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            codes, numbers = np.frombuffer(row["codes"], np.int64), np.frombuffer(row["numbers"], np.int64)
            if (row["bucket"], row["salt"]) != at:
                at, learned, tables = (row["bucket"], row["salt"]), {}, None
            if not row["of_text"]:
                learned.setdefault(row["lang"], []).append((codes, numbers))
                continue
            if tables is None:
                tables = {}
                for lang in list(learned):
                    parts = learned.pop(lang)
                    grams, weights = (np.concatenate(x) for x in zip(*parts))
                    order = np.argsort(grams)
                    tables[lang] = grams[order], weights[order]
            owner, keys = np.frombuffer(row["owners"], np.int32), row["keys"]
            for lang, (grams, weights) in tables.items():
                found = np.minimum(np.searchsorted(grams, codes), len(grams) - 1)
                hit = grams[found] == codes
                # Whole numbers, added as such: exact in any order.
                sums = np.zeros(len(keys) // KEY, np.int64)
                np.add.at(sums, owner[hit], numbers[hit] * weights[found[hit]])
                some = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([keys[k * KEY : k * KEY + KEY] for k in some.tolist()], pa.binary()),
                     pa.array([lang] * len(some), pa.string()), pa.array(sums[some])],
                    names=["_text_key", "lang", "part"],
                )


def profile_language(
    df: DataFrame, profiles: DataFrame, name: str = "detected", text: str = "text_clean", held: int = HELD_ROWS
) -> DataFrame:
    """``df`` with the answer of ``profile_detector`` under ``name``, for profiles of any size.

    Profiles and the distinct trigrams of the texts meet by buckets of trigrams, of about ``held``
    profile rows each. The trigrams of a run of texts travel packed, one row for each bucket; a task
    holds one bucket of the profiles while the texts pass by, and hands on a sum per text and language.
    Answers belong to texts: each is scored once and found again by its digest. Texts and profiles are
    written once to the shared folder, as both are read twice.
    """
    keyed = materialize(df.withColumn("_text_key", F.unhex(F.sha2(text, 256))), "keyed")
    table = materialize(profiles.select("lang", "gram", "weight"), "profiles")
    buckets = -(-table.count() // held) or 1
    texts = keyed.where("_text_key IS NOT NULL").groupBy("_text_key").agg(F.lower(F.min(text)).alias("_text"))
    packed = table.mapInArrow(_pack_profiles(buckets, SALTS), PACKED).unionByName(
        texts.mapInArrow(_pack_texts(buckets, SALTS), PACKED)
    )
    dealt = packed.repartition("bucket", "salt").sortWithinPartitions("bucket", "salt", "of_text")
    sums = (
        dealt.mapInArrow(_score_packed, "_text_key binary, lang string, part long")
        .groupBy("_text_key", "lang").agg(F.sum("part").alias("_score"))
        .where("_score <> 0")
    )
    own = Window.partitionBy("_text_key")
    best = (
        sums.withColumn("_top", F.max(F.struct("_score", "lang")).over(own))
        .groupBy("_text_key", F.col("_top.lang").alias("_lang"))
        .agg(F.sum(F.exp((F.col("_score") - F.col("_top._score")) / 1000.0)).alias("_odds"))
    )
    answer = F.struct(F.col("_lang").alias("lang"), F.round(1 / F.col("_odds"), 3).alias("confidence"))
    return lookup_join(keyed, best, ["_text_key"], spread="tweet_id").withColumn(name, answer).drop(
        "_text_key", "_lang", "_odds"
    )


def detect_language(
    df: DataFrame, primary: Detector | None = None, secondary: Detector | None = None
) -> DataFrame:
    """Language, confidence and method per post, from text_clean and the given lang.

    Short texts keep the given language and reach no detector; then the first detector if it is
    sure enough; then the second detector; then the given language again.
    """
    given = F.coalesce("lang", F.lit("unknown"))
    short = ~stripped_length_is(F.coalesce("text_clean", F.lit("")), MIN_TEXT_LENGTH)
    out = df.withColumn("_long", F.when(~short, F.col("text_clean")))
    choice = F.when(F.col("_long").isNull(), _tag(given, SHORT_TEXT_CONFIDENCE, "twitter_short_text"))
    if primary is not None:
        out = out.withColumn("_first", primary(F.col("_long")))
        sure = F.col("_first.confidence") >= MIN_CONFIDENCE
        choice = choice.when(sure, _tag("_first.lang", "_first.confidence", PRIMARY_METHOD))
        out = out.withColumn("_open", F.when(~F.coalesce(sure, F.lit(False)), F.col("_long")))
    if secondary is not None:
        rest = "_long" if primary is None else "_open"
        out = out.withColumn("_second", secondary(F.col(rest)))
        known = F.col("_second.lang").isNotNull()
        choice = choice.when(known, _tag("_second.lang", "_second.confidence", SECONDARY_METHOD))
    choice = choice.otherwise(_tag(given, FALLBACK_CONFIDENCE, "twitter_fallback"))
    return (
        out.withColumn("_tag", choice)
        .withColumns(
            {
                "detected_lang": F.col("_tag.lang"),
                "lang_confidence": F.col("_tag.confidence"),
                "lang_method": F.col("_tag.method"),
                "processing_stage": F.lit("lang_detected"),
            }
        )
        .drop("_tag", "_long", "_open", "_first", "_second")
    )


def _tag(lang: Column | str, confidence: float | str, method: str) -> Column:
    sure = F.col(confidence) if isinstance(confidence, str) else F.lit(confidence)
    name = F.col(lang) if isinstance(lang, str) else lang
    return F.struct(
        name.alias("lang"), sure.alias("confidence"), F.lit(method).alias("method")
    )
