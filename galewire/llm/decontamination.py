"""Benchmark decontamination with suffix arrays of the training text.

The documents are read in shards (some megabytes of text within one task). Each shard gets a
suffix array over its words; every suffix of every test item is binary-searched in it, word by
word and for all suffixes at once, which gives its longest verbatim match, where it lies, and all
places that hold its first window. A document lies whole in one shard, so its verdict needs no
shuffle, and a lost task repeats its own shards only.

The array leaves out suffixes that no window can begin at: those in a run of words, each known to
some test item, that is shorter than the shortest window. Nothing found is lost by that.

Test items are held by the tasks in blocks of at most ``block_bytes`` of text (or one item, if that
is longer), and one block at a time passes the driver; further blocks are further passes over the same
rows, whose findings are written in between, so a test set of any size is searched whole.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lowered. Defined results:
null and empty texts have no words and are never hit; items without words match nothing; rows that
share an item_id count as one item; items with a null id mark words but are not listed. An empty
test set leaves every document clean. ``carry`` names what of the input travels along in the
struct ``row``; other columns are not read.
"""

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galewire.sources.scratch import materialize

WINDOW = 13
SHARD_BYTES = 8 << 20
BLOCK_BYTES = 32 << 20

# A-Z to a-z; every other byte that is no ASCII letter or digit, nor part of a longer character,
# to a blank.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Suffixes:
    """All suffixes of a block of test items that are at least a window long."""

    def __init__(self, items: Sequence[tuple[str | None, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.names: list[str | None] = []
        codes, starts, left, need, item = [], [], [], [], []
        place = 0
        for name, text in items:
            found = words(text)
            if not found:
                continue
            size = min(window, len(found))
            for k in range(len(found) - size + 1):
                starts.append(place + k)
                left.append(len(found) - k)
                need.append(size)
                item.append(len(self.names))
            codes += [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in found]
            codes.append(0)
            place = len(codes)
            self.names.append(name)
        self.codes = np.array(codes, np.int32)
        self.starts, self.left, self.need, self.item = (
            np.array(x, np.int64) for x in (starts, left, need, item)
        )
        self.shortest = int(self.need.min()) if len(need) else 0
        self.longest = int(self.left.max()) if len(left) else 0


def suffix_array(codes: np.ndarray, shortest: int, depth: int) -> np.ndarray:
    """Positions in runs of at least ``shortest`` non-zero codes, sorted by the codes that follow,
    to ``depth`` codes at least. Ranks by 1, 2, 4 ... codes (prefix doubling)."""
    ends = np.flatnonzero(codes == 0)
    begins = np.concatenate(([0], ends[:-1] + 1))
    long = ends - begins >= max(shortest, 1)
    lengths = (ends - begins)[long]
    if not len(lengths):
        return np.empty(0, np.int64)
    run = np.repeat(np.arange(len(lengths)), lengths)
    first = np.cumsum(lengths) - lengths
    places = begins[long][run] + np.arange(len(run)) - first[run]
    rank = codes[places].astype(np.int64)
    step = 1
    while True:
        ahead = np.zeros(len(rank), np.int64)
        ahead[:-step or None][run[step:] == run[: len(run) - step]] = rank[step:][
            run[step:] == run[: len(run) - step]
        ]
        pair = rank * (int(rank.max()) + 2) + ahead
        order = np.argsort(pair, kind="stable")
        fresh = np.concatenate(([True], np.diff(pair[order]) != 0))
        rank = np.empty(len(pair), np.int64)
        rank[order] = np.cumsum(fresh)
        step *= 2
        if step >= depth or step >= len(rank) or fresh.all():
            return places[order]


def search(codes: np.ndarray, array: np.ndarray, tests: Suffixes):
    """For every test suffix: the interval of the array that begins with its window (empty: 0, 0),
    and its longest match with the interval of it."""
    n = len(tests.starts)
    low, high = np.zeros(n, np.int64), np.full(n, len(array), np.int64)
    window = np.zeros((2, n), np.int64)
    longest = np.zeros(n, np.int64)
    active = np.arange(n) if len(array) else np.empty(0, np.int64)
    depth = 0
    while len(active):
        wanted = tests.codes[tests.starts[active] + depth]

        def bound(after: bool) -> np.ndarray:
            a, b = low[active].copy(), high[active].copy()
            while (open_ := a < b).any():
                middle = (a + b) >> 1
                seen = codes[array[np.where(open_, middle, 0)] + depth]
                right = open_ & ((seen <= wanted) if after else (seen < wanted))
                a = np.where(right, middle + 1, a)
                b = np.where(open_ & ~right, middle, b)
            return a

        a, b = bound(False), bound(True)
        found = a < b
        active, a, b = active[found], a[found], b[found]
        low[active], high[active] = a, b
        depth += 1
        longest[active] = depth
        full = active[tests.need[active] == depth]
        window[:, full] = low[full], high[full]
        active = active[tests.left[active] > depth]
    return window, longest, low, high


def _expand(array: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Array entries of all intervals, and which interval each comes from."""
    sizes = high - low
    which = np.repeat(np.arange(len(sizes)), sizes)
    return array[np.arange(len(which)) - (np.cumsum(sizes) - sizes)[which] + low[which]], which


FOUND = pa.struct([
    ("n_words", pa.int64()),
    ("spans", pa.list_(pa.int64())),  # first word and word after, of each stretch of hit words
    ("items", pa.list_(pa.string())),
    ("longest", pa.int64()),
    ("longest_at", pa.int64()),
    ("longest_item", pa.string()),
])


def search_shard(texts: list[bytes | None], before: list[dict | None], tests: Suffixes) -> list[dict]:
    """The findings of one shard, joined to those of earlier blocks."""
    get = tests.vocabulary.get
    parts, sizes = [], []
    for text in texts:
        found = words(text) if text else []
        sizes.append(len(found))
        parts += [get(w, 0) for w in found]
        parts.append(0)
    codes = np.array(parts, np.int32)
    starts = np.cumsum(np.array(sizes) + 1) - np.array(sizes) - 1
    out = [
        {"n_words": n, "spans": [], "items": [], "longest": 0, "longest_at": None, "longest_item": None}
        if old is None else dict(old)
        for n, old in zip(sizes, before)
    ]
    array = suffix_array(codes, tests.shortest, tests.longest) if tests.shortest else np.empty(0, np.int64)
    window, longest, low, high = search(codes, array, tests)
    some = np.flatnonzero(window[1] > window[0])
    if not len(some):
        return out
    at, which = _expand(array, window[0, some], window[1, some])
    edge = np.bincount(at, minlength=len(codes) + 1)
    edge -= np.bincount(at + tests.need[some][which], minlength=len(codes) + 1)
    hit = np.concatenate(([0], np.cumsum(edge) > 0, [0])).astype(np.int8)
    begins, ends = np.flatnonzero(np.diff(hit) == 1), np.flatnonzero(np.diff(hit) == -1)
    doc = np.searchsorted(starts, at, "right") - 1
    owner = np.searchsorted(starts, begins, "right") - 1
    for d in np.unique(owner):
        own = owner == d
        fresh = [(int(a - starts[d]), int(b - starts[d])) for a, b in zip(begins[own], ends[own])]
        old = list(zip(out[d]["spans"][::2], out[d]["spans"][1::2]))
        out[d]["spans"] = [x for span in union(fresh + old) for x in span]
    for d, item in np.unique(np.stack([doc, tests.item[some][which]], 1), axis=0):
        if tests.names[item] is not None:
            out[d]["items"] = sorted({*out[d]["items"], tests.names[item]})
    at, which = _expand(array, low[some], high[some])
    doc = np.searchsorted(starts, at, "right") - 1
    order = np.lexsort((tests.item[some][which], at, -longest[some][which], doc))
    best = order[np.concatenate(([True], np.diff(doc[order]) != 0))]
    for k in best:
        d, length = doc[k], int(longest[some][which[k]])
        if length > out[d]["longest"]:
            name = tests.names[tests.item[some][which[k]]]
            out[d] |= {"longest": length, "longest_at": int(at[k] - starts[d]), "longest_item": name}
    return out


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def shards(texts: list[bytes | None]) -> Iterator[slice]:
    """Consecutive rows of SHARD_BYTES or, if a single text is longer, that text."""
    first = size = 0
    for k, text in enumerate(texts):
        size += len(text or b"")
        if size > SHARD_BYTES and k > first:
            yield slice(first, k)
            first, size = k, len(text or b"")
    if first < len(texts):
        yield slice(first, len(texts))


def _pass(tests: Suffixes, inner: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text") if inner is None else batch.column("row").field(inner)
            texts = pc.cast(column, pa.binary()).to_pylist()
            before = batch.column("found").to_pylist()
            found = []
            for cut in shards(texts):
                found += search_shard(texts[cut], before[cut], tests)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found, FOUND)], names=batch.schema.names
            )

    return run


def test_blocks(tests: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list]:
    """The test items in blocks of about ``block_bytes`` at most (or one item, if longer)."""
    rows = tests.select(
        F.col(f"`{item_id}`").cast("string").alias("name"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"),
    )
    total = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = max(1, math.ceil(2 * total / block_bytes)) if total > block_bytes else 1
    for k in range(n):
        block = rows if n == 1 else rows.filter(F.pmod(F.xxhash64("name", "text"), F.lit(n)) == k)
        yield [(r["name"], bytes(r["text"])) for r in block.distinct().collect()]


def find_matches(
    docs: DataFrame,
    tests: DataFrame,
    carry: Sequence[str] = ("doc_id",),
    text: str = "text",
    item_id: str = "item_id",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``row`` and ``found``: words, stretches of hit words, items, and the longest match of each
    document."""
    row = F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")
    inner = text if text in carry else None
    whole = [] if inner else [F.col(f"`{text}`").alias("text")]
    found = T.StructType([
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.LongType())),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("longest", T.LongType()),
        T.StructField("longest_at", T.LongType()),
        T.StructField("longest_item", T.StringType()),
    ])
    out = docs.select(row, *whole, F.lit(None).cast(found).alias("found"))
    for k, items in enumerate(test_blocks(tests, item_id, text, block_bytes)):
        if k:
            out = materialize(out, "matches")
        out = out.mapInArrow(_pass(Suffixes(items, window), inner), out.schema)
    return out.select("row", "found")


def judge(found: DataFrame) -> DataFrame:
    """``row``, the counts, the longest match and ``contaminated``: hit words are a twentieth of
    all words or more."""
    pairs = F.sequence(F.lit(0), F.size("found.spans") - 2, F.lit(2))
    spans = F.when(
        F.size("found.spans") > 0,
        F.transform(pairs, lambda k: F.get("found.spans", k + 1) - F.get("found.spans", k)),
    ).otherwise(F.array().cast("array<bigint>"))
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda a, b: a + b)
    return found.select(
        "row",
        F.col("found.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.col("found.spans").alias("spans"),
        F.col("found.items").alias("items"),
        F.col("found.longest").alias("longest"),
        F.col("found.longest_at").alias("longest_at"),
        F.col("found.longest_item").alias("longest_item"),
    ).withColumn("contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))


def drop_contaminated(docs: DataFrame, tests: DataFrame, text: str = "text") -> DataFrame:
    """The input rows that are not contaminated, with their columns."""
    return judge(find_matches(docs, tests, docs.columns, text)).filter("NOT contaminated").select("row.*")
