"""Runs of repeated words by string synchronising sets.

A run is a maximal stretch of words with smallest period q, at least four periods and six words
long. Periods up to ``SMALL`` are read off directly: the text is compared with itself moved by the
period. Each larger q belongs to the dyadic scale t with t <= q < 2t. There a position is chosen if
the least hash of the windows of t words that start within the next t + 1 places stands at either
end of them; whether it is depends on the next 2t words alone, so it is chosen again wherever they
recur. Windows that lie in a region of small period (up to t/3) take no part, so such a region is
not chosen whole at every scale; its run is known already. Positions with equal next 2t words, one
after the other, propose their distance as a period; a proposal is extended word by word as far as
it holds.

Nothing is missed. Within a run of period q at scale t, some t neighbouring windows among the first
2t are in no region of small period (else the run had that period), so one of the first t places is
chosen; it recurs q places later, still in the run, as the run has four periods. Between the two no
chosen place has the same 2t > q words, for a primitive word differs from its rotations. By the same
argument a scale without any two equal contexts ends the search. Hashes only propose: what is
returned has been compared word by word.

Cost of a text: a few passes over its words for each scale up to a quarter of its length.

Defined results: null, empty and blank texts have no words and no runs, and collapse to an empty
text. Repeated rows are each searched; an empty table gives no rows. A null in a carried column
travels as it is. Texts are whole, of any length; one text is held by one task.
"""

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galewire.llm.text import words

LEAST_WORDS = 6
LEAST_PERIODS = 4
SMALL = 3
SEED = 41

NONE = np.uint64(2**64 - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: multiply and shift."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _doubled(names: np.ndarray, width: int) -> np.ndarray:
    """Hashes of windows twice as wide as ``width``."""
    return _mixed(names[:-width] * np.uint64(0x9E3779B97F4A7C15) + names[width:])


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 of every stretch of true flags."""
    edge = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _held(codes: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The stretch around ``at`` of places that equal the place one period later."""
    last = len(codes) - period
    high, step = at, 64
    while high < last:
        end = min(last, high + step)
        off = codes[high:end] != codes[high + period : end + period]
        if off.any():
            high += int(off.argmax())
            break
        high, step = end, 2 * step
    low, step = at, 64
    while low > 0:
        first = max(0, low - step)
        off = (codes[first:low] != codes[first + period : low + period])[::-1]
        if off.any():
            low -= int(off.argmax())
            break
        low, step = first, 2 * step
    return low, high


def _proposals(contexts: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chosen places with the same context next to each other: the first of them, the distance."""
    order = np.argsort(contexts, kind="stable")
    same = np.flatnonzero(contexts[order][1:] == contexts[order][:-1])
    first = chosen[order[same]]
    return first, chosen[order[same + 1]] - first


def find_runs(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of an array of word numbers, by start, then period."""
    n = len(codes)
    found: dict[tuple[int, int], int] = {}

    def keep(start: int, length: int, period: int) -> None:
        # A multiple of the smallest period holds over the same stretch; small periods come first.
        found.setdefault((start, length), period)

    apart = []
    for period in range(1, min(SMALL, n - 1) + 1):
        same = codes[:-period] == codes[period:]
        apart.append(np.concatenate(([0], np.cumsum(~same))))
        first, last = _stretches(same)
        long = last - first + period >= max(LEAST_WORDS, LEAST_PERIODS * period)
        for a, b in zip(first[long].tolist(), last[long].tolist()):
            keep(a, b - a + period, period)

    names, width, scale = _mixed(codes.astype(np.uint64) + np.uint64(SEED)), 1, SMALL + 1
    while LEAST_PERIODS * scale <= n:
        while width < scale:
            names, width = _doubled(names, width), 2 * width
        ranked = names
        for period in range(1, min(SMALL, scale // 3) + 1):
            sums, inner = apart[period - 1], scale - period
            periodic = sums[inner:][: len(names)] == sums[: len(sums) - inner][: len(names)]
            ranked = np.where(periodic, NONE, ranked)
        least = _least(ranked, scale + 1)
        m = len(least)
        chosen = np.flatnonzero((least != NONE) & ((ranked[:m] == least) | (ranked[scale : scale + m] == least)))
        wide = _doubled(names, scale)
        first, distance = _proposals(wide[chosen], chosen)
        if not len(first):
            break
        fits = (distance >= scale) & (distance < 2 * scale)
        first, distance = first[fits], distance[fits]
        for period in np.unique(distance).tolist():
            places, k = np.sort(first[distance == period]), 0
            while k < len(places):
                low, high = _held(codes, int(places[k]), period)
                if high - low + period >= max(LEAST_WORDS, LEAST_PERIODS * period):
                    keep(low, high - low + period, period)
                k = max(k + 1, int(np.searchsorted(places, high)))
        names, width, scale = wide, 2 * scale, 2 * scale
    return sorted((s, n_words, p) for (s, n_words), p in found.items())


def collapse(found: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run repeats, joined by single spaces."""
    if not runs:
        return b" ".join(found)
    edge = np.zeros(len(found) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    gone = np.cumsum(edge)[:-1] > 0
    return b" ".join([w for w, x in zip(found, gone.tolist()) if not x])


def word_codes(found: list[bytes]) -> np.ndarray:
    """Equal numbers for equal words."""
    numbers: dict[bytes, int] = {}
    return np.fromiter((numbers.setdefault(w, len(numbers)) for w in found), np.int64, len(found))


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def periodic_runs(docs: DataFrame, carry: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``row`` (the columns carried), ``runs`` by start and period, ``collapsed`` (the text without
    repeated periods). A pass over the rows, without a shuffle."""
    source = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{text}`").alias("runs_text")
    )
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                batch = whole.slice(first, 256)
                runs, short = [], []
                for text in pc.cast(batch.column("runs_text"), pa.binary()):
                    found = (text.as_py() or b"").split()
                    own = find_runs(word_codes(found))
                    runs.append([dict(zip(("start", "length", "period"), r)) for r in own])
                    short.append(collapse(found, own))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), pa.array(runs, kind), pc.cast(pa.array(short, pa.binary()), pa.string())],
                    names=["row", "runs", "collapsed"],
                )

    schema = source.select(
        "row", F.array().cast(RUNS).alias("runs"), F.lit("").alias("collapsed")
    ).schema
    return source.mapInArrow(run, schema)


def with_planted_period(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``text``, where a tenth of the texts, told by the checksum of the id, go on from
    some word by repeating what follows it. Null ids and texts without words stay as they are."""
    number = F.crc32(F.col(doc_id).cast("string"))
    big = F.floor(number / 10).cast("long")
    found = words(F.col(text))

    def planted(row):
        w, g = row["w"], row["g"]
        n = F.size(w)
        a = (g % n).cast("int")
        p = (F.floor((n - a) / (g % 8 + 3)) + 1).cast("int")
        return F.concat_ws(" ", F.transform(
            F.sequence(F.lit(0), n - 1), lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p))
        ))

    asked = F.coalesce((number % 10 == 0) & (F.size(found) > 0), F.lit(False))
    # Bound once: the words would be split anew for each word taken.
    made = F.get(F.transform(F.array(F.struct(found.alias("w"), big.alias("g"))), planted), F.lit(0))
    return docs.select(F.col(doc_id).alias("doc_id"), F.when(asked, made).otherwise(F.col(text)).alias("text"))


def listed(runs: list[tuple[int, int, int]]) -> str:
    """The digest of a list of runs, as the query writes it."""
    return hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest()
