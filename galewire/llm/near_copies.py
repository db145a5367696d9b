"""Near copies by text similarity: SimHash over wide fingerprints.

``simhash`` links fingerprints of 64 bits within a few bits. Texts whose sets of five-word shingles
have a Jaccard similarity of 0.8 differ in about 15 % of their bits; 64 bits cannot tell them from
texts at 0.5, and no set of exact probes of bounded size finds them. This form of the operator takes
512 bits over the distinct shingles. Two sets of similarity J agree in a bit with probability
1 - arccos(2J / (1 + J)) / pi, so the share of bits that differ estimates J. The bits only search: pairs
up to the share of ``similarity`` plus ``WIDE`` standard errors are candidates, and a candidate is linked
if the exact similarity of the two shingle sets is ``similarity`` or more.

The pigeonhole is that of ``simhash``, in expectation: the bits are cut into partitions, each gets a
threshold (-1 skips it, 0 asks for equal bits, 1 leaves one bit out), and dynamic programming picks
the thresholds, and the size of a partition, that cost the least by estimated candidate counts while
a pair of the asked similarity misses all probes with probability ``MISS`` at most. Candidates are
verified on all 512 bits. The bits come from independent hashes, so a partition is a random cut and not
a group of correlated bits as in ``simhash``. Larger tables get longer partitions, so a document's
candidates grow slowly; its probes grow with about the 0.24th power of the table.

Copies are folded first: only distinct fingerprints are probed. A bucket of more than ``BUCKET``
fingerprints is cut by hash into tiles of half that size, and every two tiles meet in a group of their
own: no task holds the bucket and each two members are compared. Its cost grows with the square of the
bucket.

A bucket or group yields a forest of its candidates only, at most a row less than it has members; the
forests join the texts to crowds of candidates. The members of a crowd then meet with the hashes of
their shingles, large crowds in tiles of bounded size, every two of which meet in a task of their own.
There each two members that the bits and the sizes of their sets allow, and that are not yet joined,
are compared by exact similarity, and what leaves the task is a forest of the links that hold. Pairs
that do not hold are never rows. Only texts that have a candidate are read again for their shingles.
Crowds of texts just below the asked similarity are what costs: all their candidates are compared.

Defined results: as in ``simhash``: null, empty and blank texts are alike; fewer words than a shingle
make one shingle of all of them; an empty table gives no rows.
"""

from collections.abc import Iterator, Sequence
from math import acos, log, log2, pi, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galewire.llm.components import connected
from galewire.llm.rows import with_row_id
from galewire.llm.simhash import SEED, forest, set_bits
from galewire.sources.scratch import materialize

SHINGLE = 5
SIMILARITY = 0.8
WORDS = 8  # of 64 bits each
BITS = 64 * WORDS
SLACK = 1.5
WIDE = 3.0  # the same for candidates that are checked on their shingles
MISS = 0.01
BUCKET = 1 << 12
TILE_HASHES = 1 << 21  # shingles that a tile of a crowd holds, about
ROUNDS = 8  # times the bits are cut into partitions, each time in another order
#: Cost of writing and moving one probe, in verified candidates.
PROBE_COST = 64.0


# ---------------------------------------------------------------- fingerprints


def _spread(hashes: np.ndarray) -> np.ndarray:
    """WORDS hashes for each hash: multiply-and-shift mixing of it and a counter."""
    x = hashes[:, None] + np.arange(1, WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct hashes of a text's shingles."""
    found = text.lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    runs = zip(*(found[k:] for k in range(shingle))) if len(found) >= shingle else [found]
    digest, join = xxhash.xxh64_intdigest, b" ".join
    return np.unique(np.fromiter((digest(join(r), SEED) for r in runs), np.uint64))


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> bytes:
    hashes = shingle_hashes(text, shingle)
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 1 << 13):
        ones += set_bits(_spread(hashes[k : k + (1 << 13)]))
    return np.packbits(2 * ones > len(hashes)).tobytes()


def fingerprints(docs: DataFrame, carry: Sequence[str], text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``row`` (the columns carried) and ``fp``, the 512 bits."""
    source = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{text}`").alias("fp_text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.cast(batch.column("fp_text"), pa.binary())
            fp = pa.array([fingerprint(t.as_py(), shingle) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("row"), fp], names=["row", "fp"])

    return source.mapInArrow(run, source.select("row", F.lit(b"").alias("fp")).schema)


def _bytes(column: pa.Array) -> np.ndarray:
    """A column of fingerprints as a matrix of bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BITS // 8)


# ---------------------------------------------------------------- partitions and thresholds


def differing(similarity: float) -> float:
    """The expected share of bits in which two shingle sets of this similarity differ."""
    return acos(2 * similarity / (1 + similarity)) / pi


def bit_shares(distinct: DataFrame) -> tuple[np.ndarray, int]:
    """How often each bit is set, and the number of fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BITS, np.int64), 0
        for batch in batches:
            total += np.unpackbits(_bytes(batch.column("fp")), axis=1).sum(0, dtype=np.int64)
            n += batch.num_rows
        if n:
            flat = np.append(total, n)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS + 1)), pa.array(flat)], names=["at", "n"])

    counts = distinct.select("fp").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    flat = np.zeros(BITS + 1)
    for at, n in counts.collect():  # BITS + 1 numbers
        flat[at] = n
    n = int(flat[BITS])
    return flat[:BITS] / max(n, 1), n


def allocate(costs: np.ndarray, gains: np.ndarray, wanted: float, steps: int = 300) -> tuple[float, list[int]] | None:
    """For each partition the choice (threshold + 1) whose gains add up to ``wanted`` at the least
    cost; None if all together do not. Gains are counted in whole steps, rounded down."""
    size = np.floor(gains / wanted * steps).astype(int)
    best = np.full(steps + 1, np.inf)
    best[0] = 0.0
    chosen = np.zeros((len(costs), steps + 1), int)
    before = np.zeros((len(costs), steps + 1), int)
    for i, row in enumerate(costs):
        after = np.full(steps + 1, np.inf)
        for choice, cost in enumerate(row):
            # What is more than wanted counts as wanted: the last place takes the best of them.
            to = np.minimum(np.arange(steps + 1) + size[i, choice], steps)
            for at in np.flatnonzero(np.isfinite(best)):
                if best[at] + cost < after[to[at]]:
                    after[to[at]] = best[at] + cost
                    chosen[i, to[at]], before[i, to[at]] = choice, at
        best = after
    if not np.isfinite(best[steps]):
        return None
    out, at = [], steps
    for i in reversed(range(len(costs))):
        out.append(int(chosen[i, at]))
        at = before[i, at]
    return float(best[steps]), out[::-1]


def plan(shares: np.ndarray, n: int, similarity: float = SIMILARITY) -> list[list[int]]:
    """The bits of every probe."""
    odds = differing(similarity)
    agree = shares * shares + (1 - shares) ** 2
    middle = max(4, round(log2(max(n, 16))) - 3)
    best = None
    for size in range(max(4, middle - 3), middle + 4, 2):
        groups = []
        for r in range(ROUNDS):
            order = np.random.default_rng([SEED, r]).permutation(BITS)
            groups += [order[k : k + size] for k in range(0, BITS - size + 1, size)]
        equal = (1 - odds) ** size
        one_off = equal + size * odds * (1 - odds) ** (size - 1)
        gains = np.tile(-np.log([1.0, 1 - equal, 1 - one_off]), (len(groups), 1))
        needed = min(len(groups), 2 * int(np.ceil(-log(MISS) / gains[0, 1])))
        alike = np.array([np.prod(agree[g]) for g in groups[:needed]]) * n * n / 2
        costs = np.stack([
            np.zeros(needed), alike + PROBE_COST * n, alike * (1 + size) + PROBE_COST * n * size,
        ], axis=1)
        found = allocate(costs, gains[:needed], -log(MISS))
        if found and (best is None or found[0] < best[0]):
            best = (found[0], groups, found[1])
    probes = []
    for group, choice in zip(best[1], best[2]):
        if choice == 1:
            probes.append(list(group))
        elif choice == 2:
            probes += [[b for b in group if b != out] for out in group]
    return probes


# ---------------------------------------------------------------- links


def probes(distinct: DataFrame, masks: Sequence[Sequence[int]], carry: Sequence[str] = ("fp",)) -> DataFrame:
    """``key`` (probe number and its bits) and the columns carried."""
    if len(masks) >= 1 << 15 or max(map(len, masks), default=0) > 48:
        raise ValueError("a key holds 15 bits of probe number and 48 of fingerprint")
    weights = [(np.array(m), 1 << np.arange(len(m), dtype=np.int64)) for m in masks]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 1024):
                batch = whole.slice(first, 1024)
                bits = np.unpackbits(_bytes(batch.column("fp")), axis=1)
                keys = np.concatenate([
                    (bits[:, at].astype(np.int64) @ power) | (k << 48) for k, (at, power) in enumerate(weights)
                ])
                rows = pa.array(np.tile(np.arange(len(bits)), len(weights)))
                columns = [pa.array(keys), *(batch.column(c).take(rows) for c in carry)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", *carry])

    source = distinct.select("fp", *[c for c in carry if c != "fp"])
    return source.mapInArrow(run, source.select(F.lit(0).cast("long").alias("key"), *carry).schema)


def spanning(n: int, a: np.ndarray, b: np.ndarray, differ: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of links between n members those of a forest with the same components, the nearest first."""
    order = np.argsort(differ, kind="stable")
    a, b, differ = a[order], b[order], differ[order]
    label, taken, left = np.arange(n), [], np.arange(len(a))
    while True:
        left = left[label[a[left]] != label[b[left]]]
        if not len(left):
            break
        best = np.full(n, len(a))
        np.minimum.at(best, label[a[left]], left)
        np.minimum.at(best, label[b[left]], left)
        new = np.unique(best[best < len(a)])
        taken.append(new)
        label = forest(n, np.concatenate([np.arange(n), a[new]]), np.concatenate([label, b[new]]))
    kept = np.concatenate([np.empty(0, np.int64), *taken])
    return a[kept], b[kept], differ[kept]


def _pairs(fp: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    ends = [
        pa.FixedSizeBinaryArray.from_buffers(pa.binary(BITS // 8), len(x), [None, pa.py_buffer(np.ascontiguousarray(fp[x]))])
        .cast(pa.binary())
        for x in (a, b)
    ]
    return pa.RecordBatch.from_arrays(ends, names=["a", "b"])


def _by_group(batches: Iterator[pa.RecordBatch], read, n_keys: int, body) -> Iterator[pa.RecordBatch]:
    """``body`` of the columns of whole groups, one after the other in a sorted stream; ``read`` makes
    a list of arrays of a batch, the first ``n_keys`` of which tell the groups apart."""
    rest: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = read(batch)
        cols = [np.concatenate(x) for x in zip(rest, new)] if rest else new
        # The last group may go on in the next batch.
        other = np.flatnonzero(np.logical_or.reduce([c != c[-1] for c in cols[:n_keys]]))
        cut = int(other[-1]) + 1 if len(other) else 0
        rest = [c[cut:] for c in cols]
        if cut:
            yield from body(*[c[:cut] for c in cols])
    if rest:
        yield from body(*rest)


def _starts(*keys: np.ndarray) -> np.ndarray:
    fresh = np.ones(len(keys[0]), bool)
    fresh[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(fresh)


def _bucket_links(limit: int):
    def links(key: np.ndarray, tile: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        words, n = fp.view(np.uint64), len(fp)
        starts = _starts(key, tile)
        ends = np.append(starts[1:], n)
        end = np.repeat(ends, ends - starts)
        none = np.empty(0, np.int64)
        at, step, held, found = np.arange(n), 1, 0, [(none, none, none)]
        while True:
            at = at[at + step < end[at]]
            if len(at):
                # Half of the bits of most pairs differ in more places than all may.
                near = at[np.bitwise_count(words[at, : WORDS // 2] ^ words[at + step, : WORDS // 2]).sum(1) <= limit]
                differ = np.bitwise_count(words[near] ^ words[near + step]).sum(1).astype(np.int64)
                near, differ = near[differ <= limit], differ[differ <= limit]
                found.append((near, near + step, differ))
                held += len(near)
                step += 1
            if held > 1 << 18 or not len(at):
                found, held = [spanning(n, *(np.concatenate(x) for x in zip(*found)))], 0
            if not len(at):
                break
        yield _pairs(fp, *found[0][:2])

    def read(batch: pa.RecordBatch) -> list[np.ndarray]:
        keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "tile")]
        return [*keys, _bytes(batch.column("fp"))]

    return lambda batches: _by_group(batches, read, 2, links)


def _limit(similarity: float, slack: float) -> int:
    odds = differing(similarity)
    return int(BITS * odds + slack * sqrt(BITS * odds * (1 - odds)))


def _tiled(rows: DataFrame, tiles: Column, fp: str = "fp") -> DataFrame:
    """``rows`` with ``own`` (their tile, by hash) and ``tile``: one row for each group of two tiles, or
    of one with itself, that they are in."""
    own = F.pmod(F.xxhash64(fp), tiles)
    every = F.sequence(F.lit(0).cast("long"), tiles - 1)
    groups = F.transform(every, lambda x: F.least(own, x) * tiles + F.greatest(own, x))
    return rows.withColumn("own", own).withColumn("tile", F.explode(groups))


def _compared(distinct: DataFrame, masks: Sequence[Sequence[int]], limit: int, bucket: int) -> DataFrame:
    """Pairs (``a``, ``b``) of ``distinct`` (fp) within the limit: a forest of each bucket's."""
    dealt = probes(distinct, masks)
    counts = probes(distinct, masks, []).groupBy("key").agg(F.count("*").alias("n"))
    # One bucket in many is full: a short list, whatever the size of those buckets.
    full = materialize(counts.filter(F.col("n") > bucket), "full-buckets").withColumn(
        "tiles", F.ceil(2 * F.col("n") / bucket).cast("long")
    )
    if full.isEmpty():
        dealt = dealt.withColumn("tile", F.lit(0).cast("long"))
    else:
        dealt = _tiled(dealt.join(full, "key", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1).cast("long"))), F.col("tiles"))
    return (
        dealt.repartition("key", "tile").sortWithinPartitions("key", "tile").select("key", "tile", "fp")
        .mapInArrow(_bucket_links(limit), "a binary, b binary")
    )


def find_links(distinct: DataFrame, similarity: float = SIMILARITY, bucket: int = BUCKET) -> DataFrame:
    """Edges (``a``, ``b``) that connect the fingerprints of texts similar by their bits alone."""
    masks = plan(*bit_shares(distinct), similarity)
    return _compared(distinct.select("fp"), masks, _limit(similarity, SLACK), bucket)


# ---------------------------------------------------------------- exact similarity


def shingle_sets(texts: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``crowd``, ``fp`` and ``hashes``, the distinct shingles, of rows ``crowd``, ``fp`` and ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                batch = whole.slice(first, 256)
                found = [shingle_hashes(t.as_py(), shingle).view(np.int64) for t in pc.cast(batch.column("text"), pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("crowd"), batch.column("fp"), pa.array(found, pa.list_(pa.int64()))],
                    names=["crowd", "fp", "hashes"],
                )

    return texts.select("crowd", "fp", "text").mapInArrow(run, "crowd long, fp binary, hashes array<long>")


def alike_forest(
    words: np.ndarray, own: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, similarity: float, limit: int
) -> list[tuple[int, int]]:
    """A forest over the pairs of a group's members whose exact similarity is enough.

    Of a group of two tiles only pairs across them are compared. ``hashes`` holds the members'
    distinct shingles one after the other, ``sizes`` how many each has.
    """
    n, found = len(sizes), []
    first = np.concatenate(([0], np.cumsum(sizes)))
    kinds, ids = np.unique(hashes, return_inverse=True)
    mark, label = np.zeros(len(kinds), bool), np.arange(n)
    across = own[0] != own[-1] or (own != own[0]).any()
    for i in range(n - 1):
        j = i + 1 + np.flatnonzero(label[i + 1 :] != label[i])
        if across:
            j = j[own[j] != own[i]]
        # The smaller set is at least this share of the larger one.
        j = j[np.minimum(sizes[j], sizes[i]) >= similarity * np.maximum(sizes[j], sizes[i])]
        j = j[np.bitwise_count(words[j] ^ words[i]).sum(1) <= limit]
        if not len(j):
            continue
        mark[ids[first[i] : first[i + 1]]] = True
        upto = np.cumsum(sizes[j])
        at = np.arange(upto[-1]) + np.repeat(first[j] - upto + sizes[j], sizes[j])
        common = np.add.reduceat(mark[ids[at]].astype(np.int64), upto - sizes[j])
        mark[ids[first[i] : first[i + 1]]] = False
        for k in j[common / (sizes[i] + sizes[j] - common) >= similarity].tolist():
            if label[k] != label[i]:
                found.append((i, k))
                label[label == label[k]] = label[i]
    return found


def _crowd_links(similarity: float, limit: int):
    def links(crowd, tile, own, fp, sizes, sets) -> Iterator[pa.RecordBatch]:
        starts, words = _starts(crowd, tile), fp.view(np.uint64)
        a, b = [], []
        for low, high in zip(starts.tolist(), [*starts[1:].tolist(), len(crowd)]):
            part = slice(low, high)
            for i, j in alike_forest(words[part], own[part], sizes[part], np.concatenate(sets[part]), similarity, limit):
                a.append(low + i)
                b.append(low + j)
        yield _pairs(fp, np.array(a, np.int64), np.array(b, np.int64))

    def read(batch: pa.RecordBatch) -> list[np.ndarray]:
        keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("crowd", "tile", "own")]
        column = batch.column("hashes")
        sets = np.empty(len(column), object)
        for k in range(len(column)):
            sets[k] = column[k].values.to_numpy(zero_copy_only=False).copy()
        return [*keys, _bytes(batch.column("fp")), np.fromiter(map(len, sets), np.int64, len(sets)), sets]

    return lambda batches: _by_group(batches, read, 2, links)


def similar_links(
    distinct: DataFrame, texts: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE, bucket: int = BUCKET
) -> DataFrame:
    """Edges (``a``, ``b``) between fingerprints of texts whose exact similarity is enough, which connect
    all such that are candidates. ``distinct`` has ``fp`` and ``rid`` of one row of ``texts`` (``rid``,
    ``text``) that stands for it."""
    masks, limit = plan(*bit_shares(distinct), similarity), _limit(similarity, WIDE)
    crowds = connected(_compared(distinct.select("fp"), masks, limit, bucket))
    members = distinct.join(crowds.withColumnRenamed("node", "fp"), "fp").select(
        "fp", "rid", F.xxhash64("label").alias("crowd")
    )
    sets = materialize(shingle_sets(texts.join(members, "rid"), shingle), "crowds")
    sizes = sets.groupBy("crowd").agg(F.count("*").alias("n"), F.sum(F.size("hashes")).alias("hashes"))
    tiles = F.greatest(F.ceil(2 * F.col("n") / bucket), F.ceil(F.col("hashes") / TILE_HASHES)).cast("long")
    alone = (F.col("n") <= bucket) & (F.col("hashes") <= 2 * TILE_HASHES)
    counted = sizes.select("crowd", F.when(alone, 1).otherwise(tiles).cast("long").alias("tiles"))
    met = _tiled(sets.join(counted, "crowd"), F.col("tiles"))
    return (
        met.repartition("crowd", "tile").sortWithinPartitions("crowd", "tile")
        .select("crowd", "tile", "own", "fp", "hashes")
        .mapInArrow(_crowd_links(similarity, limit), "a binary, b binary")
    )


# ---------------------------------------------------------------- the operator


def keep_one(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
    shingle: int = SHINGLE,
) -> DataFrame:
    """The input rows without near copies: of each group of texts that are linked by exact similarity,
    directly or by a chain, the row with the least id stays (a null id counts as the greatest; rows that
    share an id, by a digest of their content)."""
    named = with_row_id(docs)
    narrow = named.select(
        "rid", "digest", F.col(f"row.`{doc_id}`").alias("doc_id"), F.col(f"row.`{text}`").alias("text")
    )
    marked = fingerprints(narrow, ["rid", "doc_id", "digest"], "text", shingle)
    first = F.struct(F.col("row.doc_id").isNull().alias("last"), "row.doc_id", "row.digest", "row.rid")
    # Copies are folded before anything is joined: a text that a third of all rows share is one row.
    distinct = materialize(marked.groupBy("fp").agg(F.min(first).alias("first")), "near-copies")
    links = similar_links(distinct.select("fp", "first.rid"), narrow.select("rid", "text"), similarity, shingle)
    classes = connected(links).withColumnRenamed("node", "fp")
    kept = (
        distinct.join(classes, "fp", "left").groupBy(F.coalesce("label", "fp").alias("class"))
        .agg(F.min("first").alias("first")).select(F.col("first.rid").alias("rid"))
    )
    return named.join(kept, "rid", "left_semi").select("row.*")
