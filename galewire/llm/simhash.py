"""SimHash near duplicates found by the generalised pigeonhole principle.

A document's fingerprint has bit k set if more than half of its shingles' hashes have it. Two
documents are linked if their fingerprints differ in ``distance`` bits at most, directly or by a
chain of links.

The 64 bits are grouped into partitions of correlated bits, from the co-occurrence counts of all
distinct fingerprints. With m partitions and thresholds t_i (-1 skips a partition) that sum to
distance - m + 1, two linked fingerprints are within t_i in some partition i (Qin et al., GPH,
2018). The thresholds, and m, are chosen by dynamic programming over candidate counts, estimated
from the measured collisions of every partition. Partition i is probed once for each choice of t_i
of its bits to leave out, so both sides emit the same keys and meet in buckets; every candidate is
verified on all 64 bits.

Copies are folded first: only distinct fingerprints are probed. A bucket of more than
``BUCKET`` fingerprints is not compared whole: its members are dealt again with the agreed bits
plus one of distance + 1 blocks of the others (plain pigeonhole), again and again; once twelve bits
are open a bucket cannot hold more than BUCKET. A bucket yields a spanning forest of its links
instead of all pairs. So every link is found, and no group, however large, meets in one task.

Defined results: null, empty and blank texts have fingerprint zero and are linked like any other;
fewer words than a shingle make one shingle of all of them. Documents with a null id get the
component of their fingerprint, but never name it; a component without an id has null. Repeated
rows are each returned. An empty table gives no rows.
"""

from collections.abc import Iterator, Sequence
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galewire.llm.components import connected
from galewire.sources.scratch import materialize

SHINGLE = 3
DISTANCE = 3
BUCKET = 1 << 12
OPEN_BITS = 12  # 2 ** OPEN_BITS <= BUCKET
PARTITIONS = (2, 3, 4)
SEED = 42
#: Cost of writing and moving one probe, in verified candidates.
PROBE_COST = 16.0


# ---------------------------------------------------------------- fingerprints


def set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many rows of hashes (one or more words each) have each bit set."""
    bits = np.unpackbits(np.ascontiguousarray(hashes).view(np.uint8), axis=1)
    # Sums of up to 255 bits fit a byte: eight bit columns are added at a time.
    padded = np.zeros((-(-len(bits) // 255) * 255, bits.shape[1]), np.uint8)
    padded[: len(bits)] = bits
    sums = padded.view(np.uint64).reshape(-1, 255, bits.shape[1] // 8).sum(1)
    return sums.view(np.uint8).reshape(-1, bits.shape[1]).sum(0, dtype=np.int64)


def fingerprint(text: bytes | None, shingle: int) -> int:
    found = text.lower().split() if text else []
    if not found:
        return 0
    # bytes.lower and bytes.split know ASCII letters and blanks only, as wanted.
    runs = zip(*(found[k:] for k in range(shingle))) if len(found) >= shingle else [found]
    n = max(1, len(found) - shingle + 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = np.fromiter((digest(join(r), SEED) for r in runs), ">u8", n)
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 255 * 256):
        ones += set_bits(hashes[k : k + 255 * 256].reshape(-1, 1))
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, carry: Sequence[str], text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``row`` (the columns carried) and ``fp``, the 64 bits as a long."""
    source = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{text}`").alias("fp_text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.cast(batch.column("fp_text"), pa.binary())
            fp = pa.array([fingerprint(t.as_py(), shingle) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("row"), fp], names=["row", "fp"])

    schema = source.select("row", F.lit(0).cast("long").alias("fp")).schema
    return source.mapInArrow(run, schema)


# ---------------------------------------------------------------- partitions and thresholds


def bit_counts(distinct: DataFrame) -> tuple[np.ndarray, int]:
    """How often bits i and j are both set, over all fingerprints, and how many there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((64, 64)), 0
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False).astype(">i8")
            bits = np.unpackbits(fp.view(np.uint8)).reshape(-1, 64)[:, ::-1].astype(np.float32)
            total += bits.T @ bits
            n += len(bits)
        if n:
            flat = np.concatenate((total.ravel(), [n])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(4097)), pa.array(flat)], names=["at", "n"])

    counts = distinct.select("fp").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    flat = np.zeros(4097)
    for at, n in counts.collect():  # 64 x 64 + 1 numbers
        flat[at] = n
    return flat[:4096].reshape(64, 64), int(flat[4096])


def group_bits(both: np.ndarray, n: int, m: int) -> list[list[int]]:
    """Bits in m groups of about equal size, correlated ones together: each group starts with the
    free bit that leans most to one side and takes the free bits most correlated with it so far."""
    n = max(n, 1)
    p = np.diag(both) / n
    spread = np.sqrt(np.clip(p * (1 - p), 1e-9, None))
    tied = np.abs(both / n - np.outer(p, p)) / np.outer(spread, spread)
    free, groups = list(range(64)), []
    for k in range(m):
        size = 64 // m + (k < 64 % m)
        group = [max(free, key=lambda b: (abs(p[b] - 0.5), -b))]
        free.remove(group[0])
        while len(group) < size:
            best = max(free, key=lambda b: (tied[b, group].sum(), -b))
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def _mask(bits: Sequence[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >> 63 else value


def collisions(distinct: DataFrame, masks: Sequence[int]) -> list[float]:
    """Pairs of fingerprints that agree on each mask."""
    probes = distinct.select("fp", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("keep"))
    per = probes.groupBy("keep", F.col("fp").bitwiseAND(F.col("keep")).alias("v")).agg(F.count("*").alias("n"))
    sums = {
        r[0]: r[1] for r in per.groupBy("keep").agg(F.sum(F.expr("cast(n as double) * (n - 1) / 2"))).collect()
    }
    return [sums.get(m, 0.0) for m in masks]


def allocate(costs: Sequence[Sequence[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds t_i from -1 up that sum to ``total`` at the least cost; costs[i][t + 1]."""
    m = len(costs)
    best: dict[int, tuple[float, list[int]]] = {m + total: (0.0, [])}  # steps left: t_i + 1 each
    for row in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for left, (cost, chosen) in best.items():
            for step in range(min(left, len(row) - 1) + 1):
                option = (cost + row[step], [*chosen, step - 1])
                if left - step not in after or option < after[left - step]:
                    after[left - step] = option
        best = after
    return best[0]


def plan(distinct: DataFrame, distance: int = DISTANCE, sizes: Sequence[int] = PARTITIONS) -> tuple[list, list[int]]:
    """The cheapest partitions and their thresholds."""
    both, n = bit_counts(distinct)
    p = np.diag(both) / max(n, 1)
    agree = p * p + (1 - p) ** 2
    odds = (1 - agree) / agree
    layouts = {m: group_bits(both, n, m) for m in sizes if m <= distance + 1}
    masks = [_mask(g) for groups in layouts.values() for g in groups]
    seen = dict(zip(masks, collisions(distinct, masks)))
    best = None
    for m, groups in layouts.items():
        costs = []
        for group in groups:
            # Pairs within t: those that agree, times the odds of each set of t bits or fewer
            # that differ (elementary symmetric sums).
            sums = np.zeros(distance + 1)
            sums[0] = 1
            for b in group:
                sums[1:] += sums[:-1] * odds[b]
            pairs = max(seen[_mask(group)], 1.0) * np.cumsum(sums)
            costs.append(
                [0.0] + [pairs[t] + PROBE_COST * n * comb(len(group), t) for t in range(distance + 1)]
            )
        cost, chosen = allocate(costs, distance - m + 1)
        if best is None or cost < best[0]:
            best = (cost, groups, chosen)
    return best[1], best[2]


def probe_masks(groups: Sequence[Sequence[int]], thresholds: Sequence[int]) -> list[int]:
    return [
        _mask([b for b in group if b not in out])
        for group, t in zip(groups, thresholds)
        if t >= 0
        for out in combinations(group, t)
    ]


# ---------------------------------------------------------------- links


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index each of n members is linked with, directly or not."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if (label == before).all():
            return label


def _bucket_links(distance: int):
    def links(keep: np.ndarray, value: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        n = len(fp)
        fresh = np.ones(n, bool)
        fresh[1:] = (keep[1:] != keep[:-1]) | (value[1:] != value[:-1])
        starts = np.flatnonzero(fresh)
        ends = np.append(starts[1:], n)
        end = np.repeat(ends, ends - starts)
        at, step, a, b = np.arange(n), 1, [], []
        while True:
            at = at[at + step < end[at]]
            if not len(at):
                break
            close = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= distance]
            a.append(close)
            b.append(close + step)
            step += 1
        none = np.empty(0, np.int64)
        label = forest(n, np.concatenate([none, *a]), np.concatenate([none, *b]))
        moved = np.flatnonzero(label != np.arange(n))
        return pa.RecordBatch.from_arrays(
            [pa.array(fp[moved].view(np.int64)), pa.array(fp[label[moved]].view(np.int64))], names=["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: tuple[np.ndarray, ...] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("keep", "value", "fp")]
            cols = [np.concatenate(x) for x in zip(rest, new)] if rest else new
            # The last bucket may go on in the next batch.
            same = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1])
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            rest = tuple(c[cut:] for c in cols)
            if cut:
                yield links(cols[0][:cut], cols[1][:cut], cols[2][:cut].view(np.uint64))
        if rest:
            yield links(rest[0], rest[1], rest[2].view(np.uint64))

    return run


def _refined(keep: Column, distance: int) -> Column:
    """The masks of a bucket's next round: the agreed bits and each of distance + 1 blocks of the
    open ones."""
    bits = F.sequence(F.lit(0), F.lit(63))
    open_bits = F.filter(bits, lambda b: F.getbit(keep, b) == 0)
    size = F.ceil(F.size(open_bits) / F.lit(distance + 1)).cast("int")
    blocks = F.array(*[F.slice(open_bits, size * k + 1, size) for k in range(distance + 1)])
    powers = F.array(*[F.lit(_mask([b])).cast("long") for b in range(64)])

    def with_block(block: Column) -> Column:
        return F.aggregate(block, keep, lambda acc, b: acc.bitwiseOR(F.get(powers, b)))

    return F.array_distinct(F.transform(F.filter(blocks, lambda x: F.size(x) > 0), with_block))


def find_links(distinct: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Edges (``a``, ``b``) between fingerprints that connect all that lie within the distance."""
    groups, thresholds = plan(distinct, distance)
    masks = F.array(*[F.lit(m).cast("long") for m in probe_masks(groups, thresholds)])
    level = distinct.select("fp", F.explode(masks).alias("keep"))
    links = None
    while True:
        keyed = level.withColumn("value", F.col("fp").bitwiseAND(F.col("keep")))
        counts = keyed.groupBy("keep", "value").agg(F.count("*").alias("n"))
        # One bucket in many is full: a short list, whatever the size of those buckets.
        full = materialize(
            counts.filter((F.col("n") > bucket) & (F.bit_count("keep") < 64 - OPEN_BITS)), "full-buckets"
        ).select("keep", "value", F.lit(True).alias("full"))
        marked = keyed.join(full, ["keep", "value"], "left")
        compared = marked.filter("full IS NULL").select("keep", "value", "fp")
        found = (
            compared.repartition("keep", "value").sortWithinPartitions("keep", "value")
            .mapInArrow(_bucket_links(distance), "a long, b long")
        )
        links = found if links is None else links.unionByName(found)
        if full.isEmpty():
            return links
        level = materialize(
            marked.filter("full").select("fp", F.explode(_refined(F.col("keep"), distance)).alias("keep")).distinct(),
            "full-members",
        )


# ---------------------------------------------------------------- the operator


def near_duplicates(
    docs: DataFrame,
    carry: Sequence[str] = ("doc_id",),
    text: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """``row`` (the columns carried), ``fp``, and ``class``, the same for rows that are linked."""
    marked = materialize(fingerprints(docs, carry, text, shingle), "fingerprints")
    classes = connected(find_links(materialize(marked.select("fp").distinct(), "distinct-fingerprints"), distance))
    return marked.join(classes.withColumnRenamed("node", "fp"), "fp", "left").select(
        "row", "fp", F.coalesce("label", "fp").alias("class")
    )


def component_ids(marked: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``marked`` with ``component_id``, the least id of each class."""
    least = marked.groupBy("class").agg(F.min(f"row.{doc_id}").alias("component_id"))
    return marked.join(least, "class")
