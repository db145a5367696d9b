"""Near copies by wide fingerprints, against all pairs and against exact similarity."""

import random

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from galewire.llm import near_copies
from galewire.llm.components import connected

LIMIT = 89  # bits of 512: 0.1514 * 512 + 1.5 * 8.11


def bits(fp):
    return int.from_bytes(fp, "big")


def plain_classes(prints, limit=LIMIT):
    """The classes of linked fingerprints, by comparing all pairs."""
    values = sorted(set(prints))
    root = {f: f for f in values}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for k, a in enumerate(values):
        for b in values[:k]:
            if (bits(a) ^ bits(b)).bit_count() <= limit:
                root[find(a)] = find(b)
    return {f: find(f) for f in values}


def plain_first(docs):
    """Ids that stay, of [(id, text)], by the exact similarity of all pairs."""
    sets = [(i, frozenset(map(int, near_copies.shingle_hashes((t or "").encode())))) for i, t in docs]
    distinct = sorted({s for _, s in sets}, key=lambda s: (len(s), sorted(s)[:1]))
    root = list(range(len(distinct)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for k, a in enumerate(distinct):
        for j, b in enumerate(distinct[:k]):
            if a and len(a & b) >= 0.8 * len(a | b):
                root[find(k)] = find(j)
    place, least = {s: k for k, s in enumerate(distinct)}, {}
    for i, s in sets:
        least[find(place[s])] = min(i, least.get(find(place[s]), i))
    return set(least.values())


def plain_fingerprint(text):
    hashes = [int(h) for h in near_copies.shingle_hashes(text.encode())]
    wide = [b"".join(int(w).to_bytes(8, "little") for w in near_copies._spread(np.array([h], np.uint64))[0]) for h in hashes]
    n = len(wide)
    ones = [sum(w[k // 8] >> (7 - k % 8) & 1 for w in wide) for k in range(near_copies.BITS)]
    out = bytearray(near_copies.BITS // 8)
    for k, c in enumerate(ones):
        out[k // 8] |= (2 * c > n) << (7 - k % 8)
    return bytes(out)


def test_fingerprint_is_the_majority_of_each_bit():
    rng = random.Random(2)
    for n in (0, 1, 4, 5, 6, 40):
        text = " ".join(rng.choice("abcdefgh") for _ in range(n))
        assert near_copies.fingerprint(text.encode()) == plain_fingerprint(text)
    assert near_copies.fingerprint(None) == near_copies.fingerprint(b" \t") == bytes(64)
    assert near_copies.fingerprint(b"A b") == near_copies.fingerprint(b"a\n B")


def similar(rng, similarity, n=400):
    """Two word lists whose five-word shingle sets have about this similarity."""
    base = [f"w{rng.randrange(10**9)}" for _ in range(n)]
    other, k = list(base), 0
    # Each replaced word, far from the others, takes five shingles out of both sets.
    replaced = round(n * (1 - similarity) / (1 + similarity) / 5)
    for k in range(replaced):
        other[(k * n // replaced) + 2] = f"x{rng.randrange(10**9)}"
    return " ".join(base), " ".join(other)


def jaccard(a, b):
    x, y = (set(map(int, near_copies.shingle_hashes(t.encode()))) for t in (a, b))
    return len(x & y) / len(x | y)


def test_similar_pairs_are_found_and_others_left_alone(spark):
    rng = random.Random(3)
    pairs = [(s, *similar(rng, s)) for s in (0.85, 0.9, 0.95) for _ in range(40)]
    pairs += [(s, *similar(rng, s)) for s in (0.3, 0.5) for _ in range(40)]
    texts = [t for _, a, b in pairs for t in (a, b)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id for r in near_copies.keep_one(docs).collect()}
    missed = 0
    for k, (s, a, b) in enumerate(pairs):
        assert abs(jaccard(a, b) - s) < 0.03 and 2 * k in kept
        missed += s >= 0.8 and 2 * k + 1 in kept
        assert s >= 0.8 or 2 * k + 1 in kept
    assert missed <= 2


@pytest.mark.parametrize("bucket", [4096, 16])
def test_links_are_exact(spark, bucket):
    """Pairs around the asked similarity, and a crowd: no link below it, and its classes are found."""
    rng = random.Random(11)
    texts = [t for s in (0.72, 0.76, 0.79, 0.82, 0.86) for _ in range(40) for t in similar(rng, s)]
    base = [f"w{rng.randrange(10**9)}" for _ in range(300)]
    for _ in range(150):
        copy = list(base)
        for at in rng.sample(range(300), rng.randint(1, 12)):
            copy[at] = f"y{rng.randrange(10**9)}"
        texts.append(" ".join(copy))
    sets = {near_copies.fingerprint(t.encode()): set(map(int, near_copies.shingle_hashes(t.encode()))) for t in texts}
    rows = [(k, t, near_copies.fingerprint(t.encode())) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "rid long, text string, fp binary")
    found = near_copies.similar_links(df.select("fp", "rid"), df.select("rid", "text"), bucket=bucket)
    links = [(bytes(r.a), bytes(r.b)) for r in found.collect()]
    # A forest for each group of tiles, not the pairs of a crowd.
    tiles = max(1, -(-2 * 150 // bucket))
    assert bucket < 4096 or len(links) < len(texts)
    assert len(links) < len(texts) * tiles
    alike = [len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in links]
    assert links and min(alike) >= 0.8
    label = {bytes(r.node): bytes(r.label) for r in connected(found).collect()}
    order, parted = sorted(sets), 0
    for k, a in enumerate(order):
        for b in order[:k]:
            if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
                parted += label.get(a, a) != label.get(b, b)
    assert parted <= 4
    docs = df.select(F.col("rid").alias("doc_id"), "text")
    kept = {r.doc_id for r in near_copies.keep_one(docs).collect()}
    assert all(2 * k + 1 in kept for k in range(200) if jaccard(texts[2 * k], texts[2 * k + 1]) < 0.8)


@pytest.mark.parametrize("bucket", [4096, 32])
def test_links_against_all_pairs(spark, bucket):
    """A crowd of near copies of one text among others; small buckets are dealt to tiles."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**9)}" for _ in range(300)]
    texts = []
    for _ in range(300):
        copy = list(base)
        for at in rng.sample(range(300), rng.randint(1, 3)):
            copy[at] = f"y{rng.randrange(10**9)}"
        texts.append(" ".join(copy))
    texts += [" ".join(f"z{rng.randrange(10**9)}" for _ in range(80)) for _ in range(200)]
    prints = sorted({near_copies.fingerprint(t.encode()) for t in texts})
    links = near_copies.find_links(spark.createDataFrame([(f,) for f in prints], "fp binary"), bucket=bucket)
    label = {bytes(r.node): bytes(r.label) for r in connected(links).collect()}
    found, want = {}, plain_classes(prints)
    for f in prints:
        found.setdefault(label.get(f, f), set()).add(f)
    classes = {}
    for f in prints:
        classes.setdefault(want[f], set()).add(f)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, classes.values()))


def test_small_groups_of_copies_in_full_buckets(spark):
    """Texts over one template fill their buckets; each is like one other text only."""
    rng = random.Random(7)
    shared = [rng.randbytes(64) for _ in range(2)]
    prints = []
    for k in range(400):
        first = np.unpackbits(np.frombuffer(shared[k % 2], np.uint8)).copy()
        first[rng.sample(range(512), 70)] ^= 1
        second = first.copy()
        second[rng.sample(range(512), 12)] ^= 1
        prints += [np.packbits(first).tobytes(), np.packbits(second).tobytes()]
    limit = 89
    near = {(a, b) for i, a in enumerate(prints) for b in prints[:i] if (bits(a) ^ bits(b)).bit_count() <= limit}
    assert 350 <= len(near) <= 1000
    links = near_copies.find_links(spark.createDataFrame([(f,) for f in prints], "fp binary"), bucket=16)
    label = {bytes(r.node): bytes(r.label) for r in connected(links).collect()}
    apart = sum(label.get(a, a) != label.get(b, b) for a, b in zip(prints[::2], prints[1::2]))
    assert apart <= 4


def test_odd_rows_and_empty_table(spark):
    rows = [(4, "A b c d e f"), (2, "a B c d e\tf"), (3, None), (5, ""), (6, " \t\n"), (None, "a b c d e f"),
            (7, "one"), (7, "one"), (8, "x " * 70000), (None, "alone here")]
    docs = spark.createDataFrame([Row(doc_id=i, text=t, fp=9, row="r", key=1, tile=2, rid="q") for i, t in rows])
    kept = near_copies.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((repr(r.doc_id) for r in kept.collect())) == ["2", "3", "7", "8", "None"]
    assert near_copies.keep_one(docs.limit(0)).collect() == []


def test_choices_reach_the_gain_at_least_cost():
    costs = np.array([[0, 5.0, 9.0], [0, 2.0, 9.0], [0, 7.0, 8.0]])
    gains = np.array([[0, 1.0, 2.0]] * 3)
    cost, chosen = near_copies.allocate(costs, gains, 3.0)
    assert (cost, chosen) == (10.0, [0, 1, 2])
    assert near_copies.allocate(costs, gains, 7.0) is None
