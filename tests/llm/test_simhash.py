"""Near duplicates against all pairs, and the parts they are found by."""

import random

import pytest
import xxhash
from pyspark.sql import Row

from galewire.llm import simhash
from galewire.llm.components import connected
from galewire.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance=3):
    """Least id reachable, by comparing all pairs. prints: [(id, fingerprint)]"""
    values = sorted({f for _, f in prints})
    root = {f: f for f in values}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for k, a in enumerate(values):
        for b in values[:k]:
            if (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    least = {}
    for i, f in prints:
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return sorted(((i, f, least.get(find(f))) for i, f in prints), key=repr)


def test_query_against_all_pairs(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    want = plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in docs])
    got = QUERIES["op5_simhash"](spark, FOLDER).collect()
    assert sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in got), key=repr) == want
    assert len({r.component_id for r in got}) < len(got)


def test_odd_rows(spark):
    rows = [(1, "A b c d"), (2, "a B c d"), (3, None), (4, ""), (5, " \t\n"), (None, "a b c d"),
            (7, "one"), (7, "one"), (8, "x " * 70000)]
    docs = spark.createDataFrame([Row(doc_id=i, text=t, fp=9, row="r", keep=1) for i, t in rows])
    got = simhash.component_ids(simhash.near_duplicates(docs)).collect()
    found = sorted(((r.row.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=repr)
    assert found == plain_components([(i, plain_fingerprint(t)) for i, t in rows])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.component_ids(simhash.near_duplicates(docs)).collect() == []


@pytest.mark.parametrize("bucket", [4096, 64, 8])
def test_crowded_fingerprints(spark, bucket):
    """A dense cloud of fingerprints, so that buckets overflow and are dealt again."""
    rng = random.Random(5)
    middle = rng.getrandbits(64)
    values = {rng.getrandbits(64) for _ in range(300)}
    while len(values) < 900:
        f = middle
        for b in rng.sample(range(20), rng.randint(0, 8)):
            f ^= 1 << (3 * b)
        values.add(f)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in values]
    links = simhash.find_links(spark.createDataFrame(signed, "fp long"), bucket=bucket)
    edges = [(a % (1 << 64), b % (1 << 64)) for a, b in links.collect()]
    assert all((a ^ b).bit_count() <= 64 for a, b in edges)
    label = {r.node % (1 << 64): r.label for r in connected(links).collect()}
    want = plain_components([(f, f) for f in values])
    classes = {}
    for f, _, c in want:
        classes.setdefault(c, set()).add(label.get(f, f))
    assert all(len(x) == 1 for x in classes.values())
    assert len(classes) == len({label.get(f, f) for f in values})


def test_thresholds_sum_up():
    costs = [[0, 5, 50, 500], [0, 1, 2, 300], [0, 7, 70, 700]]
    cost, chosen = simhash.allocate(costs, 1)
    assert sum(chosen) == 1 and cost == min(
        costs[0][a + 1] + costs[1][b + 1] + costs[2][1 - a - b + 1]
        for a in range(-1, 3) for b in range(-1, 3) if -1 <= 1 - a - b <= 2
    )


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(k * 7919 % 4001, (k + 1) * 7919 % 4001) for k in range(500)], "a long, b long")
    out = connected(chain).collect()
    assert len(out) == 501 and len({r.label for r in out}) == 1
