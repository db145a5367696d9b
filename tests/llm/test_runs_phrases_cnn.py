"""Periodic runs, phrases and the byte network against plain versions, and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from galewire.llm import byte_cnn, periodic_runs, phrases
from galewire.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
ROWS = [
    (1, "a b a b a b a b c", "en"),
    (1, "a b a b a b a b c", "en"),
    (2, None, "en"),
    (3, "", None),
    (4, " \t\n\x0b", "fr"),
    (None, "Das Haus, das Haus; das Haus", "de"),
    (5, "word " * 60000, None),
    (6, "die Tür ist offen\x0cdie Tür ist zu", "de"),
    (None, None, None),
]
SCHEMA = "doc_id long, text string, lang string, row string, runs int, shard int, key string, n int, score string, phrase int"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "r", 1, 2, "k", 3, "s", 4) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ---------------------------------------------------------------- runs


def plain_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(i + 1, j)
    return sorted((s, n, q) for (s, n), q in found.items())


def test_runs_against_all_periods():
    rng = random.Random(5)
    for _ in range(1500):
        n, kinds = rng.randint(0, 260), rng.choice([1, 2, 3, 10, 100])
        words = [rng.randrange(kinds) for _ in range(n)]
        for _ in range(rng.randint(0, 4) if n > 8 else 0):
            first = rng.randrange(n)
            period = rng.randint(1, max(1, (n - first) // 2))
            last = rng.randint(first, n)
            for i in range(first, last):
                words[i] = words[first + (i - first) % period]
            if rng.random() < 0.3 and last > first:
                words[rng.randrange(first, last)] = rng.randrange(kinds)
        assert periodic_runs.find_runs(np.array(words, np.int64)) == plain_runs(words)


def test_runs_of_every_period_and_rest():
    rng = random.Random(6)
    for period in range(1, 90):
        for length in (4 * period - 1, 4 * period, 4 * period + period // 2, 9 * period):
            unit = [rng.randrange(10**6) for _ in range(period)]
            words = [-1, -2, -3, *(unit[i % period] for i in range(length)), -4, -5]
            assert periodic_runs.find_runs(np.array(words, np.int64) + 9) == plain_runs(words)


def planted(doc_id, text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_query_of_runs_against_plain(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for doc_id, text in docs:
        words = planted(doc_id, text)
        runs = plain_runs(words)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        short = b" ".join(w for i, w in enumerate(words) if i not in gone)
        want[doc_id] = (
            len(runs), *best, best[0] is not None and 1000 * best[1] // best[2] or None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(short).hexdigest(),
        )
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_periodic_runs"](spark, FOLDER).collect()}
    assert got == want
    assert any(w[0] for w in want.values())


def test_runs_on_odd_rows(odd, empty):
    got = periodic_runs.periodic_runs(odd, ["doc_id", "row"]).collect()
    runs = sorted((str(r.row.doc_id), [tuple(x) for x in r.runs], r.collapsed) for r in got)
    none = hashlib.sha256(b"").hexdigest()
    assert runs == sorted([
        ("1", [(0, 8, 2)], "a b c"), ("1", [(0, 8, 2)], "a b c"), ("2", [], ""), ("3", [], ""), ("4", [], ""),
        ("None", [], "Das Haus, das Haus; das Haus"), ("5", [(0, 60000, 1)], "word"),
        ("6", [], "die Tür ist offen die Tür ist zu"), ("None", [], ""),
    ])
    assert periodic_runs.with_planted_period(odd).count() == len(ROWS)
    assert periodic_runs.periodic_runs(periodic_runs.with_planted_period(empty)).collect() == []
    assert periodic_runs.listed([]) == none


# ---------------------------------------------------------------- phrases


def plain_phrases(rows, least, percent=80, top=2000):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", (text or "").encode().lower()):
            words = re.findall(rb"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    kept = {(x, p): a for (x, p), a in counts.items() if len(p) > 1 and a >= least}
    inside = {
        (x, p[i:j]) for (x, p), f in kept.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
        if j - i < len(p) and 100 * f >= percent * kept[x, p[i:j]]
    }
    out = []
    for lang in sorted({x for x, _ in kept}):
        rows = []
        for (x, p), a in kept.items():
            if x == lang and (x, p) not in inside:
                cuts = [(counts[x, p[:k]], counts[x, p[k:]]) for k in range(1, len(p))]
                score, k = min((2000000 * a // (l + r), k) for k, (l, r) in enumerate(cuts))
                rows.append((-score, -a, b" ".join(p), *cuts[k]))
        for rank, (score, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -score))
    return out


@pytest.mark.parametrize("parts, least", [(1, 30), (13, 30), (13, 4), (29, 7)])
def test_phrases_against_plain_counts(spark, parts, least):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("text", "lang", "doc_id")
    rows = [(r.text, r.lang) for r in docs.collect()]
    got = phrases.top_phrases(phrases.mine(docs.repartition(parts), least=least)).collect()
    assert sorted(map(tuple, got)) == plain_phrases(rows, least)


def test_phrases_on_odd_rows(odd, empty):
    rows = [(r[1], r[2]) for r in ROWS]
    for least in (2, 30):
        got = phrases.top_phrases(phrases.mine(odd, least=least)).collect()
        assert sorted(map(tuple, got)) == plain_phrases(rows, least)
    assert phrases.top_phrases(phrases.mine(empty)).collect() == []


def test_full_bit_table_loses_nothing(spark, monkeypatch):
    """Candidates pass a table that is far too small; only more phrases are counted."""
    monkeypatch.setattr(phrases, "TABLE_BITS", 1 << 10)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.text, r.lang) for r in docs.select("text", "lang").collect()]
    got = phrases.top_phrases(phrases.mine(docs.repartition(5), least=9)).collect()
    assert sorted(map(tuple, got)) == plain_phrases(rows, 9)


def test_rows_of_coded_text_stay_small(spark):
    """However much text a task reads, no row it writes holds more than a slice."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").coalesce(1)
    sizes = phrases.coded(docs).select("lang", "n_words", F.length("codes").alias("n")).collect()
    assert sum(r.n_words for r in sizes) > 4_000_000
    assert max(r.n for r in sizes) < 1 << 20


def test_phrases_of_small_slices(spark, monkeypatch):
    """Slices of some texts, and counts that leave a task many times, give the same."""
    for name, value in (("SLICE_WORDS", 1 << 10), ("TEXT_BYTES", 1 << 11), ("HELD_ROWS", 1 << 10), ("BUCKET_WORDS", 1 << 12)):
        monkeypatch.setattr(phrases, name, value)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.text, r.lang) for r in docs.select("text", "lang").collect()]
    got = phrases.top_phrases(phrases.mine(docs.repartition(3), least=9)).collect()
    assert sorted(map(tuple, got)) == plain_phrases(rows, 9)


def test_phrases_of_a_slice_with_many_words(spark):
    """Word numbers of more than 16 bits."""
    text = " ".join(f"w{i}" for i in range(70_000))
    rows = [(text, "en"), (f"{text} w69999 w69998", "en"), (" w69998 w69999", "en")]
    got = phrases.top_phrases(phrases.mine(spark.createDataFrame(rows, "text string, lang string"), least=2)).collect()
    assert sorted(map(tuple, got)) == plain_phrases(rows, 2)


# ---------------------------------------------------------------- the byte network


def test_gradients_against_differences():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(0, 256, n, np.uint8)) for n in (0, 1, 63, 64, 200, 700)]
    labels, weights = np.array([0, 1, 1, 0, 1, 0], np.float32), np.array([1, 2, 1, 1, 3, 1], float)
    network = byte_cnn.Network()
    network.w = {k: v.astype(np.float32) + np.float32(0.05) * rng.normal(size=v.shape).astype(np.float32) for k, v in network.w.items()}

    def loss():
        s = network.scores(texts)
        return -(weights * np.where(labels == 1, np.log(s), np.log(1 - s))).sum() / weights.sum()

    found = network.gradients(texts, labels, weights)
    for name, g in found.items():
        flat = network.w[name].reshape(-1)
        for at in np.argsort(-np.abs(g.reshape(-1)))[:3]:
            kept, step = flat[at], np.float32(2e-3)
            flat[at] = kept + step
            up = loss()
            flat[at] = kept - step
            down = loss()
            flat[at] = kept
            assert (up - down) / (2 * step) == pytest.approx(g.reshape(-1)[at], rel=0.08, abs=2e-4), name


def test_every_byte_counts_and_batches_do_not():
    network = byte_cnn.Network()
    texts = [b"", b"x", b"some words " * 90, b"y" * 5000]
    alone = [network.scores([t])[0] for t in texts]
    assert network.scores(texts) == pytest.approx(alone, abs=1e-6)
    long = b"plain text " * 3000
    assert network.scores([long + b"#$%&*" * 20])[0] != pytest.approx(network.scores([long])[0], abs=1e-9)


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op11_byte_cnn"](spark, folder)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert got.filter("held_out <> (crc32(CAST(doc_id AS STRING)) % 5 = 0) OR score < 0 OR score > 1").isEmpty()
    assert got.filter("predicted <> IF(score >= 0.3, 1, 0)").isEmpty()
    rows = got.filter("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    above = sum((a > b) + (a == b) / 2 for a in good for b in bad) / (len(good) * len(bad))
    assert above > 0.95
    assert sum(r.predicted == r.quality for r in rows) > 0.9 * len(rows)


def test_network_on_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame(
        [(1, 1), (1, 1), (5, 0), (6, 1), (2, None), (None, 0), (99, 1)], "doc_id long, quality int"
    )
    network = byte_cnn.train(odd, labels, F.lit(True))
    scored = byte_cnn.score(odd, network, ["doc_id", "score"]).collect()
    assert len(scored) == len(ROWS) and all(0 <= r.score <= 1 for r in scored)
    assert len({r.score for r in scored if r.row.doc_id in (2, 3)}) == 1
    for one, want in ((labels.filter("quality = 1"), 1.0), (labels.filter("quality = 0"), 0.0), (labels.limit(0), 1.0)):
        constant = byte_cnn.train(odd, one, F.lit(True))
        assert {r.score for r in byte_cnn.score(odd, constant).collect()} == {want}
    assert byte_cnn.score(empty, network).collect() == []
