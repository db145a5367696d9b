"""The trie and its scores against a plain dictionary model."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from galewire.llm import ngram_trie
from galewire.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plain(docs):
    """[(doc_id, text, held)] to [(doc_id, n_tokens, n_known, train_tokens, base, score)]"""
    seqs = [[w.decode() for w in (t or "").encode().lower().split()] + [None] for _, t, _ in docs]
    words, pairs = Counter(), Counter()
    for (_, _, held), s in zip(docs, seqs):
        if not held:
            words.update(s)
            pairs.update(zip([("<",)] + s[:-1], s))
    begin = sum(not h for _, _, h in docs)
    after = Counter(a for a, _ in pairs)
    n, v = sum(words.values()), len(words)
    out = []
    for (i, _, _), s in zip(docs, seqs):
        base = score = 0.0
        for a, b in zip([("<",)] + s[:-1], s):
            uni = math.log10((words[b] + 0.5) / (n + 0.5 * (v + 1)))
            base += uni
            c = begin if a == ("<",) else words[a]
            if pairs[a, b]:
                score += math.log10((pairs[a, b] - 0.75) / c)
            else:
                score += uni + (math.log10(0.75 * after[a] / c) if after[a] else 0.0)
        out.append((i, len(s), sum(words[w] > 0 for w in s), n, base, score))
    return out


def close(got, want):
    got = sorted(((r.row.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=repr)
    want = sorted(want, key=repr)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for g, w in zip(sorted(got, key=lambda x: (repr(x[0]), x[4])), sorted(want, key=lambda x: (repr(x[0]), x[4]))):
        assert g[4] == pytest.approx(w[4], abs=1e-6)
        assert g[5] == pytest.approx(w[5], abs=w[1] / ngram_trie.STEPS)


@pytest.mark.parametrize("shard_tokens", [ngram_trie.SHARD_TOKENS, 4000])
def test_table_against_dictionaries(spark, shard_tokens):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select(
        "doc_id", "text", (F.crc32(F.col("doc_id").cast("string")) % 5 == 1).alias("h"))
    rows = [(r.doc_id, r.text, zlib.crc32(str(r.doc_id).encode()) % 5 == 1) for r in docs.collect()]
    got = ngram_trie.score(docs, F.col("h"), ["doc_id"], shard_tokens=shard_tokens).collect()
    close(got, plain(rows))


def test_query_columns(spark):
    got = QUERIES["op10_ngram_trie"](spark, FOLDER)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert got.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()


def test_odd_rows(spark):
    rows = [(1, "A b a B"), (2, None), (3, ""), (None, "a b"), (1, "a c"), (5, "x " * 30000), (6, "q"), (6, "q")]
    docs = spark.createDataFrame([Row(doc_id=i, text=t, kind="k", n=1, held=i == 6) for i, t in rows])
    got = ngram_trie.score(docs, F.col("held"), shard_tokens=1000).collect()
    close(got, plain([(i, t, i == 6) for i, t in rows]))


def test_nothing_to_learn_from_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    close(ngram_trie.score(docs, F.lit(True)).collect(), plain([(1, "a b", True)]))
    assert ngram_trie.score(docs.limit(0), F.lit(False)).collect() == []


def test_elias_fano():
    rng = np.random.default_rng(3)
    for n, universe in ((0, 1), (1, 1), (5, 7), (1000, 1 << 40), (4000, 5000), (3, 1 << 61)):
        values = np.unique(rng.integers(0, universe, n))
        ef = ngram_trie.EliasFano(values, universe)
        if len(values):
            assert (ef.access(np.arange(len(values))) == values).all()
        asked = np.concatenate((values, rng.integers(0, universe, 200)))
        want = np.searchsorted(values, asked)
        hit = (want < len(values)) & (values[np.minimum(want, len(values) - 1)] == asked) if len(values) else want < 0
        assert (ef.find(asked) == np.where(hit, want, -1)).all()
