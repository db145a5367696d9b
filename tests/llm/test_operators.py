"""Operators on odd rows and empty tables, and against plain versions."""

import base64
import gzip
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from galewire.llm import (
    decontamination, langid, line_dedup, mixing, quality_rules, sharding, token_rollups, warc,
)
from galewire.llm.queries import ORACLES, QUERIES
from galewire.sources.scratch import materialize, scratch_path
from tests.compare import compare, duck
from tests.llm.test_near_copies import plain_first

FOLDER = "/root/testdata/sf0.001"

# Nulls in every column, empty, blank and long texts, ties, repeated rows; and further columns
# whose names the operators use themselves.
ROWS = [
    (1, "One two three four five six seven eight nine ten eleven twelve thirteen", "en", "a"),
    (1, "One two three four five six seven eight nine ten eleven twelve thirteen", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, "b"),
    (4, " \t\n", "fr", None),
    (None, "le chat et le chien sont dans la maison avec les enfants et le jardin", "fr", "b"),
    (5, "word " * 60000, None, None),
    (6, "le chat et le chien sont dans la maison avec les enfants et le jardin", "fr", "b"),
    (7, "123 456", "en", "c"),
]
EXTRA = "row string, size int, shard int, slot string, kept string, n_words int, class int, rid int"
SCHEMA = f"doc_id long, text string, lang string, source string, {EXTRA}"


@pytest.fixture(scope="module")
def odd(spark):
    more = ("r", 1, 2, "s", "k", 3, 4, 5)
    return spark.createDataFrame([(*r, *more) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_has_the_rows_of_its_sql(spark, name):
    assert compare(spark, duck(FOLDER), FOLDER, QUERIES[name], ORACLES[name]) is None


# ---------------------------------------------------------------- quality rules


def plain_measures(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\f\r")]
    runs = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
    twice = {r for r, n in Counter(runs).items() if n > 1}
    hit = {k + j for k, r in enumerate(runs) if r in twice for j in range(5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit))


def test_rules_on_odd_rows(odd, empty):
    book = quality_rules.apply_policy(quality_rules.ledger(odd))
    got = [tuple(r[c] for c in quality_rules.MEASURES[:5]) for r in book.collect()]
    assert sorted(got) == sorted(plain_measures(r[1]) for r in ROWS)
    kept = quality_rules.keep_good(odd)
    assert kept.columns == odd.columns
    assert sorted(repr(r.doc_id) for r in kept.collect()) == ["1", "1", "6", "None"]
    assert quality_rules.keep_good(empty).collect() == []
    assert quality_rules.ablation(quality_rules.ledger(empty)).collect() == []


def test_random_texts_and_ablation(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["aa", "b", "C*", "dd\n"]) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    book = materialize(quality_rules.ledger(spark.createDataFrame([(t,) for t in texts], "text string")), "t")
    rows = book.collect()
    assert {r.row.text: tuple(r[c] for c in quality_rules.MEASURES[:5]) for r in rows} == {
        t: plain_measures(t) for t in texts
    }
    place = {r.name: k for k, r in enumerate(quality_rules.RULES)}
    enforced = quality_rules.POLICIES["web-1"]
    for r in quality_rules.ablation(book, "web-1").collect():
        others = quality_rules.mask([n for n in enforced if n != r.rule])
        assert r.n_failed == sum(x.failed_bits >> place[r.rule] & 1 for x in rows)
        assert r.n_kept_without == sum(not x.failed_bits & others for x in rows)
        assert r.n_only == sum(
            x.failed_bits & quality_rules.mask(enforced) == 1 << place[r.rule] for x in rows)


# ---------------------------------------------------------------- mixing and sharding


def plain_targets(sizes, weights=(5, 2, 1)):
    """Targets by handing the excess round again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(3 * sizes[s] for s in capped)
        target = {s: 3 * sizes[s] for s in capped} | {
            s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if target[s] > 3 * sizes[s]}
        if not over:
            return target
        capped |= over


def check_mix(rows, made):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    want, taken = plain_targets(sizes), defaultdict(int)
    for r in made:
        assert r.taken <= 3 * r.size and r.target == pytest.approx(want[r.carry.source])
        assert r.source_size == sizes[r.carry.source]
        taken[r.carry.source] += r.taken
    assert len(made) == len(rows)
    for s, target in want.items():
        assert target - 1.001 <= taken[s] <= target + 0.001


@pytest.mark.parametrize("block_words", [7, 1024])
def test_mix_meets_its_targets(spark, block_words):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn(
        "source", F.when(F.col("source") != "src3", F.col("source")))
    made = mixing.mix(docs, ["doc_id", "source"], block_words=block_words)
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    found = made.documents.collect()
    check_mix(rows, found)
    pieces = defaultdict(int)
    for p in made.pieces.collect():
        pieces[p.carry.doc_id] += p.n_words
    assert {r.carry.doc_id: r.taken for r in found if r.taken} == dict(pieces)
    again = mixing.mix(docs.repartition(3), ["doc_id", "source"], block_words=block_words).documents
    assert sorted(again.collect()) == sorted(found)


def test_mix_of_odd_rows(odd, empty):
    check_mix(ROWS, mixing.mix(odd, ["doc_id", "source"], block_words=3).documents.collect())
    assert mixing.mix(empty).documents.collect() == []
    out = mixing.mixed_documents(odd)
    assert out.columns == odd.columns and mixing.mixed_documents(empty).collect() == []
    assert {2, 3, 4} <= {r.doc_id for r in out.collect()}


def test_golden_points_are_even(spark):
    x = [r[0] / mixing.RANGE for r in spark.range(1000).select(mixing.golden_point(F.col("id"))).collect()]
    assert np.allclose(x, [(n * (5 ** 0.5 - 1) / 2) % 1 for n in range(1000)], atol=1e-5)
    assert max(np.histogram(x, 50)[0]) <= 22


def test_shards_hold_the_mixture(spark, odd, empty):
    n = 1003
    docs = spark.range(n).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 > 0, (F.col("id") % 7).cast("string")).alias("source"))
    out = sharding.shard_documents(docs).collect()
    assert sorted(r.doc_id for r in out) == list(range(n))
    of = defaultdict(list)
    for r in out:
        of[r.shard].append(r)
    assert sorted(of) == list(range(16)) and {len(x) for x in of.values()} <= {n // 16, n // 16 + 1}
    total = Counter(r.source for r in out)
    for rows in of.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
        for source, k in total.items():
            assert abs(sum(r.source == source for r in rows) - k / 16) <= 2
    whole = sharding.shard_documents(odd)
    assert sorted(whole.columns) == sorted(odd.columns) and whole.count() == len(ROWS)
    assert sharding.shard_documents(empty).collect() == []


def test_sharding_query_against_plain(spark):
    """Ranks, fractions, cuts and slots one by one in Python; only the seeded hash is Spark's."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    struct = F.struct(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32("text").alias("text_crc32"))
    keyed = docs.select(struct.alias("d"), "text", "source").withColumn(
        "key", F.shiftrightunsigned(F.xxhash64(F.lit(sharding.SEED), "d"), 1)).collect()
    of = defaultdict(list)
    for r in keyed:
        of[r.source is None, r.source].append((r.key, r.d.doc_id))
    spread = []
    for source, rows in of.items():
        for rank, (key, i) in enumerate(sorted(rows)):
            spread.append(((rank + 0.5) / len(rows), source, key, i))
    n, want, slots = len(spread), {}, Counter()
    for at, (_, _, _, i) in enumerate(sorted(spread)):
        shard = at * 16 // n
        want[i] = (shard, slots[shard])
        slots[shard] += 1
    text = {r.d.doc_id: r.text for r in keyed}
    got = QUERIES["op2_sharding"](spark, FOLDER).collect()
    assert {r.doc_id: (r.shard, r.slot) for r in got} == want and len(got) == len(keyed)
    for r in got:
        raw = text[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)


# ---------------------------------------------------------------- languages


def plain_language_vectors(text, seed=langid.SEED, size=langid.DIMENSIONS, cache={}):
    """Sum of bound runs of three symbols, letter by letter."""
    def letter(c):
        if c not in cache:
            rng = np.random.default_rng([seed, c])
            cache[c] = rng.integers(0, 2, size, np.int8).astype(np.int64) * 2 - 1
        return cache[c]

    symbols = [0]
    for c in text:
        low = c.lower() if len(c.lower()) == 1 else c
        if c.isalpha():
            symbols.append(ord(low))
        elif symbols[-1]:
            symbols.append(0)
    symbols += [0] if symbols[-1] else []
    total, seen = np.zeros(size), Counter(zip(symbols, symbols[1:], symbols[2:]))
    for (a, b, c), n in seen.items():
        if b:
            total += n * np.roll(letter(a), 2) * np.roll(letter(b), 1) * letter(c)
    return total


def test_language_query_against_plain(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang").collect()
    vectors = {r.doc_id: plain_language_vectors(r.text) for r in docs}
    unit = lambda v: v / max(np.linalg.norm(v), 1e-12)
    known = defaultdict(lambda: np.zeros(langid.DIMENSIONS))
    for r in docs:
        if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 5:
            known[r.lang] += unit(vectors[r.doc_id])
    got = {r.doc_id: r for r in QUERIES["op4_language_id"](spark, FOLDER).collect()}
    assert len(got) == len(docs)
    for r in docs:
        cosines = {k: float(unit(v) @ unit(vectors[r.doc_id])) for k, v in known.items()}
        best = max(sorted(cosines), key=cosines.get)
        g = got[r.doc_id]
        assert g.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert g.lang_pred == (best if vectors[r.doc_id].any() else "und")
        assert g.score == pytest.approx(max(0, cosines[best]), abs=1e-4)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op4_language_id"](spark, "/root/testdata/sf0.01").filter("held_out AND lang_pred <> 'und'")
    right = got.join(docs, "doc_id").select((F.col("lang") == F.col("lang_pred")).cast("int").alias("x")).agg(F.avg("x"))
    assert right.first()[0] > 0.98


def test_languages_of_odd_rows(odd, empty):
    known = langid.train(odd.select("text", "lang"))
    assert set(known) == {"en", "fr"}
    got = {(r.row.doc_id, r.lang_pred) for r in langid.predict(odd, known).collect()}
    assert {(2, "und"), (3, "und"), (4, "und"), (7, "und"), (6, "fr"), (1, "en")} <= got
    assert langid.predict(empty, known).collect() == [] and langid.train(empty.select("text", "lang")) == {}
    assert {r.score for r in langid.predict(odd, {}).collect()} == {0.0}


def test_bundle_is_the_sum_of_bound_runs():
    space = langid.Space(64, 3)
    runs = langid.runs("Ab, a")
    symbols = [0, ord("a"), ord("b"), 0, ord("a"), 0]
    want = sum(
        np.roll(space.letter(a), 2).astype(int) * np.roll(space.letter(b), 1) * space.letter(c)
        for a, b, c in zip(symbols, symbols[1:], symbols[2:]) if b)
    assert (space.bundle(runs) == want).all()


# ---------------------------------------------------------------- archives


def test_archives_round_trip(spark):
    big = "\r\n\r\nWARC/1.1\r\n" + "é" * 50000
    rows = [(3, "http://a/", "x"), (1, "http://b/", "x"), (1, "http://b/", "x"), (5, None, None), (4, "http://c/\r\nX: y", ""),
            (None, "http://d/", "x"), (7, "http://e/", big), (8, "http://f/", big + "z")]
    pages = spark.createDataFrame([(*r, "q") for r in rows], "page_id long, url string, html string, record string")
    path = scratch_path(spark, "test-warc")
    warc.write_archives(pages, path, segment_bytes=4096)
    got = warc.resolved(warc.read_archives(spark, path)).collect()
    assert len(got) == len(rows) and all(r.problem is None for r in got)
    for r in got:
        html = next(h or "" for i, _, h in rows if str(i) == str(r.page_id)).encode()
        assert r.payload_bytes == len(html)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(html).digest()).decode()
        assert r.type == "revisit" or bytes(r.payload) == html
    kinds = sorted((str(r.page_id), r.type, str(r.refers_to)) for r in got)
    assert kinds == sorted([
        ("1", "response", "None"), ("1", "revisit", "1"), ("3", "revisit", "1"), ("None", "revisit", "1"),
        ("4", "response", "None"), ("5", "revisit", "4"), ("7", "response", "None"), ("8", "response", "None")])
    nothing = scratch_path(spark, "test-warc")
    warc.write_archives(pages.limit(0), nothing)
    assert warc.read_archives(spark, nothing).collect() == []


def test_broken_segments_are_named(spark):
    page = {"record": "r", "page_id": "1", "url": None, "refers": None, "payload": b"abc" * 5000}
    for gone, problem in ((None, None), (0, "missing segment"), (1, "missing segment"), (-1, "missing segment")):
        parts = list(warc.records(page, 1000))
        if gone is not None:
            del parts[gone]
        path = scratch_path(spark, "test-warc")
        spark.createDataFrame([(p.decode(),) for p in parts], "value string").write.option("lineSep", warc.END).text(path)
        assert [r.problem for r in warc.read_archives(spark, path).collect()] == [problem]
    with pytest.raises(ValueError):
        warc.unchunked(b"3\r\nabcX\r\n0\r\n\r\n")


def test_archive_query_against_plain(spark):
    pages = [(r.page_id, (r.html or "").encode()) for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()]
    first = {}
    for i, raw in sorted(pages):
        first.setdefault(raw, i)
    want = {}
    for i, raw in pages:
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        again = first[raw] != i
        want[i] = (len(raw), digest, "revisit" if again else "response", first[raw] if again else None, None)
    got = QUERIES["op6_warc"](spark, FOLDER).collect()
    assert {r.page_id: tuple(r)[1:] for r in got} == want and len(got) == len(pages)


def test_damage_is_named_and_costs_itself(spark, tmp_path):
    page = lambda k: {"record": f"r{k}", "page_id": str(k), "url": None, "refers": None, "payload": b"p%d" % k}
    good = [next(warc.records(page(k), 1 << 15)) + b"\r\n\r\n" for k in range(4)]
    no_type = good[1].replace(b"WARC-Type: response\r\n", b"")
    wrong = good[1].replace(b"Content-Length: ", b"Content-Length: 9")
    info = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:i>\r\nContent-Length: 1\r\n\r\nx\r\n\r\n"
    files = {
        "cut": (good[0] + good[1][:-9], ["record cut off"], "0"),
        "wrong": (good[0] + wrong + good[2], ["record cut off"], "02"),
        "garbled": (good[0] + b"\x00\xff junk\r\nmore junk\r\n" + good[2], ["no WARC record"], "02"),
        "head": (good[0] + no_type + good[2], ["bad record head"], "02"),
        "number": (good[0].replace(b"Content-Length", b"WARC-Segment-Number: x\r\nContent-Length") + good[3], ["bad record head"], "3"),
        "foreign": (b"PK\x03\x04 not an archive\n\nat all", ["no WARC record"], ""),
        "other": (info + good[3], [], "3"),
        "zipped": (gzip.compress(b"".join(good)), [], "0123"),
        "torn": (gzip.compress(b"".join(good) + bytes(random.Random(1).randbytes(5000)))[:-2000], None, "0123"),
        "empty": (b"", [], ""),
    }
    for name, (content, problems, pages) in files.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.warc").write_bytes(content)
        got = warc.resolved(warc.read_archives(spark, str(tmp_path / name))).collect()
        found = [r.problem for r in got if r.type == "damaged"]
        assert (found == problems) if problems is not None else "broken gzip stream" in found, name
        assert "".join(sorted(r.page_id for r in got if r.type == "response" and r.problem is None)) == pages, name


# ---------------------------------------------------------------- decontamination


def test_benchmark_in_blocks_and_odd_rows(spark, odd, empty):
    tests = spark.createDataFrame(
        [(10, "five six SEVEN, eight"), (9, "one two three"), (10, "thirteen"), (None, "chat et le"), (11, None), (12, "?!")],
        "item_id long, text string")

    def found(**limits):
        out = decontamination.judge(decontamination.find_matches(odd, tests, **limits)).collect()
        return sorted((repr(r.row.doc_id), r.n_words, r.n_hit, tuple(r.items), r.longest, r.contaminated) for r in out)

    whole = found()
    assert ("1", 13, 8, ("10", "9"), 4, True) in whole and ("6", 15, 3, (), 3, True) in whole
    assert ("2", 0, 0, (), 0, False) in whole and ("5", 60000, 0, (), 0, False) in whole
    assert found(block_bytes=20) == whole
    assert decontamination.drop_contaminated(odd, tests).columns == odd.columns
    assert decontamination.drop_contaminated(empty, tests).collect() == []
    assert decontamination.drop_contaminated(odd, tests.limit(0)).count() == len(ROWS)


def test_matches_are_those_of_a_plain_search():
    rng = random.Random(4)
    word = lambda: rng.choice("abc").encode()
    for _ in range(30):
        items = [(str(k), b" ".join(word() for _ in range(rng.randint(1, 9)))) for k in range(5)]
        texts = [b" ".join(rng.choice([word(), b"zz"]) for _ in range(rng.randint(0, 40))) for _ in range(6)]
        got = decontamination.search_shard(texts, [None] * 6, decontamination.Suffixes(items, 4))
        for text, g in zip(texts, got):
            w, hit, names = text.split(), set(), set()
            for name, item in items:
                v = item.split()
                size = min(4, len(v))
                for i in range(len(v) - size + 1):
                    for j in range(len(w) - size + 1):
                        if w[j:j + size] == v[i:i + size]:
                            hit |= set(range(j, j + size))
                            names.add(name)
            spans = g["spans"]
            assert {k for a, b in zip(spans[::2], spans[1::2]) for k in range(a, b)} == hit
            assert g["items"] == sorted(names) and (g["longest"] > 0) == bool(hit)
            if g["longest"]:
                piece = b" ".join(w[g["longest_at"]:g["longest_at"] + g["longest"]])
                assert piece in dict(items)[g["longest_item"]]


# ---------------------------------------------------------------- lines and token counts


def test_site_lines(spark):
    pages = [(k, "http://h.org/x", f"menu\nown {k}\n menu\nfooter {k % 2}") for k in range(10)]
    pages += [(20 + k, "http://small.org/", "menu") for k in range(4)] + [(30, None, "menu"), (31, "http://h.org/", None)]
    df = spark.createDataFrame([(*p, 1, "x") for p in pages], "page_id long, url string, text string, host int, lines string")
    out = line_dedup.drop_site_lines(df, line_dedup.url_host(F.col("url")), line_dedup.text_lines(F.col("text")), ratio=0.6)
    got = {r.row.page_id: (r.host_pages, r.kept_lines) for r in out.collect()}
    assert got[3] == (11, ["own 3", "footer 1"]) and got[20] == (4, [])
    assert got[30] == (0, ["menu"]) and got[31] == (11, []) and len(got) == len(pages)
    assert line_dedup.drop_site_lines(df.limit(0), F.col("url"), line_dedup.text_lines(F.col("text"))).collect() == []


def test_query_drops_lines(spark, tmp_path):
    """Made pages with known lines, hosts of all sizes, through the query."""
    head = "<html><head><title>Shop</title><style>\nx{}</style></head><body><nav>Home | About</nav>"
    pages = [(k, "https://U:p@Big.org:8/a", f"{head}<p>Text <b>number</b> {k}</p><!-- no\nline --><div>(c) Big</div>") for k in range(20)]
    pages += [(30, "http://two.org/", "<p>Menu</p><p>one</p>"), (31, "http://two.org/x", "<li> Menu\t</li>two")]
    pages += [(40, "http://one.org/", "<p>Menu</p><p>Menu</p>"), (41, None, "<p>Menu"), (42, "http://big.org/", None)]
    pages += [(43, "http://big.org/y", "<script>" + "<b>x\n" * 20000 + "<style>tail")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: (r.host, r.host_pages, r.n_lines, r.n_dropped, r.kept_md5) for r in QUERIES["op3_line_dedup"](spark, str(tmp_path)).collect()}
    md5 = lambda *lines: hashlib.md5("\n".join(lines).encode()).hexdigest()
    assert got[7] == ("big.org", 22, 4, 3, md5("Text number 7"))
    assert got[30] == ("two.org", 2, 2, 1, md5("one")) and got[31] == ("two.org", 2, 2, 1, md5("two"))
    assert got[40] == ("one.org", 1, 2, 0, md5("Menu", "Menu")) and got[41] == (None, 0, 1, 0, md5("Menu"))
    assert got[42] == ("big.org", 22, 0, 0, md5()) and len(got) == len(pages)


def test_rollups_replay_and_revise(spark, odd):
    ledger = token_rollups.TokenLedger(spark, scratch_path(spark, "test-tokens"), [token_rollups.Words("w")])
    change = lambda *rows: spark.createDataFrame(
        list(rows), "doc_id long, op string, text string, source string, lang string")
    totals = lambda: {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in ledger.totals().collect()}
    assert totals() == {}
    first = change((1, "insert", "a b c", "s", "en"), (2, "insert", None, "s", None), (3, "insert", "x y", "t", "en"),
                   (3, "insert", "x y", "t", "en"), (None, "insert", "n", None, "fr"))
    ledger.commit(1, first)
    one = {("s", "en"): (1, 3), ("s", None): (1, 0), ("t", "en"): (1, 2), (None, "fr"): (1, 1)}
    assert totals() == one
    second = change((1, "revise", "a b c d", "t", "en"), (3, "delete", None, None, None), (9, "delete", None, None, None))
    for batch, changes in ((2, second), (1, first), (2, second)):
        ledger.commit(batch, changes)
    assert totals() == {("t", "en"): (1, 4), ("s", None): (1, 0), (None, "fr"): (1, 1)}
    ledger.commit(3, first.limit(0))
    assert len(totals()) == 3
    # Texts of equal counts, and documents without an id, are told apart; equal changes are not.
    ledger.commit(4, change((6, "insert", "a b", "z", "en"), (6, "insert", "c d", "z", "en"), (6, "insert", "c d", "z", "en"),
                            (None, "insert", "e f", "z", "en"), (None, "insert", "g h", "z", "en")))
    assert totals()["z", "en"] == (4, 8) and (None, "fr") not in totals()
    # Deletes of a batch come first; other ops are no changes.
    ledger.commit(5, change((6, "insert", "x", "z", "en"), (6, "delete", None, None, None), (1, "upsert", "n", "n", "n")))
    assert totals() == {("t", "en"): (1, 4), ("s", None): (1, 0), ("z", "en"): (3, 5)}
    whole = token_rollups.TokenLedger(spark, scratch_path(spark, "test-tokens"), [token_rollups.ByteBpe.load("b")])
    whole.commit(1, odd.select("doc_id", F.lit("insert").alias("op"), "text", "source", "lang"))
    assert whole.totals().agg(F.sum("n_docs")).first()[0] == len(ROWS) - 1


def test_commit_reads_touched_buckets_only(spark):
    ledger = token_rollups.TokenLedger(spark, scratch_path(spark, "test-tokens"), [token_rollups.Words("w")])
    rows = spark.range(500).select(
        F.col("id").alias("doc_id"), F.lit("insert").alias("op"), F.lit("a b").alias("text"),
        F.lit("s").alias("source"), F.lit("en").alias("lang"))
    ledger.commit(1, rows)
    ids = rows.filter("doc_id IN (3, 400)").select("doc_id", ledger._bucket()).distinct()
    known = ledger.known(ids, 2)
    assert sorted(r.doc_id for r in known.collect()) == [3, 400]
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    read = known._jdf.queryExecution().optimizedPlan().toString()
    assert read.index("Join LeftSemi") > read.index("Aggregate")


def test_query_totals_against_plain_counts(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    seen, want = set(), Counter()
    bpe = token_rollups.ByteBpe.load("byte_bpe_50k-1")
    for d in sorted(docs, key=lambda r: r.doc_id):
        if d.text not in seen:
            seen.add(d.text)
            text = "\n".join(dict.fromkeys(d.text.split("\n")))
            want[d.source, d.lang, "words-1"] += len(text.split())
            want[d.source, d.lang, bpe.version] += bpe.count(text)
    got = QUERIES["op7_token_rollups"](spark, FOLDER).collect()
    assert {(r.source, r.lang, r.version): r.n_tokens for r in got} == dict(want)


# ---------------------------------------------------------------- the pipeline


def test_stages_take_odd_rows_and_empty_tables(spark, odd, empty):
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, FOLDER)
            assert set(docs.columns) <= set(out.columns), name
            assert docs is odd or out.collect() == []
            out.collect()


def test_pipeline_repeats(spark, tmp_path):
    """Two runs, and a run over the same rows in other files and another order, give the same rows."""
    rows = lambda folder: sorted(
        (r.doc_id, r.text, r.source, r.shard, r.slot) for r in corpus_pipeline.run(spark, folder).collect())
    once = rows(FOLDER)
    assert len({(r[3], r[4]) for r in once}) == len(once)
    spark.read.parquet(f"{FOLDER}/documents.parquet").repartition(7, F.rand(5)).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{FOLDER}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert rows(str(tmp_path)) == once
    assert rows(FOLDER) == once


def test_pipeline_against_plain_stages(spark):
    """Rules, dedup and decontamination judged one by one in Python over the whole table."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    book = quality_rules.apply_policy(quality_rules.ledger(spark.read.parquet(f"{FOLDER}/documents.parquet")))
    good = {r.row.doc_id for r in book.filter("kept").collect()}
    left = [(i, t) for i, t in docs if i in good]
    first = plain_first(left)
    tests = decontamination.Suffixes(
        [(str(r.item_id), r.text.encode()) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()], 13)
    clean = set()
    for i, t in left:
        if i in first:
            g = decontamination.search_shard([t.encode()], [None], tests)[0]
            hit = sum(g["spans"][1::2]) - sum(g["spans"][::2])
            if not hit or 20 * hit < g["n_words"]:
                clean.add(i)
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        frame = materialize(stage(spark, frame, FOLDER), f"test-{name}")
    assert sorted(r.doc_id for r in frame.collect()) == sorted(clean)
    out = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in out} <= clean
    assert max(Counter(r.doc_id for r in out).values()) <= 3
    sizes = Counter(r.shard for r in out)
    assert max(sizes.values()) - min(sizes.values()) <= 1
