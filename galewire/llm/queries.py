"""One query per operator over its whole table, and the same in DuckDB SQL where SQL can say it."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galewire.llm import (
    byte_cnn, decontamination, langid, line_dedup, mixing, ngram_trie, periodic_runs, phrases,
    quality_rules, sharding, simhash, token_rollups, warc,
)
from galewire.llm.text import table
from galewire.sources.scratch import materialize, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------- quality rules


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules.apply_policy(quality_rules.ledger(docs))
    return judged.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality_rules.rejected(quality_rules.BASE).alias("base_failed"),
        "kept", "failed_bits", "policy",
    )


ORACLES["op9_quality_rules"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), word AS (
    SELECT rid, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d
), runs AS (
    SELECT rid, i, x || ' ' || lead(x, 1) OVER p || ' ' || lead(x, 2) OVER p || ' '
           || lead(x, 3) OVER p || ' ' || lead(x, 4) OVER p AS g
    FROM word WINDOW p AS (PARTITION BY rid ORDER BY i)
), twice AS (
    SELECT rid, i FROM (
        SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM runs WHERE g IS NOT NULL
    ) WHERE c > 1
), repeats AS (
    SELECT rid, count(DISTINCT i + k) AS n FROM twice, range(0, 5) AS r(k) GROUP BY rid
), lines AS (
    SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
    FROM d
), m AS (
    SELECT doc_id, len(w)::BIGINT AS n_words,
           length(array_to_string(w, ''))::BIGINT AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
           (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
           coalesce(n, 0)::BIGINT AS n_repeat_words,
           len(l) AS n_lines,
           length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) AS n_upper
    FROM d JOIN lines USING (rid) LEFT JOIN repeats USING (rid)
), b AS (
    SELECT *,
        CASE WHEN n_words < 10 THEN 1 ELSE 0 END
        + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
        + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
        + CASE WHEN 10 * n_dup_lines > 4 * n_lines THEN 8 ELSE 0 END
        + CASE WHEN word_chars < 3 * n_words THEN 16 ELSE 0 END
        + CASE WHEN word_chars > 10 * n_words THEN 32 ELSE 0 END
        + CASE WHEN n_words > 0 AND 2 * n_upper > word_chars THEN 64 ELSE 0 END AS bits
    FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       bits = 0 AS kept, bits::BIGINT AS failed_bits, 'web-2' AS policy
FROM b
"""


# ---------------------------------------------------------------- mixing and sharding


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).documents.select(
        F.col("carry.doc_id").alias("doc_id"), "size", "source_size", "target", "taken"
    )


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    digest = F.struct(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32("text").alias("text_crc32"),
    )
    rows = materialize(docs.select(digest.alias("digest"), "source"), "shard-rows")
    return sharding.interleave(rows, "digest", "source").select(
        "digest.*", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


# ---------------------------------------------------------------- decontamination


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, tests = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    judged = decontamination.judge(
        decontamination.find_matches(docs, tests.select("item_id", "text"), ["doc_id"])
    )
    return judged.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated", "longest",
    )


ORACLES["op8_decontamination"] = r"""
WITH fold AS (
    SELECT 'd' AS kind, row_number() OVER () AS rid, text, NULL AS item FROM documents
    UNION ALL SELECT 'b', row_number() OVER (), text, CAST(item_id AS VARCHAR) FROM benchmark
), split AS (
    SELECT kind, rid, item, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM fold
), sizes AS (
    SELECT DISTINCT least(13, len(w)) AS l FROM split WHERE kind = 'b' AND len(w) > 0
), word AS (
    SELECT kind, rid, item, len(w) AS n, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM split
), runs AS (
    SELECT kind, rid, item, n, i, l, string_agg(x, ' ') OVER (
        PARTITION BY kind, rid, l ORDER BY i ROWS BETWEEN CURRENT ROW AND l - 1 FOLLOWING) AS g
    FROM word, sizes
), met AS (
    SELECT d.rid, d.i, d.l, b.item
    FROM runs d JOIN runs b ON d.l = b.l AND d.g = b.g
    WHERE d.kind = 'd' AND b.kind = 'b' AND d.i + d.l - 1 <= d.n
      AND b.i + b.l - 1 <= b.n AND b.l = least(13, b.n)
), hit AS (
    SELECT rid, count(DISTINCT i + k) AS n FROM met, range(0, 13) AS r(k) WHERE k < l GROUP BY rid
), listed AS (
    SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT rid, item FROM met WHERE item IS NOT NULL) GROUP BY rid
), docs AS (
    SELECT row_number() OVER () AS rid, doc_id FROM documents
), deep AS (
    -- Neighbouring windows of one item that follow each other in the text make a longer match.
    SELECT rid, max(c) AS longest FROM (
        SELECT rid, item_rid, lag_, count(*) + 12 AS c FROM (
            SELECT d.rid, b.rid AS item_rid, d.i - b.i AS lag_, d.i - row_number() OVER (
                PARTITION BY d.rid, b.rid, d.i - b.i ORDER BY d.i) AS island
            FROM runs d JOIN runs b ON d.l = b.l AND d.g = b.g
            WHERE d.kind = 'd' AND b.kind = 'b' AND d.i + d.l - 1 <= d.n
              AND b.i + b.l - 1 <= b.n AND b.l = least(13, b.n) AND b.l = 13
        ) GROUP BY rid, item_rid, lag_, island
    ) GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit,
       coalesce(listed.n, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated,
       coalesce(longest, 0)::BIGINT AS longest
FROM docs JOIN (SELECT rid, w FROM split WHERE kind = 'd') USING (rid)
LEFT JOIN hit USING (rid) LEFT JOIN listed USING (rid) LEFT JOIN deep USING (rid)
"""


# ---------------------------------------------------------------- near duplicates


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    marked = simhash.component_ids(simhash.near_duplicates(docs))
    return marked.select(
        F.col("row.doc_id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


# ---------------------------------------------------------------- languages


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", langid.held_out(F.col("doc_id")).alias("held_out")
    )
    prototypes = langid.train(docs.filter("NOT held_out").select("text", "lang"))
    return langid.predict(docs, prototypes, ["doc_id", "held_out"]).select(
        "row.doc_id", "row.held_out", "lang_pred", "score"
    )


# ---------------------------------------------------------------- web archives


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = scratch_path(spark, "warc")
    warc.write_archives(pages, path)
    kind = dict(pages.dtypes)["page_id"]
    return warc.resolved(warc.read_archives(spark, path, with_payload=False)).select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes", "payload_digest",
        F.col("type").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"),
        "problem",
    )


# ---------------------------------------------------------------- language model


@query
def op10_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = ngram_trie.held_out(F.col("doc_id"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held.alias("held_out"))
    return ngram_trie.score(docs, F.col("held_out"), ["doc_id", "held_out"]).select(
        "row.doc_id", "row.held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


# ---------------------------------------------------------------- lines of a site


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    kept = line_dedup.drop_site_lines(
        pages, line_dedup.url_host(F.col("url")), line_dedup.html_lines(F.col("html")), ["page_id"]
    )
    return kept.select(
        F.col("row.page_id").alias("page_id"), "host", "host_pages", "n_lines",
        (F.col("n_lines") - F.size("kept_lines")).alias("n_dropped"),
        F.md5(F.array_join("kept_lines", "\n")).alias("kept_md5"),
    )


ORACLES["op3_line_dedup"] = r"""
WITH shown AS (
    SELECT row_number() OVER () AS rid, page_id,
           nullif(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9.+-]*://([^/?#@]*@)?([^/:?#]+)', 2)), '') AS host,
           regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
               '<script\b[^<>]*>.*?(</script>|\z)|<style\b[^<>]*>.*?(</style>|\z)|<!--.*?(-->|\z)', '', 'gis'),
               '</?(html|head|title|body|header|nav|main|article|section|aside|footer|address|div|p|pre|blockquote'
               || '|ul|ol|li|dl|dt|dd|table|tr|th|td|form|h1|h2|h3|h4|h5|h6|hr|br)\b[^<>]*>', chr(10), 'gi'),
               '<[^<>]*>', '', 'g') AS t
    FROM pages
), p AS (
    SELECT rid, page_id, host, list_filter(list_transform(string_split(t, chr(10)),
           lambda x: trim(x, E' \t\n\x0b\f\r')), lambda x: x <> '') AS l
    FROM shown
), total AS (
    SELECT host, count(*) AS pages FROM p WHERE host IS NOT NULL GROUP BY host
), line AS (
    SELECT rid, host, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM p
), often AS (
    SELECT host, x FROM (SELECT DISTINCT rid, host, x FROM line) JOIN total USING (host)
    GROUP BY host, x, pages HAVING count(*) > 0.2::DOUBLE * pages AND count(*) >= 2
), kept AS (
    SELECT rid, count(*) AS n, string_agg(x, chr(10) ORDER BY i) AS t
    FROM line ANTI JOIN often USING (host, x) GROUP BY rid
)
SELECT page_id, host, coalesce(pages, 0)::BIGINT AS host_pages, len(l)::BIGINT AS n_lines,
       (len(l) - coalesce(n, 0))::BIGINT AS n_dropped, md5(coalesce(t, '')) AS kept_md5
FROM p LEFT JOIN total USING (host) LEFT JOIN kept USING (rid)
"""


# ---------------------------------------------------------------- token counts


@query
def op7_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = [token_rollups.Words("words-1"), token_rollups.ByteBpe.load("byte_bpe_50k-1")]
    ledger = token_rollups.TokenLedger(spark, scratch_path(spark, "tokens"), versions)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return token_rollups.replayed_history(docs, ledger)


# ---------------------------------------------------------------- quality classifier


@query
def op11_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = langid.held_out(F.col("doc_id"))
    network = byte_cnn.train(docs, table(spark, sf_dir, "labels"), ~held)
    scored = byte_cnn.score(docs.withColumn("held_out", held), network, ["doc_id", "held_out"])
    return scored.select(
        "row.doc_id", "row.held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


# ---------------------------------------------------------------- periodic runs


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_period(table(spark, sf_dir, "documents"))
    found = periodic_runs.periodic_runs(docs, ["doc_id"])
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"], (-r["start"]).alias("start"), (-r["period"]).alias("period")
    )))
    return found.select(
        "row.doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period"),
        F.floor(1000 * best["length"] / -best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


ORACLES["op12_periodic_runs"] = r"""
WITH raw AS (
    SELECT row_number() OVER () AS rid, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           -- CRC-32 of the decimal id, bit by bit
           xor(4294967295, list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''),
               lambda x: ascii(x)::BIGINT), lambda c, b: list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0],
               lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) AS h
    FROM documents
), asked AS (
    SELECT *, coalesce(h % 10 = 0 AND len(w) > 0, false) AS planted, (h // 10) % greatest(len(w), 1) AS a,
           1 + (len(w) - (h // 10) % greatest(len(w), 1)) // (3 + (h // 10) % 8) AS p
    FROM raw
), word AS (
    SELECT rid, i, CASE WHEN planted AND i >= a THEN w[1 + a + (i - a) % p] ELSE w[1 + i] END AS x
    FROM (SELECT *, unnest(range(len(w))) AS i FROM asked)
), gram AS (
    -- A run moved by its period agrees with itself over five words at least.
    SELECT rid, i, hash(x, lead(x, 1) OVER s, lead(x, 2) OVER s, lead(x, 3) OVER s, lead(x, 4) OVER s) AS g,
           lead(x, 4) OVER s IS NOT NULL AS whole
    FROM word WINDOW s AS (PARTITION BY rid ORDER BY i)
), pair AS (
    SELECT a.rid, b.i - a.i AS q, a.i FROM gram a JOIN gram b ON a.rid = b.rid AND a.g = b.g AND a.i < b.i
    WHERE a.whole AND b.whole
), island AS (
    SELECT rid, q, min(i) AS start, count(*) + 4 + q AS length FROM (
        SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS k FROM pair
    ) GROUP BY rid, q, k HAVING count(*) + 4 + q >= greatest(6, 4 * q)
), run AS (
    SELECT rid, start, length, min(q) AS period FROM island GROUP BY rid, start, length
), listed AS (
    SELECT rid, count(*) AS n,
           string_agg(start::VARCHAR || ',' || length::VARCHAR || ',' || period::VARCHAR || chr(10), ''
                      ORDER BY start, period) AS t,
           first({'start': start, 'length': length, 'period': period} ORDER BY length DESC, start, period) AS best
    FROM run GROUP BY rid
), gone AS (
    SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM run
), kept AS (
    SELECT rid, string_agg(x, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (rid, i) GROUP BY rid
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_runs, best.start::BIGINT AS start, best.length::BIGINT AS length,
       best.period::BIGINT AS period, (1000 * best.length // best.period)::BIGINT AS exponent_milli,
       sha256(coalesce(listed.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM raw LEFT JOIN listed USING (rid) LEFT JOIN kept USING (rid)
"""


# ---------------------------------------------------------------- phrases


@query
def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.top_phrases(phrases.mine(table(spark, sf_dir, "documents")))


ORACLES["op13_phrases"] = r"""
WITH piece AS (
    SELECT lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS t
    FROM (SELECT coalesce(lang, 'und') AS lang, text FROM documents)
), numbered AS (
    SELECT row_number() OVER () AS pid, lang, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM piece
), word AS (
    SELECT pid, lang, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM numbered
), grams AS (
    SELECT lang, x AS w1, x || ' ' || lead(x, 1) OVER s AS w2,
           x || ' ' || lead(x, 1) OVER s || ' ' || lead(x, 2) OVER s AS w3,
           x || ' ' || lead(x, 1) OVER s || ' ' || lead(x, 2) OVER s || ' ' || lead(x, 3) OVER s AS w4
    FROM word WINDOW s AS (PARTITION BY pid ORDER BY i)
), counted AS (
    SELECT lang, phrase, len(string_split(phrase, ' ')) AS k, count(*) AS f FROM (
        SELECT lang, unnest([w1, w2, w3, w4]) AS phrase FROM grams
    ) WHERE phrase IS NOT NULL GROUP BY lang, phrase HAVING count(*) >= 30
), cand AS (
    SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE k > 1
), cut AS (
    SELECT lang, phrase, a, w, unnest(range(1, k)) AS c FROM cand
), valued AS (
    SELECT cut.lang, cut.phrase, a, c, l.f AS l, r.f AS r, (2000000::HUGEINT * a) // (l.f + r.f) AS score
    FROM cut JOIN counted l ON l.lang = cut.lang AND l.phrase = array_to_string(w[1:c], ' ')
    JOIN counted r ON r.lang = cut.lang AND r.phrase = array_to_string(w[c + 1:], ' ')
), lowest AS (
    SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), inside AS (
    SELECT lang, array_to_string(w[s:s + n - 1], ' ') AS phrase, max(a) AS longer FROM (
        SELECT *, unnest(range(1, k - n + 2)) AS s FROM (SELECT *, unnest(range(2, k)) AS n FROM cand WHERE k > 2)
    ) GROUP BY ALL
), best AS (
    SELECT lowest.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM lowest LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
       score::BIGINT AS score
FROM best JOIN (SELECT lang, count(*) AS n FROM word GROUP BY lang) USING (lang) WHERE rank <= 2000
"""
