"""Token counts kept up to date by signed changes.

A batch of changes (insert, revise, delete) becomes signed rows: the new count of a document with
+, what the ledger knew of it before with -. Totals by source, language and tokenizer version are
plain sums of the batches' rollups.

A store is a folder: ``ledger`` (signed rows per document), ``rollup`` (their sums) and ``commits``,
each with a folder for every batch. A batch is numbered; it sees the batches before it only and
replaces its own folders, and its commit is written last: to commit a batch again, after a failure
or by mistake, changes nothing. The ledger is cut into ``buckets`` by a hash of the id; a commit reads
the buckets its changes touch, and of these only the touched ids are grouped and summed.

Defined results: a null text counts no tokens; insert and revise both replace what the ledger holds
of the document before the batch; a batch has no order, so its deletes come first: a document deleted
and inserted in one batch is there afterwards. Deleting an unknown document does nothing; other ops
are ignored. Changes equal in id, source, language and text count once in a batch, different ones of
one document all count, also those whose counts are equal. Documents with a null id are one document;
null source and language are groups of their own. An empty batch changes nothing.
"""

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from galewire.sources.scratch import materialize

BUCKETS = 64
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the published split pattern of this byte-level vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_ENCODINGS: dict[str, object] = {}


@dataclass(frozen=True)
class ByteBpe:
    """A tokenizer whose ranks, a few megabytes at most, travel with the tasks."""

    version: str
    ranks: bytes
    pattern: str = PATTERN

    @staticmethod
    def load(version: str, path: str = TOKENIZER) -> "ByteBpe":
        with open(path, "rb") as file:
            return ByteBpe(version, file.read())

    def count(self, text: str) -> int:
        if self.version not in _ENCODINGS:
            import tiktoken

            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, self.ranks.splitlines())}
            _ENCODINGS[self.version] = tiktoken.Encoding(
                self.version, pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={}
            )
        return len(_ENCODINGS[self.version].encode_ordinary(text))


@dataclass(frozen=True)
class Words:
    """Runs of anything but ASCII blanks."""

    version: str

    def count(self, text: str) -> int:
        return len(text.encode("utf-8", "replace").split())


KEY = ["doc_id", "source", "lang", "version", "digest"]
OPS = ("insert", "revise", "delete")


def count_tokens(changes: DataFrame, tokenizers: list) -> DataFrame:
    """A row per change and tokenizer version: ``op``, the key columns and ``tokens``; a text travels on
    as its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column("text")]
            for t in tokenizers:
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("op", "doc_id", "source", "lang", "digest")),
                     pa.array([t.version] * len(texts), pa.string()),
                     pa.array([t.count(x) for x in texts], pa.int64())],
                    names=["op", "doc_id", "source", "lang", "digest", "version", "tokens"],
                )

    source = changes.filter(F.col("op").isin(*OPS)).select(
        "op", "doc_id", "source", "lang", F.md5("text").alias("digest"), "text"
    )
    schema = source.drop("text").select("*", F.lit("").alias("version"), F.lit(0).cast("long").alias("tokens")).schema
    return source.mapInArrow(run, schema)


class TokenLedger:
    def __init__(self, spark: SparkSession, path: str, tokenizers: list, id_type: str = "bigint", buckets: int = BUCKETS):
        self.spark, self.path, self.tokenizers, self.buckets = spark, path, tokenizers, buckets
        self.schema = (
            f"doc_id {id_type}, source string, lang string, version string, digest string, docs long, tokens long, bucket int"
        )

    def _read(self, part: str, schema: str, before: int | None = None) -> DataFrame:
        """The committed batches, or those before one."""
        reader = self.spark.read.schema(f"{schema}, batch long")
        done = self.batches()
        kept = [b for b in done if before is None or b < before]
        if not kept:
            return self.spark.createDataFrame([], f"{schema}, batch long")
        folders = [f"{self.path}/{part}/batch={b}" for b in kept]
        return reader.option("basePath", f"{self.path}/{part}").parquet(*folders)

    def batches(self) -> list[int]:
        try:
            done = self.spark.read.schema("batch long").parquet(f"{self.path}/commits/*")
        except Exception as error:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return []
        return sorted({r["batch"] for r in done.collect()})  # one row per batch

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("doc_id"), F.lit(self.buckets)).cast("int").alias("bucket")

    def known(self, ids: DataFrame, before: int) -> DataFrame:
        """What the batches before one say of the documents in ``ids`` (doc_id, bucket; both distinct)."""
        touched = [r["bucket"] for r in ids.select("bucket").distinct().collect()]  # ``buckets`` numbers at most
        of = ids.select(F.col("doc_id").alias("_id"), F.col("bucket").alias("_bucket"))
        return (
            self._read("ledger", self.schema, before=before).filter(F.col("bucket").isin(touched))
            .join(of, (F.col("bucket") == F.col("_bucket")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
            .groupBy(*KEY, "bucket").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
            .filter("docs <> 0 OR tokens <> 0")
        )

    def commit(self, batch: int, changes: DataFrame) -> None:
        """Apply a numbered batch of changes: doc_id, op, text, source, lang."""
        ledger, rollup = f"{self.path}/ledger/batch={batch}", f"{self.path}/rollup/batch={batch}"
        given = materialize(count_tokens(changes, self.tokenizers).withColumn("bucket", self._bucket()), "token-changes")
        old = self.known(given.select("doc_id", "bucket").distinct(), batch).select(
            *KEY, (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens"), "bucket"
        )
        new = given.filter("op <> 'delete'").drop("op").distinct().select(
            *KEY, F.lit(1).cast("long").alias("docs"), "tokens", "bucket"
        )
        new.unionByName(old).hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(ledger)
        written = self.spark.read.schema(self.schema).parquet(ledger)
        written.groupBy("source", "lang", "version").agg(
            F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")
        ).write.mode("overwrite").parquet(rollup)
        self.spark.range(1).select(F.lit(batch).cast("long").alias("batch")).write.mode("overwrite").parquet(
            f"{self.path}/commits/{batch}"
        )

    def totals(self) -> DataFrame:
        """source, lang, version, n_docs, n_tokens over all committed batches."""
        schema = "source string, lang string, version string, docs long, tokens long"
        return (
            self._read("rollup", schema).groupBy("source", "lang", "version")
            .agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
            .filter("n_docs <> 0 OR n_tokens <> 0")
        )


def without_repeated_lines(text: str = "text"):
    return F.array_join(F.array_distinct(F.split(F.col(text), "\n")), "\n")


def replayed_history(docs: DataFrame, ledger: TokenLedger) -> DataFrame:
    """Totals after a history made of the whole table: every document is inserted, exact copies of
    an earlier document are deleted, texts with repeated lines are revised, and the deletion
    arrives a second time."""
    none = F.lit(None).cast("string")
    ledger.commit(1, docs.select("doc_id", F.lit("insert").alias("op"), "text", "source", "lang"))
    hashed = docs.select("doc_id", F.sha2("text", 256).alias("_sha"))
    first = hashed.filter("_sha IS NOT NULL").groupBy("_sha").agg(F.min("doc_id").alias("_first"), F.count("*").alias("_n"))
    copies = hashed.join(first.filter("_n > 1"), "_sha").filter("doc_id > _first").select("doc_id")
    gone = copies.select("doc_id", F.lit("delete").alias("op"), none.alias("text"), none.alias("source"), none.alias("lang"))
    ledger.commit(2, gone)
    revised = (
        docs.select("doc_id", F.lit("revise").alias("op"), "text", without_repeated_lines().alias("_new"), "source", "lang")
        .filter("_new <> text")
        .select("doc_id", "op", F.col("_new").alias("text"), "source", "lang")
        .join(copies, "doc_id", "left_anti")
    )
    ledger.commit(3, revised)
    ledger.commit(2, gone)
    return ledger.totals()
