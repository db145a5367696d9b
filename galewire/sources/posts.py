"""Reading and writing raw posts."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galewire.operators.parse import CORRUPT
from galewire.schemas import RAW_POST
from galewire.sources.arrays import array_elements


def _record(value: Column) -> Column:
    """One JSON text as a post; ``_corrupt_record`` alone is filled if it is none."""
    schema = T.StructType.fromDDL(RAW_POST).add(CORRUPT, T.StringType())
    return F.from_json(value, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def read_posts(
    spark: SparkSession, path: str, json_array: bool = False, chunk_bytes: int | None = None
) -> DataFrame:
    """Raw posts from JSON Lines (splittable), or from files that each hold one array or object.

    Unreadable records come back with only ``_corrupt_record`` filled. An array is taken apart
    first and each element is read alone, so a bad one costs itself only; an empty array holds no
    post. An array file is one record of Spark's text reader (2 GB at most); with ``chunk_bytes`` it
    is cut into ranges of that size and read by many tasks (``arrays.array_elements``).
    """
    if json_array and chunk_bytes:
        lines = array_elements(spark, path, chunk_bytes)
    elif json_array:
        whole = spark.read.option("wholetext", True).text(path).where(F.trim("value") != "")
        elements = F.when(F.ltrim("value").startswith("["), F.from_json("value", "array<string>"))
        lines = whole.select(F.explode(F.coalesce(elements, F.array("value"))).alias("value"))
        lines = lines.select(F.coalesce("value", F.lit("null")).alias("value"))
    else:
        lines = spark.read.text(path).where(F.trim("value") != "")
    read = lines.select("value", _record(F.col("value")).alias("p")).select("value", "p.*")
    # A JSON text that is no object at all (a number, a list) is corrupt as well.
    broken = F.when(~F.ltrim("value").startswith("{"), F.col("value")).otherwise(F.col(CORRUPT))
    return read.withColumn(CORRUPT, broken).drop("value")


def split_corrupt(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable posts, unreadable records)."""
    bad = F.col(CORRUPT).isNotNull()
    return raw.where(~bad).drop(CORRUPT), raw.where(bad).select(CORRUPT)


def stream_posts(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """Posts from JSON Lines files that keep arriving, with ``_corrupt_record``; the checkpoint
    remembers what was read."""
    return (
        spark.readStream.schema(T.StructType.fromDDL(RAW_POST).add(CORRUPT, T.StringType()))
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(folder)
    )


def save_posts(raw: DataFrame, path: str, codec: str = "none") -> None:
    """Posts as JSON Lines; files that are packed (``gzip``) cannot be split."""
    raw.write.mode("overwrite").option("compression", codec).json(path)
