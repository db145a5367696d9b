"""The processed and analytics tables on storage."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galewire.functions.times import parse_timestamp
from galewire.operators.filters import is_quality_row
from galewire.schemas import ANALYTICS_COLUMNS, OBSERVATION, OBSERVED_ON, PROCESSED

PARTITION = "processing_date"
# A stream's tables are cut by date and, so that a batch can be written again, by batch.
BATCH = "batch_id"


def today(processing_date: str | None = None) -> Column:
    """The given date, else the UTC date of the run."""
    return F.lit(processing_date) if processing_date else F.date_format(F.current_timestamp(), "yyyy-MM-dd")


def to_processed(df: DataFrame, processing_date: str | None = None, source: str = "posts") -> DataFrame:
    """The 43 columns of the processed table and its partition column, in order and typed.

    Without a date the UTC date of the run is used.
    """
    full = df.withColumns(
        {
            "processing_ts": F.current_timestamp(),
            "raw_json_path": F.lit(None).cast("string"),
            "source": F.lit(source),
            PARTITION: today(processing_date),
        }
    )
    fields = T.StructType.fromDDL(PROCESSED).fields
    return full.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def _by_date(df: DataFrame, mode: str, column: str = PARTITION):
    """A writer by date. ``overwrite`` replaces the dates that the rows hold and leaves the others, so
    a run that is repeated leaves one copy; ``append`` adds to them."""
    return df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(column)


def write_processed(
    df: DataFrame, path: str, mode: str = "overwrite", many_dates: bool = False
) -> None:
    """Date-partitioned Parquet; the dates written are replaced.

    A run normally carries one date and is written as it is. Rows of many dates are rebalanced
    first, at the price of a shuffle: large dates are split over several tasks, small ones end up
    in one file, instead of one file per task and date.
    """
    rows = df.hint("rebalance", PARTITION) if many_dates else df
    _by_date(rows, mode).option("compression", "snappy").parquet(path)


# Audit copies are kept packed; JSON readers unpack them by the name of the file.
JSON_CODEC = "gzip"


def write_raw_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON line per record and date, for audit, in files packed with gzip; the dates written are
    replaced."""
    _by_date(df, mode).option("compression", JSON_CODEC).json(path)


def write_observations(observations: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A store of observations cut by their UTC date, sorted by station inside, so that a read of some
    days opens their folders only and a read of some stations skips row groups. The dates written are
    replaced; times that cannot be read have no date."""
    dated = observations.withColumn(OBSERVED_ON, F.to_date(parse_timestamp(F.col("timestamp"))))
    rows = dated.hint("rebalance", OBSERVED_ON).sortWithinPartitions(OBSERVED_ON, "station_id")
    _by_date(rows, mode, OBSERVED_ON).parquet(path)


def scan_observations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{OBSERVATION}, {OBSERVED_ON} date").parquet(path)


def batch_folder(path: str, day: str, batch_id: int) -> str:
    return f"{path}/{PARTITION}={day}/{BATCH}={batch_id}"


def batch_date(spark: SparkSession, out: str, batch_id: int) -> str:
    """The UTC date a batch was first written on, noted beside the tables: a batch that is run
    again after midnight goes where its first run went."""
    note = f"{out}/batches/{BATCH}={batch_id}"
    now = spark.range(1).select(today().alias("day"))
    now.write.mode("ignore").json(note)
    known = spark.read.schema("day string").json(note).first()
    if known is None:  # a run was lost while it wrote its note
        now.write.mode("overwrite").json(note)
        known = spark.read.schema("day string").json(note).first()
    return known.day


def scan_processed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROCESSED).parquet(path)


def quality_rows(processed: DataFrame) -> DataFrame:
    """Rows and columns of the analytics table."""
    return processed.where(is_quality_row()).select(*ANALYTICS_COLUMNS)


def write_analytics(processed: DataFrame, path: str) -> None:
    quality_rows(processed).write.mode("overwrite").option("compression", "snappy").parquet(path)


def partition_counts(processed: DataFrame) -> DataFrame:
    return processed.groupBy(PARTITION).agg(F.count(F.lit(1)).alias("n_rows"))


def create_processed_table(
    spark: SparkSession, path: str, name: str = "processed_tweets", by_batch: bool = False
) -> None:
    """Table over existing partition folders, so that SQL texts can use its name. The table of a
    stream is cut ``by_batch``, too, and has that column besides."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    body = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromDDL(PROCESSED).fields
    )
    cut = f"{PARTITION}, {BATCH}" if by_batch else PARTITION
    if by_batch:
        body += f", `{BATCH}` bigint"
    spark.sql(
        f"CREATE TABLE {name} ({body}) USING parquet PARTITIONED BY ({cut}) "
        f"LOCATION '{path}' "
        "TBLPROPERTIES ('description'='Processed posts with sentiment and weather')"
    )
    repair_table(spark, name)


def repair_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"MSCK REPAIR TABLE {name}")


def create_analytics_table(
    spark: SparkSession,
    path: str,
    name: str = "final_analytics",
    processed: str = "processed_tweets",
) -> None:
    """Write the quality rows of the processed table and register them as a table."""
    write_analytics(spark.table(processed), path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")

