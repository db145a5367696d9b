"""Session settings the operators rely on."""

from pyspark.sql import SparkSession

SETTINGS = {
    # Dates and windows are UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    # Runtime sizes decide broadcasts; hot join keys are split over several tasks.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Stream state off the heap, as stateful processors ask for.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Else each partition of each stateful step holds 4 MB of disk that it may never fill.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}

# The same for the chain over posts: a Python worker is handed some thousand texts at a time, not
# ten thousand, as each of its functions holds a batch of whole texts. The chain is some dozen jobs over
# whole posts, so shuffle files go when the job that wrote them has ended, not when the driver happens to
# collect its garbage.
POST_SETTINGS = SETTINGS | {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # Whole texts read from tables are held by the batch as well.
    "spark.sql.parquet.columnarReaderBatchSize": "512",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession, settings: dict[str, str] = SETTINGS) -> SparkSession:
    for key, value in settings.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("galewire")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
