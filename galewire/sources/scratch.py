"""Intermediate tables in the folder every executor can reach."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, as named by ``spark.checkpoint.dir``.

    Only a local master, where driver and executors share one disk, may fall back to a
    temporary folder.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if named:
        if current is None:
            sc.setCheckpointDir(named)
        return named
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="galewire-")
    sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, slot: str | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` as a table and read it back: cuts lineage, and later steps re-read only
    the columns they need. A lost executor costs a re-read, not a recomputation.

    A ``slot`` is one fixed place that each call writes anew; without it every call gets its own.
    Tables that hold texts name a ``codec`` that packs them well; others take the session's.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name) if slot is None else f"{shared_dir(spark)}/{name}-{slot}"
    writer = df.write.mode("errorifexists" if slot is None else "overwrite")
    (writer.option("compression", codec) if codec else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget_shuffles(df: DataFrame) -> None:
    """Let the executors delete the shuffle files behind a stream's batch that has been written. Spark does
    so for other queries as they end, for a batch only when all its work has ended. Should the batch be
    read again, Spark makes the files anew."""
    plan = df._jdf.queryExecution().logical()
    if plan.getClass().getSimpleName() != "LogicalRDD":
        return  # no batch of a stream with state
    sc, left, seen = df.sparkSession.sparkContext._jsc.sc(), [plan.rdd()], set()
    while left:
        rdd = left.pop()
        if rdd.id() in seen:
            continue
        seen.add(rdd.id())
        dependencies = rdd.dependencies()
        for dependency in (dependencies.apply(i) for i in range(dependencies.size())):
            if dependency.getClass().getSimpleName() == "ShuffleDependency":
                sc.shuffleDriverComponents().removeShuffle(dependency.shuffleId(), False)
            left.append(dependency.rdd())
