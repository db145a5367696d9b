"""Words and small column helpers shared by the operators of this subpackage."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from galewire.session import configure

BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Runs of anything but ASCII blanks; an empty array for null, empty and blank texts."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, BLANK_RUN)).otherwise(
        F.array().cast("array<string>")
    )


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` worked out once per row, however often it is used inside."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
