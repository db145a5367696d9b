"""Reference tables: stations, observations, places, users, gazetteer, lexicons."""

from dataclasses import dataclass

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from galewire.functions.emoji import base_weights
from galewire.schemas import GAZETTEER, LEXICON, OBSERVATION, OBSERVED_ON, PLACE, PROFILE, STATION, USER
from galewire.sources.storage import scan_observations


@dataclass(frozen=True)
class References:
    """The tables a run joins with; places and users are optional. ``dataset_id`` names the
    dataset whose stations count; without it all do."""

    stations: DataFrame
    observations: DataFrame
    gazetteer: DataFrame
    lexicon: DataFrame
    profiles: DataFrame | None = None
    places: DataFrame | None = None
    users: DataFrame | None = None
    dataset_id: str | None = None


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATION).parquet(path)


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(OBSERVATION).parquet(path)


def read_places(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PLACE).parquet(path)


def read_gazetteer(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(GAZETTEER).parquet(path)


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEXICON).parquet(path)


def lexicon_table(spark: SparkSession, weights: dict[str, float]) -> DataFrame:
    """A lexicon given in code as a table whose size the planner knows."""
    rows = pd.DataFrame(list(weights.items()), columns=["token", "weight"])
    return spark.createDataFrame(rows, schema=LEXICON)


def emoji_lexicon(spark: SparkSession, strict_codepoint: bool = False) -> DataFrame:
    return lexicon_table(spark, base_weights(strict_codepoint))


def _optional(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A table, or None where there is no such folder."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_references(spark: SparkSession, folder: str, **options) -> References:
    """The tables of a run from Parquet folders named after them; options set the other parts. Places,
    users and profiles are optional; observations may be a store cut by date."""
    observed = f"{folder}/observations"
    dated = OBSERVED_ON in spark.read.parquet(observed).columns
    return References(
        stations=read_stations(spark, f"{folder}/stations"),
        observations=scan_observations(spark, observed) if dated else read_observations(spark, observed),
        gazetteer=read_gazetteer(spark, f"{folder}/gazetteer"),
        lexicon=read_lexicon(spark, f"{folder}/lexicon"),
        **{
            name: _optional(spark, f"{folder}/{name}", schema)
            for name, schema in (("places", PLACE), ("users", USER), ("profiles", PROFILE))
            if name not in options
        },
        **options,
    )
