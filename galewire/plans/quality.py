"""Run statistics: what each stage did, as one-pass aggregates."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galewire.operators.parse import reject_reason

def _n() -> Column:
    return F.count(F.lit(1))


def _percent(part: Column, whole: Column, digits: int = 1) -> Column:
    share = F.when(whole > 0, part * 100.0 / whole).otherwise(F.lit(0.0))
    return F.round(share, digits)


def _shares(df: DataFrame, column: str, values: list[str], total: str) -> DataFrame:
    """One row: the total, then count and percentage of each value."""
    counts = [F.count_if(F.col(column) == v).alias(f"{v}_count") for v in values]
    row = df.agg(_n().alias(total), *counts)
    percents = {f"{v}_pct": _percent(F.col(f"{v}_count"), F.col(total)) for v in values}
    return row.withColumns(percents)


# ---------------------------------------------------------------- statistics of raw posts


def language_share(raw: DataFrame, k: int = 10) -> DataFrame:
    counts = raw.groupBy(F.coalesce("lang", F.lit("unknown")).alias("lang")).agg(_n().alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return (
        counts.select("lang", "n", _percent(F.col("n"), total).alias("pct"))
        .orderBy(F.desc("n"), "lang")
        .limit(k)
    )


def geo_availability(raw: DataFrame) -> DataFrame:
    has = {
        "coordinates": F.col("geo.coordinates").isNotNull(),
        "place": F.col("place").isNotNull(),
        "user_location": F.coalesce("user_location", F.lit("")) != "",
    }
    row = raw.agg(_n().alias("total"), *[F.count_if(c).alias(f"with_{n}") for n, c in has.items()])
    return row.withColumns(
        {f"{n}_pct": _percent(F.col(f"with_{n}"), F.col("total")) for n in has}
    )


def top_hashtags(raw: DataFrame, k: int = 10) -> DataFrame:
    tags = raw.select(F.explode("entities.hashtags").alias("h"))
    return (
        tags.groupBy(F.lower(F.coalesce("h.tag", F.lit(""))).alias("tag"))
        .agg(_n().alias("n"))
        .orderBy(F.desc("n"), "tag")
        .limit(k)
    )


# ---------------------------------------------------------------- stage reports


def parse_report(flat: DataFrame) -> DataFrame:
    """Processed and failed posts, failures by reason."""
    reasons = ["missing_tweet_id", "missing_text", "missing_created_at", "blank_text", "bad_timestamp"]
    reason = F.col("reject_reason")
    return reject_reason(flat).agg(
        F.count_if(reason.isNull()).alias("processed"),
        F.count_if(reason.isNotNull()).alias("failed"),
        *[F.count_if(reason == r).alias(r) for r in reasons],
    )


def dedup_report(outcomes: DataFrame) -> DataFrame:
    """Totals from the lines of ``dedup_outcomes``."""

    def rows(*names: str) -> Column:
        return F.coalesce(
            F.sum(F.when(F.col("dedup_outcome").isin(*names), F.col("n_rows"))), F.lit(0)
        )

    row = outcomes.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("processed"),
        rows("kept").alias("unique_emitted"),
        rows("dup_id", "dup_text").alias("duplicates_dropped"),
        rows("repost").alias("retweets_dropped"),
    )
    dropped = F.col("duplicates_dropped") + F.col("retweets_dropped")
    return row.withColumn("drop_rate", _percent(dropped, F.col("processed")))


def language_method_report(df: DataFrame) -> DataFrame:
    counts = df.groupBy("lang_method").agg(_n().alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(
        "lang_method", "n", _percent(F.col("n"), total).alias("pct")
    ).orderBy("lang_method")


def geo_tier_report(df: DataFrame) -> DataFrame:
    return _shares(df, "geo_confidence", ["high", "medium", "low", "unavailable"], "processed")


def weather_report(df: DataFrame) -> DataFrame:
    outcomes = ["enriched", "no_station", "no_observations", "no_geo"]
    return _shares(df, "weather_outcome", outcomes, "processed")


def sentiment_report(df: DataFrame) -> DataFrame:
    return _shares(df, "sentiment_label", ["positive", "neutral", "negative"], "processed")


# Targets of the two data-quality checks, in percent.
WEATHER_MATCH_TARGET = 30.0
GEO_TARGET = 50.0


def quality_gate(processed: DataFrame) -> DataFrame:
    """Share of posts with weather and with a good position, against their targets."""
    row = processed.agg(
        _n().alias("n"),
        F.count_if(F.col("noaa_match_quality").isin("high", "medium", "low")).alias("matched"),
        F.count_if(F.col("geo_confidence").isin("high", "medium")).alias("located"),
    )
    weather, geo = (_percent(F.col(c), F.col("n"), 3) for c in ("matched", "located"))

    def check(name: str, pct: Column, target: float) -> Column:
        return F.struct(
            F.lit(name).alias("check_name"), pct.alias("pct"), F.lit(target).alias("target")
        )

    checks = F.array(
        check("weather_match", weather, WEATHER_MATCH_TARGET),
        check("geo_coverage", geo, GEO_TARGET),
    )
    return row.select(F.inline(checks)).withColumn("passed", F.col("pct") > F.col("target"))


def label_counts(processed: DataFrame) -> DataFrame:
    """Rows per label and in total, for checking what was written."""
    labels = processed.groupBy(F.col("sentiment_label").alias("item")).agg(_n().alias("n"))
    return labels.unionByName(labels.agg(F.lit("total").alias("item"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")))
