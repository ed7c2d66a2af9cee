"""Capital coordinates of the language a count belongs to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillcast.functions.scalars import country_code


def with_capital(counts: DataFrame, capitals: DataFrame) -> DataFrame:
    """Add ``lat, lon`` of the language's country, 0.0 where the code is unknown.

    Runs on counts, never on posts. There is no broadcast hint: Spark broadcasts
    the capitals while they stay under its size threshold and sort-merges beyond.
    """
    return (
        counts.withColumn("code", country_code(F.col("lang")))
        .join(capitals, "code", "left")
        .withColumn("lat", F.coalesce("lat", F.lit(0.0)))
        .withColumn("lon", F.coalesce("lon", F.lit(0.0)))
        .drop("code")
    )


def unknown_languages(counts: DataFrame, capitals: DataFrame) -> DataFrame:
    """Languages without coordinates and the number of counts they hold."""
    return (
        counts.groupBy("lang")
        .agg(F.sum("cnt").alias("cnt"))
        .withColumn("code", country_code(F.col("lang")))
        .join(capitals, "code", "left_anti")
        .select("lang", "code", "cnt")
    )
