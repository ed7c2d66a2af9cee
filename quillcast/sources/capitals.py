"""Capital coordinates by country code: ``code, lat, lon``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_capitals(spark: SparkSession, path: str) -> DataFrame:
    """Coordinates from ``CountryName,CapitalName,Latitude,Longitude,CountryCode,Continent`` lines.

    Names may hold bare commas, so the fields are taken from the right. The last
    line of a code wins.
    """
    fields = F.split("value", ",")
    rows = spark.read.text(path).select(
        F.try_element_at(fields, F.lit(-2)).alias("code"),
        F.try_element_at(fields, F.lit(-4)).alias("lat"),
        F.try_element_at(fields, F.lit(-3)).alias("lon"),
        F.monotonically_increasing_id().alias("line"),
    )
    return _clean(rows)


def read_capitals_json(spark: SparkSession, path: str) -> DataFrame:
    """Coordinates from a JSON array of objects with the same fields, given as strings."""
    rows = (
        spark.read.schema("CapitalLatitude string, CapitalLongitude string, CountryCode string")
        .option("multiLine", True)
        .json(path)
        .select(
            F.col("CountryCode").alias("code"),
            F.col("CapitalLatitude").alias("lat"),
            F.col("CapitalLongitude").alias("lon"),
            F.monotonically_increasing_id().alias("line"),
        )
    )
    return _clean(rows)


def _clean(rows: DataFrame) -> DataFrame:
    return (
        rows.select(
            F.lower(F.trim("code")).alias("code"),
            F.trim("lat").try_cast("double").alias("lat"),
            F.trim("lon").try_cast("double").alias("lon"),
            "line",
        )
        .filter("code <> 'null' and lat is not null and lon is not null")
        .groupBy("code")
        .agg(F.max_by(F.struct("lat", "lon"), "line").alias("at"))
        .select("code", "at.lat", "at.lon")
    )
