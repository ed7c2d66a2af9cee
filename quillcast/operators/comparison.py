"""Live results next to earlier batch results of the same time of day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillcast.functions.time import minute_of_day


def slots_of(
    batch: DataFrame, columns: list[str], keys: tuple[str, ...] = (), minutes: int = 15
) -> DataFrame:
    """The latest row per time of day and key: at most a day's buckets per key, whatever
    period the earlier results cover. Compute it once for many comparisons."""
    return (
        batch.groupBy(minute_of_day(F.col("window_start"), minutes).alias("slot"), *keys)
        .agg(F.max_by(F.struct(*columns), "window_start").alias("b"))
        .select("slot", *keys, *[F.col(f"b.{c}").alias(f"batch_{c}") for c in columns])
    )


def compare(
    live: DataFrame,
    slots: DataFrame,
    values: dict[str, object],
    keys: tuple[str, ...] = (),
    minutes: int = 15,
) -> DataFrame:
    """Add ``batch_<column>`` for each column in ``values``; its value fills unmatched rows."""
    return (
        live.withColumn("slot", minute_of_day(F.col("window_start"), minutes))
        .join(slots, ["slot", *keys], "left")
        .select(
            *live.columns,
            *[F.coalesce(f"batch_{c}", F.lit(fill)).alias(f"batch_{c}") for c, fill in values.items()],
        )
    )


# Compared columns with the value of unmatched rows, and keys besides the time of day.
KINDS: dict[str, tuple[dict[str, object], tuple[str, ...]]] = {
    "total": ({"cnt": 0}, ()),
    "percentage": ({"pct": 0.0, "cnt": 0}, ("lang",)),
    "share": ({"rt_total": 0, "tw_total": 0, "share": 0.0}, ("lang",)),
}


def earlier_slots(batch: DataFrame, kind: str) -> DataFrame:
    values, keys = KINDS[kind]
    return slots_of(batch, list(values), keys)


def with_slots(live: DataFrame, slots: DataFrame, kind: str) -> DataFrame:
    values, keys = KINDS[kind]
    return compare(live, slots, values, keys)


def compare_totals(live: DataFrame, batch: DataFrame) -> DataFrame:
    return with_slots(live, earlier_slots(batch, "total"), "total")


def compare_percentages(live: DataFrame, batch: DataFrame) -> DataFrame:
    return with_slots(live, earlier_slots(batch, "percentage"), "percentage")


def compare_shares(live: DataFrame, batch: DataFrame) -> DataFrame:
    return with_slots(live, earlier_slots(batch, "share"), "share")
