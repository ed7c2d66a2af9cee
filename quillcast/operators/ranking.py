"""Most reposted posts per window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillcast.operators.counts import first_shown, reposts, windowed
from quillcast.session import written


def top_x(counts: DataFrame, x: int = 5) -> DataFrame:
    """The ``x`` largest counts per window; ties go to the smaller post id.

    Spark limits each group before the shuffle already, so a window sends at most
    ``x`` rows per task to the one that ranks it.
    """
    best_first = Window.partitionBy("win").orderBy(F.desc("cnt"), "rt_id")
    return counts.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= x)


def with_author(ranked: DataFrame) -> DataFrame:
    """Drop posts whose author is unknown, after ranking: a window may show fewer than X."""
    return ranked.filter("screen_name is not null")


def top_posts(
    facts: DataFrame, window: str = "1 minute", x: int = 5, require_author: bool = True
) -> DataFrame:
    """Top-X posts per window with author and text: ``win, rt_id, screen_name, text, cnt``.

    Counting and ranking move window, id and the time of the first repost only, one row
    per task, window and post. The winners are written out and joined back to fetch name
    and text, which are wide, from that first repost alone; Spark knows their size and
    broadcasts or sort-merges accordingly. Raw JSON is better written as facts first, as
    the posts are read twice.
    """
    winners = written(top_x(numbered(facts, window), x).drop("rank"), "winners")
    ranked = with_payload(winners, facts)
    return with_author(ranked) if require_author else ranked


def numbered(facts: DataFrame, window: str) -> DataFrame:
    """Reposts per window and original post, and the time of the first: ``win, rt_id, cnt, ts``."""
    return windowed(reposts(facts), window, "rt_id").agg(F.count("*").alias("cnt"), F.min("ts").alias("ts"))


def with_payload(winners: DataFrame, facts: DataFrame) -> DataFrame:
    """Winners with author and text of their first repost among ``facts``."""
    # The time of the first repost implies the window.
    first = reposts(facts).join(winners, ["rt_id", "ts"])
    return first_shown(first.groupBy("win", "rt_id", "cnt")).select(
        "win", "rt_id", "payload.screen_name", "payload.text", "cnt"
    )
