"""Percentages and shares per language."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillcast.functions.scalars import round_half_even
from quillcast.operators.counts import by_language, windowed


def percentage_of_window(counts: DataFrame, places: int = 2) -> DataFrame:
    """Each language's percentage of all counts in its window: ``…, pct``.

    Input rows are counts, one per window and language, so a window's group is as
    small as the list of languages however many posts it stands for.
    """
    return (
        counts.withColumn("total", F.sum("cnt").over(Window.partitionBy("win")))
        .withColumn("pct", round_half_even(F.col("cnt") / F.col("total") * 100, places))
        .drop("total")
    )


def share_of_posts(
    facts: DataFrame,
    window: str = "15 minutes",
    lang_of: str = "retweeter",
    keep_no_lang: bool = False,
) -> DataFrame:
    """Reposts over all posts per window and language: ``win, lang, rt_total, tw_total, share``.

    One pass and one shuffle stand for the two counts and their inner join:
    languages lacking either side are filtered afterwards. With
    ``lang_of='author'`` the numerator goes by the original author's language, so
    a post counts under up to two languages and a share may exceed 1.
    """
    is_repost = F.col("rt_id").isNotNull()
    if lang_of == "retweeter":
        votes = by_language(facts, "retweeter", keep_no_lang).select(
            "ts", "lang", F.lit(1).alias("tw"), is_repost.cast("int").alias("rt")
        )
    else:
        votes = facts.select(
            "ts",
            F.inline(
                F.array(
                    F.struct(F.col("lang"), F.lit(1).alias("tw"), F.lit(0).alias("rt")),
                    F.struct(
                        F.col("rt_lang").alias("lang"),
                        F.lit(0).alias("tw"),
                        is_repost.cast("int").alias("rt"),
                    ),
                )
            ),
        ).filter("lang is not null")
    counted = windowed(votes, window, "lang").agg(
        F.sum("rt").alias("rt_total"), F.sum("tw").alias("tw_total")
    )
    return with_share(counted.filter("rt_total > 0 and tw_total > 0"))


def share_of_counts(posts: DataFrame, reposted: DataFrame) -> DataFrame:
    """The same share from two counts per window and language, joined on both."""
    return with_share(
        posts.withColumnRenamed("cnt", "tw_total").join(
            reposted.withColumnRenamed("cnt", "rt_total"), ["win", "lang"]
        )
    ).select("win", "lang", "rt_total", "tw_total", "share")


def with_share(counted: DataFrame) -> DataFrame:
    return counted.withColumn("share", F.col("rt_total") / F.col("tw_total"))


def max_share(shares: DataFrame, window: str) -> DataFrame:
    """Row of the largest share per language in a coarser window; the earliest wins a tie."""
    at = F.window_time("win")
    return (
        shares.groupBy(F.window(at, window).alias("win"), "lang")
        .agg(
            F.max_by(
                F.struct("rt_total", "tw_total", "share"),
                F.struct("share", -F.unix_millis(F.col("win.start"))),
            ).alias("best")
        )
        .select("win", "lang", "best.*")
    )
