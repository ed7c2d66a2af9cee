"""Repost projections and windowed counts.

Input is post facts: ``id, ts, lang, rt_id, rt_ts, rt_lang, rt_screen_name, rt_text``
with ``rt_*`` NULL when the post is no repost and ``lang``/``rt_lang`` NULL when
the user is absent. All functions work on tables and, with ``ts`` watermarked, on
streams; they keep the window struct in ``win`` so that stages can be chained, and
:func:`labelled` turns it into ``window_start`` at the end.

Each count is one partial aggregation before one shuffle: a window, post or
language holding a third of all rows leaves every map task as a single row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from quillcast.functions.time import window_seconds

# Fixed value: language of posts without user, where those are kept.
NO_LANG = "no-lang"


def windowed(frame: DataFrame, window: str, *keys: Column | str) -> GroupedData:
    return frame.groupBy(F.window("ts", window).alias("win"), *keys)


def labelled(frame: DataFrame) -> DataFrame:
    """Replace the window struct by its start."""
    rest = [c for c in frame.columns if c != "win"]
    return frame.select(F.col("win.start").alias("window_start"), *rest)


def reposts(facts: DataFrame) -> DataFrame:
    return facts.filter("rt_id is not null")


def by_language(facts: DataFrame, lang_of: str, keep_no_lang: bool = False) -> DataFrame:
    """Set ``lang`` to that of the poster (``retweeter``) or of the original author."""
    lang = {"retweeter": F.col("lang"), "author": F.col("rt_lang")}[lang_of]
    if keep_no_lang:
        return facts.withColumn("lang", F.coalesce(lang, F.lit(NO_LANG)))
    return facts.withColumn("lang", lang).filter("lang is not null")


def reposts_per_window(facts: DataFrame, window: str = "15 minutes") -> DataFrame:
    """Reposts in total per window: ``win, cnt``."""
    return windowed(reposts(facts), window).agg(F.count("*").alias("cnt"))


def reposts_per_post(facts: DataFrame, window: str = "15 minutes") -> DataFrame:
    """Reposts per window and original post: ``win, rt_id, cnt``."""
    return windowed(reposts(facts), window, "rt_id").agg(F.count("*").alias("cnt"))


def reposts_per_post_with_payload(facts: DataFrame, window: str = "15 minutes") -> DataFrame:
    """As above with author name and text as the first repost showed them.

    For streams, where the posts cannot be read again; on tables
    :func:`quillcast.operators.ranking.top_posts` fetches them for the winners only.
    """
    return first_shown(windowed(reposts(facts), window, "rt_id"), F.count("*").alias("cnt")).select(
        "win", "rt_id", "payload.screen_name", "payload.text", "cnt"
    )


def first_shown(grouped: GroupedData, *more: Column) -> DataFrame:
    """``payload``: name and text of the original in the group's earliest repost."""
    shown = F.struct(F.col("rt_screen_name").alias("screen_name"), F.col("rt_text").alias("text"))
    return grouped.agg(F.min_by(shown, F.struct("ts", "id")).alias("payload"), *more)


def posts_per_language(
    facts: DataFrame, window: str = "15 minutes", keep_no_lang: bool = False
) -> DataFrame:
    """All posts, reposts included, per window and poster's language."""
    frame = by_language(facts, "retweeter", keep_no_lang)
    return windowed(frame, window, "lang").agg(F.count("*").alias("cnt"))


def reposts_per_language(
    facts: DataFrame,
    window: str = "15 minutes",
    lang_of: str = "author",
    keep_no_lang: bool = False,
) -> DataFrame:
    """Reposts per window and language."""
    frame = by_language(reposts(facts), lang_of, keep_no_lang)
    return windowed(frame, window, "lang").agg(F.count("*").alias("cnt"))


def totals_of_windows(counts: DataFrame, window: str) -> DataFrame:
    """Second, coarser window over counts of a first one; chains on streams too."""
    return counts.groupBy(F.window(F.window_time("win"), window).alias("win")).agg(
        F.sum("cnt").alias("cnt")
    )


def panes(frame: DataFrame, pane: str, *keys: str) -> DataFrame:
    """Counts per short window (pane) and keys: ``win, …, cnt``.

    Panes are partial results: every window size that is a multiple of theirs comes from them by
    :func:`rolled_up`, without the posts.
    """
    return windowed(frame, pane, *keys).agg(F.count("*").alias("cnt"))


def rolled_up(counted: DataFrame, sizes: Sequence[str], *keys: str) -> DataFrame:
    """Counts of several window sizes from those of panes: ``size, window_start, …, cnt``.

    One pass over the panes: each goes to its window of every size, in the task that holds it, and
    the sums start before the shuffle.
    """
    at = F.unix_micros("win.start")

    def window_of(size: str) -> Column:
        length = F.lit(int(window_seconds(size) * 1_000_000))
        return F.struct(F.lit(size).alias("size"), F.timestamp_micros(at - F.pmod(at, length)).alias("window_start"))

    placed = counted.select(*keys, "cnt", F.inline(F.array(*map(window_of, sizes))))
    return placed.groupBy("size", "window_start", *keys).agg(F.sum("cnt").alias("cnt"))


def common_pane(sizes: Sequence[str]) -> str:
    """The longest pane that all sizes are multiples of."""
    micros = math.gcd(*(round(window_seconds(size) * 1_000_000) for size in sizes))
    return f"{micros} microseconds"


def reposts_per_windows(facts: DataFrame, sizes: Sequence[str]) -> DataFrame:
    """Reposts in total for several window sizes from one scan and one shuffle of posts."""
    return rolled_up(panes(reposts(facts), common_pane(sizes)), sizes)
