"""The metrics on streams.

Each takes streaming post facts and returns the streaming frame to start plus the
finishing step for its closed windows, ready for :func:`quillcast.streaming.runner.start`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillcast.operators import counts, geo, ranking, shares
from quillcast.operators.counts import labelled
from quillcast.session import written
from quillcast.streaming.runner import Finish

DELAY = "5 seconds"
TIMES = ("event", "arrival")


def with_event_time(facts: DataFrame, delay: str = DELAY) -> DataFrame:
    """Windows close ``delay`` behind the latest post; what comes later is dropped."""
    return facts.withWatermark("ts", delay)


def with_arrival_time(facts: DataFrame, delay: str = DELAY) -> DataFrame:
    """Windows by time of arrival instead of event time."""
    return facts.withColumn("ts", F.current_timestamp()).withWatermark("ts", delay)


def with_time(facts: DataFrame, time: str = "event", delay: str = DELAY) -> DataFrame:
    """Windows by ``event`` or by ``arrival`` time; by arrival no post comes late."""
    if time not in TIMES:
        raise ValueError(f"time is one of {', '.join(TIMES)}")
    return {"event": with_event_time, "arrival": with_arrival_time}[time](facts, delay)


def reposts_per_window(facts: DataFrame, window: str = "15 minutes"):
    return counts.reposts_per_window(facts, window), labelled


def reposts_two_stage(facts: DataFrame, window: str = "15 minutes", outer: str = "1 hour"):
    """Counts per post, then totals of a coarser window over them: chained state."""
    return counts.totals_of_windows(counts.reposts_per_post(facts, window), outer), labelled


def ranked(closed: DataFrame, x: int = 5) -> DataFrame:
    return labelled(ranking.with_author(ranking.top_x(closed, x)).drop("rank"))


def ranked_again(closed: DataFrame, x: int, look_up: Finish) -> DataFrame:
    """The top X of closed windows, names and texts fetched for the winners only."""
    winners = written(ranking.top_x(closed, x).drop("rank"), "winners")
    return labelled(ranking.with_author(ranking.with_payload(winners, look_up(winners))))


def top_posts(facts: DataFrame, window: str = "1 minute", x: int = 5, look_up: Finish | None = None):
    """The top X of each window. ``look_up`` finds the posts at the ``ts`` of a frame again
    (:func:`quillcast.streaming.archive.posts_at`); then the state holds numbers only.
    Without it name and text of all posts are carried along.
    """
    if look_up is None:
        return counts.reposts_per_post_with_payload(facts, window), lambda closed: ranked(closed, x)
    return ranking.numbered(facts, window), lambda closed: ranked_again(closed, x, look_up)


def located(capitals: DataFrame) -> Finish:
    return lambda closed: labelled(geo.with_capital(closed, capitals))


def percentages(places: int = 2) -> Finish:
    return lambda closed: labelled(shares.percentage_of_window(closed, places))


def reposts_per_country(
    facts: DataFrame,
    capitals: DataFrame,
    window: str = "15 minutes",
    lang_of: str = "author",
    keep_no_lang: bool = False,
):
    return counts.reposts_per_language(facts, window, lang_of, keep_no_lang), located(capitals)


def percentage_per_language(
    facts: DataFrame,
    window: str = "15 minutes",
    lang_of: str = "author",
    places: int = 2,
    keep_no_lang: bool = False,
):
    return counts.reposts_per_language(facts, window, lang_of, keep_no_lang), percentages(places)


def share_per_language(
    facts: DataFrame,
    window: str = "15 minutes",
    lang_of: str = "retweeter",
    keep_no_lang: bool = False,
):
    return shares.share_of_posts(facts, window, lang_of, keep_no_lang), labelled


def share_by_window_join(facts: DataFrame, window: str = "15 minutes", lang_of: str = "author"):
    """The share as a stream-stream join of both counts on window and language."""
    posts = counts.posts_per_language(facts, window)
    reposted = counts.reposts_per_language(facts, window, lang_of)
    return shares.share_of_counts(posts, reposted), labelled


def max_share_per_language(
    facts: DataFrame, window: str = "1 hour", outer: str = "1 day", lang_of: str = "retweeter"
):
    return shares.max_share(shares.share_of_posts(facts, window, lang_of), outer), labelled
