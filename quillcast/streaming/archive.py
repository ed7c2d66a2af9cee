"""Post facts of a stream, filed for several readers: metrics, dumps and look-ups by time.

The only query that parses the input files its facts under ``slice=<n>/batch_id=<m>``, a slice
being a stretch of the time that windows go by. Each slice of a batch appears by one rename and never again, so
streams over the archive see every post once. With the batch its running totals are
written: complete counts of lines, delete notices, malformed lines and late posts, whatever
restarts lie between.

``seen`` of a post is the latest time known before its batch. Whether a post came
too late for a window follows from that and stays the same however later stages cut
the stream into batches.

A silent stream has no posts to move its time on. :class:`IdleClock` does so by rows without id
(ticks) that carry the latest time plus the length of the silence.
"""

from __future__ import annotations

import json
import threading
import time as clock

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quillcast.session import file_names, make_folder, move, read_text, remove_folder, write_text
from quillcast.sources import posts
from quillcast.streaming.batches import STAGED

FACTS = (
    "id bigint, ts timestamp, lang string, rt_id bigint, rt_ts timestamp, rt_lang string, "
    "rt_screen_name string, rt_text string, arrived timestamp, seen timestamp"
)
SLICE = "1 hour"
_TOTALS = "_totals"
_TICKS = "slice=ticks"
_KEPT = 3  # totals behind the latest: a batch may be repeated, none before it
COUNTS = ("lines", "notices", "malformed", "posts", "late")


def micros(length: str) -> Column:
    """Length of an interval in microseconds."""
    zero = F.timestamp_micros(F.lit(0))
    return F.unix_micros(zero + F.expr(f"INTERVAL {length}"))


def length_of(spark: SparkSession, length: str) -> int:
    return spark.range(1).select(micros(length)).first()[0]


def is_late(window: str, delay: str) -> Column:
    """True for a post whose window had been closed before its batch began."""
    end = _floor(F.col("ts"), window) + micros(window)
    return F.coalesce(end <= F.unix_micros("seen") - micros(delay), F.lit(False))


def _floor(ts: Column, length: str) -> Column:
    at = F.unix_micros(ts)
    return at - F.pmod(at, micros(length))


def _slice_of(ts: Column, length: str) -> Column:
    return (_floor(ts, length) / micros(length)).cast("bigint")


def totals(spark: SparkSession, path: str, before: int | None = None) -> dict[str, int]:
    """Counts over all batches filed so far, and ``latest``, the latest time in microseconds."""
    known = sorted(int(name) for name in file_names(spark, f"{path}/{_TOTALS}") if name.isdigit())
    if before is not None:
        known = [batch for batch in known if batch < before]
    return json.loads(read_text(spark, f"{path}/{_TOTALS}/{known[-1]}")) if known else dict.fromkeys(COUNTS, 0)


def _seen_before(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """The latest time known before a batch, ticks included; a repeated batch is told the same again."""
    note = f"{batch_id}.seen"
    if note not in file_names(spark, f"{path}/{_TOTALS}"):
        ticks = [int(name.partition("=")[2]) for name in file_names(spark, f"{path}/{_TICKS}")]
        known = [value for value in (totals(spark, path, batch_id).get("latest"), *ticks) if value is not None]
        write_text(spark, f"{path}/{_TOTALS}/{note}", json.dumps(max(known, default=None)))
    return json.loads(read_text(spark, f"{path}/{_TOTALS}/{note}"))


def start_filing(
    spark: SparkSession,
    inbox: str,
    path: str,
    checkpoint: str,
    window: str,
    delay: str,
    time: str = "event",
    slice_length: str = SLICE,
    max_files: int | None = None,
    **trigger,
) -> StreamingQuery:
    """File the facts of all posts that arrive in ``inbox``; see :func:`start_filing_lines`."""
    return start_filing_lines(posts.stream_lines(spark, inbox, max_files), path, checkpoint, window, delay, time, slice_length, **trigger)


def start_filing_lines(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    window: str,
    delay: str,
    time: str = "event",
    slice_length: str = SLICE,
    **trigger,
) -> StreamingQuery:
    """File the facts of a stream of lines (:func:`quillcast.sources.posts.stream_lines`).

    ``late`` in the totals counts posts that came after their ``window`` was closed. By arrival no
    post is late: a file that is older than one filed before counts as arrived with that.
    """
    spark = lines.sparkSession
    make_folder(spark, path)

    def file(batch: DataFrame, batch_id: int) -> None:
        if str(batch_id) in file_names(spark, f"{path}/{_TOTALS}"):
            return
        before, latest = totals(spark, path, batch_id), _seen_before(spark, path, batch_id)
        known = F.timestamp_micros(F.lit(latest))
        rows = batch.withColumn("seen", known)
        if time == "arrival":
            rows = rows.withColumn("arrived", F.greatest("arrived", known))
        at = "arrived" if time == "arrival" else "ts"
        is_post = F.col("kind") == posts.POST
        seen = Observation()
        counted = rows.observe(
            seen,
            F.count(F.lit(1)).alias("lines"),
            F.count_if(F.col("kind") == posts.NOTICE).alias("notices"),
            F.count_if(F.col("kind") == posts.MALFORMED).alias("malformed"),
            F.count_if(is_post).alias("posts"),
            F.count_if(is_post & (is_late(window, delay) if time == "event" else F.lit(False))).alias("late"),
            F.max(F.when(is_post, F.unix_micros(at))).alias("latest"),
        )
        staged = f"{path}/{STAGED}"
        facts = counted.where(is_post).drop("kind").withColumn("slice", _slice_of(F.col(at), slice_length))
        # One file per slice as far as it is small, several if it is not.
        facts.hint("rebalance", "slice").write.mode("overwrite").partitionBy("slice").parquet(staged)
        for name in file_names(spark, staged):
            target = f"{path}/{name}/batch_id={batch_id}"
            if name.startswith("slice=") and f"batch_id={batch_id}" not in file_names(spark, f"{path}/{name}"):
                move(spark, f"{staged}/{name}", target)
        found = seen.get
        now = {name: before[name] + found[name] for name in COUNTS}
        now["latest"] = max((value for value in (found["latest"], before.get("latest")) if value is not None), default=None)
        write_text(spark, f"{path}/{_TOTALS}/{batch_id}", json.dumps(now))
        for name in file_names(spark, f"{path}/{_TOTALS}"):
            if int(name.partition(".")[0]) < batch_id - _KEPT:
                remove_folder(spark, f"{path}/{_TOTALS}/{name}")

    writer = lines.writeStream.foreachBatch(file).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def _as_time(facts: DataFrame, time: str) -> DataFrame:
    return facts.withColumn("ts", F.col("arrived")) if time == "arrival" else facts


def stream_archive(spark: SparkSession, path: str, time: str = "event") -> DataFrame:
    """All rows filed, ticks included; by arrival, ``ts`` is the time of arrival."""
    return _as_time(spark.readStream.schema(FACTS).parquet(f"{path}/slice=*/batch_id=*"), time)


def only_posts(rows: DataFrame) -> DataFrame:
    """Without ticks, for use behind the watermark.

    The second condition never holds; as it depends on the task, Spark leaves the filter, and those above it, where
    they are, and ticks reach the watermark.
    """
    return rows.filter(F.col("id").isNotNull() | (F.spark_partition_id() < 0))


def in_time(rows: DataFrame, window: str, delay: str, time: str = "event") -> DataFrame:
    """Posts that did not come too late for ``window``, watermarked, ticks used up.

    What the watermark would drop is left out here already: a batch's posts are held against what was seen
    before it was filed, which is never less than what a later stage has seen.
    """
    kept = rows if time == "arrival" else rows.filter(~is_late(window, delay))
    return only_posts(kept.withWatermark("ts", delay))


def posts_at(spark: SparkSession, path: str, times: DataFrame, time: str = "event", slice_length: str = SLICE) -> DataFrame:
    """The posts of the slices that hold the ``ts`` of a frame, however much else is filed.

    The numbers of those slices go through the driver: as many as there are hours, say, in the windows asked for.
    """
    slices = [row[0] for row in times.select(_slice_of(F.col("ts"), slice_length)).distinct().collect()]
    there = [f"{path}/slice={number}" for number in slices if file_names(spark, f"{path}/slice={number}")]
    if not there:
        return _as_time(spark.createDataFrame([], FACTS), time)
    folders = [f"{folder}/batch_id=*" for folder in there]
    return _as_time(spark.read.schema(StructType.fromDDL(FACTS)).parquet(*folders), time)


def tick(spark: SparkSession, path: str, at: int) -> None:
    """File the time ``at`` (microseconds) as seen, without any post."""
    name = f"batch_id={at}"
    if name in file_names(spark, f"{path}/{_TICKS}"):
        return
    staged = f"{path}/{STAGED}-tick/{name}"
    row = spark.range(1).select(
        *[(F.timestamp_micros(F.lit(at)) if field.name in ("ts", "arrived") else F.lit(None).cast(field.dataType)).alias(field.name) for field in StructType.fromDDL(FACTS)]
    )
    row.coalesce(1).write.mode("overwrite").parquet(staged)
    move(spark, staged, f"{path}/{_TICKS}/{name}")


class IdleClock(threading.Thread):
    """Moves the time of a silent stream on, until its windows are closed.

    After ``idle`` seconds without a new batch it files ticks: the latest time plus the silence, times ``pace``
    (seconds of the stream per second of silence; 1 for live posts). So a window closes once the clock
    has come to its end, as if posts had gone on. It rests when ``reach`` (a window and
    the delay) has passed behind the latest post, and starts anew with the next batch.
    Posts that come for closed windows are late and counted as such.
    """

    def __init__(self, spark: SparkSession, path: str, filing: StreamingQuery, reach: str, idle: float = 30.0, pace: float = 1.0):
        super().__init__(daemon=True, name="idle-clock")
        self.spark, self.path, self.filing = spark, path, filing
        self.idle, self.pace = idle, pace
        self.reach = length_of(spark, reach)
        self.ended, self.closed = threading.Event(), threading.Event()

    def run(self) -> None:
        batch, since, told = None, clock.monotonic(), 0.0
        while not self.ended.wait(min(0.5, self.idle / 4)) and self.filing.isActive:
            now, newest = clock.monotonic(), totals(self.spark, self.path).get("lines")
            if newest != batch:
                batch, since, told = newest, now, 0.0
                self.closed.clear()
            silence = now - since
            latest = totals(self.spark, self.path).get("latest")
            if latest is None or silence - told < self.idle or self.closed.is_set():
                continue
            told = silence
            moved = min(int(silence * self.pace * 1e6), self.reach)
            tick(self.spark, self.path, latest + moved)
            if moved == self.reach:
                self.closed.set()

    def stop(self) -> None:
        self.ended.set()
        self.join()
