"""Run streaming frames into files, exactly once per micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quillcast.session import cleared
from quillcast.sources.posts import PARSED
from quillcast.streaming import batches

Finish = Callable[[DataFrame], DataFrame]
FinishBatch = Callable[[DataFrame, int], DataFrame]
Write = Callable[[DataFrame, str], None]


def parquet(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").parquet(path)


def after(finish: Finish, write: Write, files: int) -> Write:
    """A writer for one of several results that come from the same micro-batch."""
    return lambda batch, path: write(finish(batch).repartition(files), path)


def start(
    stream: DataFrame,
    checkpoint: str,
    outputs: Mapping[str, Write],
    finish: Finish | None = None,
    state_partitions: int | None = None,
    files_per_batch: int | None = None,
    finish_batch: FinishBatch | None = None,
    merge: int = 0,
    **trigger,
) -> StreamingQuery:
    """Hand every micro-batch to the writers, each under ``<path>/batch_id=<n>``.

    A folder appears when it is whole. A batch that is run again after a failure replaces its
    own folders and nothing else. With ``merge`` so many neighbouring folders are put together
    again and again; read the output by :func:`quillcast.streaming.batches.current` then. What
    a batch leaves in the scratch folder is removed with it. ``finish`` is the part of a metric that needs whole windows (ranking,
    percentages): append mode hands over all rows of a closed window in the same
    micro-batch, so the batch operator applies as it is; ``finish_batch`` is told the
    batch's number, too. ``state_partitions`` is
    fixed for the life of the checkpoint; choose it for the cluster, not the input.
    Results are far fewer than posts: ``files_per_batch`` gathers them into that many
    files instead of one per state partition.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with cleared(spark):
            frame = finish(batch) if finish else batch
            if finish_batch:
                frame = finish_batch(frame, batch_id)
            if files_per_batch is not None:
                frame = frame.repartition(files_per_batch)
            if len(outputs) > 1:
                frame = frame.persist()
            try:
                for path, write in outputs.items():
                    batches.commit(spark, path, batch_id, lambda target, write=write: write(frame, target))
            finally:
                frame.unpersist()
        if merge:
            for path, write in outputs.items():
                batches.merge(spark, path, batches.merge_parquet if write is parquet else batches.merge_lines, merge)

    return _launch(
        stream.writeStream.foreachBatch(store), stream, checkpoint, state_partitions, trigger
    )


def start_file_sink(
    stream: DataFrame, path: str, checkpoint: str, state_partitions: int | None = None, **trigger
) -> StreamingQuery:
    """Write through Spark's own file sink, whose log lets another stream read the folder."""
    writer = stream.writeStream.format("parquet").option("path", path)
    return _launch(writer, stream, checkpoint, state_partitions, trigger)


def start_console(stream: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
    """Show every micro-batch on the console."""
    return _launch(stream.writeStream.format("console"), stream, checkpoint, None, trigger)


def _launch(writer, stream, checkpoint, state_partitions, trigger) -> StreamingQuery:
    writer = (
        writer.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    with _shuffle_partitions(stream.sparkSession, state_partitions):
        return writer.start()


@contextmanager
def _shuffle_partitions(spark: SparkSession, count: int | None):
    # A stream copies the session's settings when it starts.
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    if count is not None:
        spark.conf.set(name, count)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def finish_query(query: StreamingQuery, timeout: float | None = None) -> None:
    """Wait for an ``availableNow`` query; raise if it fails or does not end within a given time."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream {query.id} did not end within {timeout} s")


def observed(query: StreamingQuery, name: str) -> dict[str, int]:
    """Sums of observed counts over the micro-batches Spark still remembers."""
    total: dict[str, int] = {}
    for progress in query.recentProgress:
        if name in progress.observedMetrics:
            for key, value in progress.observedMetrics[name].asDict().items():
                total[key] = total.get(key, 0) + value
    return total


def malformed_lines(parsing: StreamingQuery) -> int:
    """Lines that a query which parses posts could not read."""
    return observed(parsing, PARSED).get("malformed", 0)


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that the micro-batches Spark still remembers left out for being late.

    Aggregated posts of one window count as one row per task. How many batches are
    remembered is ``spark.sql.streaming.numRecentProgressUpdates``.
    """
    return sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for operator in progress.stateOperators
    )
