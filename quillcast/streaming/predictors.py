"""Predictors over a stream of closed windows, state carried from batch to batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillcast.operators import series
from quillcast.operators.series import TYPES
from quillcast.session import file_names, remove_folder, written
from quillcast.streaming.runner import FinishBatch

__all__ = ["SERIES", "TYPES", "carrying", "stream_series"]

SERIES = "window_start timestamp, cnt bigint"
_KEPT = 2  # states behind the current one: a batch may be repeated, none before it


def stream_series(spark: SparkSession, path: str, series_key: str | None = None) -> DataFrame:
    """The closed windows another stream writes to ``path``.

    Counts go there through the file sink and come back here, so that predictions are
    batch queries over what has closed since.
    """
    schema = f"{SERIES}, {series_key} string" if series_key else SERIES
    return spark.readStream.schema(schema).parquet(path)


def carrying(
    state: str,
    window: str = "1 minute",
    history: int = 5,
    step: float = 0.1,
    series_key: str | None = None,
) -> FinishBatch:
    """Predictions for the windows of a micro-batch; see :func:`quillcast.operators.series.predict`.

    The batch runs through the same blocks as a whole table would, so a backlog of any
    length is spread over the cluster. A row per key is carried on, written under
    ``<state>/batch_id=<n>``: a repeated batch starts from the same one again. Windows have to
    be released in order from batch to batch, in any order within one.
    """

    def finish(batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        closed = written(batch, "closed-windows")
        before = None
        saved = sorted(int(name.partition("=")[2]) for name in file_names(spark, state))
        earlier = [number for number in saved if number < batch_id]
        if earlier:
            before = spark.read.parquet(f"{state}/batch_id={earlier[-1]}")
        predictions, after = series.advance(closed, before, window, history, step, series_key)
        after.coalesce(1).write.mode("overwrite").parquet(f"{state}/batch_id={batch_id}")
        for number in earlier[:-_KEPT]:
            remove_folder(spark, f"{state}/batch_id={number}")
        return predictions

    return finish
