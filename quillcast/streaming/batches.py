"""Folders that micro-batches leave behind: whole or not at all, and merged as they grow in number.

A batch is written out of sight, under ``_staged``, and appears by one rename as ``batch_id=<n>``.
Merging writes several neighbours into ``batch_id=<first>-<last>``, which appears the same way.
The names are the list of what counts: a folder whose range lies within another's does not.
So readers that go by :func:`current` see every row once before, during and after a
merge, and one that is killed half-way has changed nothing. Files that were merged
are removed by the next merge, as a reader may still be at them.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from quillcast.session import file_names, folder_bytes, move, remove_folder

STAGED = "_staged"
_NAME = re.compile(r"batch_id=(\d+)(?:-(\d+))?")


@dataclass(frozen=True, order=True)
class Range:
    """The batches ``first`` to ``last`` in the folder ``name``."""

    first: int
    last: int
    name: str

    def covers(self, other: Range) -> bool:
        return self != other and self.first <= other.first and other.last <= self.last

    def __len__(self) -> int:
        return self.last - self.first + 1


def _ranges(spark: SparkSession, path: str) -> list[Range]:
    found = ((_NAME.fullmatch(name), name) for name in file_names(spark, path))
    return sorted(Range(int(m[1]), int(m[2] or m[1]), name) for m, name in found if m)


def _counting(ranges: list[Range]) -> list[Range]:
    # Ranges are nested or apart, so in this order only the latest kept one can cover the next.
    kept: list[Range] = []
    for one in sorted(ranges, key=lambda r: (r.first, -r.last)):
        if not kept or not kept[-1].covers(one):
            kept.append(one)
    return kept


def current(spark: SparkSession, path: str) -> list[str]:
    """The folders that hold every batch once, in order; for any reader that takes a list of paths."""
    return [f"{path}/{one.name}" for one in _counting(_ranges(spark, path))]


def commit(spark: SparkSession, path: str, batch_id: int, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a folder and show it as that of the batch; a repeated batch replaces its own."""
    name = f"batch_id={batch_id}"
    known = _ranges(spark, path)
    if any(one.first <= batch_id <= one.last and one.name != name for one in known):
        raise ValueError(f"{path} holds batch {batch_id} among merged ones: it belongs to another checkpoint")
    staged = f"{path}/{STAGED}/{name}"
    write(staged)
    if not file_names(spark, staged):
        return  # a writer that leaves no files, the console say
    if any(one.name == name for one in known):
        remove_folder(spark, f"{path}/{name}")
    move(spark, staged, f"{path}/{name}")


Merge = Callable[[SparkSession, list[str], str], None]


def merge_parquet(spark: SparkSession, paths: list[str], target: str) -> None:
    _gathered(spark.read.parquet(*paths), paths).write.mode("overwrite").parquet(target)


def merge_lines(spark: SparkSession, paths: list[str], target: str) -> None:
    """For all kinds of files with a row per line: dumps, result files, documents."""
    _gathered(spark.read.text(paths), paths).write.mode("overwrite").text(target)


FILE_BYTES = 128 << 20


def _gathered(frame: DataFrame, paths: list[str]) -> DataFrame:
    return frame.coalesce(1 + sum(folder_bytes(frame.sparkSession, path) for path in paths) // FILE_BYTES)


def merge(spark: SparkSession, path: str, how: Merge, fan: int = 10, spare: int = 2) -> bool:
    """Merge the first ``fan`` neighbours of about one size; false if there are none.

    Called after each batch it keeps fewer than ``fan`` folders of each size, 1, ``fan``, ``fan``^2 and so on, plus those
    that wait for removal, and writes a row once per size. The last ``spare`` batches stay single, as Spark may repeat them.
    """
    known = _ranges(spark, path)
    counting = _counting(known)
    ready = counting[:-spare] if spare else counting
    for at in range(len(ready) - fan + 1):
        run = ready[at : at + fan]
        if len({_size(len(one), fan) for one in run}) == 1:
            break
    else:
        return False
    for old in known:
        if old not in counting:
            remove_folder(spark, f"{path}/{old.name}")
    name = f"batch_id={run[0].first}-{run[-1].last}"
    staged = f"{path}/{STAGED}/{name}"
    how(spark, [f"{path}/{one.name}" for one in run], staged)
    move(spark, staged, f"{path}/{name}")
    return True


def _size(batches: int, fan: int) -> int:
    size = 0
    while batches >= fan:
        batches, size = batches // fan, size + 1
    return size
