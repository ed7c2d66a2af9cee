"""What the operators share: reading tables, choosing columns, words."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the only separators of words: blank and U+0009 to U+000D.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrowed(frame: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under names of the operator's own.

    Whatever else a table brings, clashing names included, stays outside the plan.
    """
    return frame.select(*(frame[name].alias(own) for own, name in columns.items()))


#: Keys of a few bytes that are sent to every task: at most some 60 MB.
BROADCAST_KEYS = 1_000_000


def sent_if_few(keys: DataFrame, width: int = 1) -> DataFrame:
    """A written table of distinct short keys, marked for broadcast up to ``BROADCAST_KEYS`` rows.

    So wide rows are not shuffled to be kept or thrown away by a few keys; beyond the bound
    both sides of the join are shuffled. The result is the same. Of rows ``width`` times as wide
    as a short key, fewer are sent.
    """
    return F.broadcast(keys) if keys.count() * width <= BROADCAST_KEYS else keys


#: Rows of a task when at most so many are known to come: short keys, and texts that are worked on.
KEYS, TEXTS = 50_000, 2_000


def gathered(frame: DataFrame, most: int, each: int) -> DataFrame:
    """``frame`` in at most a task per ``each`` of ``most`` rows.

    A task that has a few rows costs as much as its file, so a small table does not take as many
    as a shuffle has partitions. A table of more rows than that is left as it is.
    """
    return frame.coalesce(max(1, -(-most // each)))


def matching(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is among ``keys``; see :func:`sent_if_few`."""
    return rows.join(sent_if_few(keys), on, "left_semi")


def counted(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """(key, n): how often each of a written table of distinct keys occurs in ``rows``; absent ones are left out.

    A few keys are sent to the rows before these are counted. Otherwise the rows are counted
    first, so a key that a third of them have is one row per task before it is shuffled.
    """
    sent = sent_if_few(keys)
    if sent is not keys:
        return rows.join(sent, on).groupBy(on).agg(F.count("*").alias("n"))
    return rows.groupBy(on).agg(F.count("*").alias("n")).join(keys, on)


def split_words(text: Column, separators: str) -> Column:
    """Words between runs of separators, without empty ones; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches of wide rows in small parts, so that only a few become Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system for a folder (local, HDFS, S3, GCS) and the folder's path in it."""
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


#: Bytes of members that a task packs or compares at a time, and of one part that it holds.
GATHERED, HELD = 12_000_000, 48_000_000


def part_bits(spark: SparkSession) -> int:
    """Bits of a part's number: several parts for each task of a shuffle."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(16, max(10, (8 * tasks).bit_length()))


def dealt(lists: Iterator[np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    """(part, members): arrays of longs, a row per member, packed by the first bits of their first columns.

    The first column is a hash. Many members in one row of Spark's cost far less to shuffle than a row each.
    """

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        members = np.concatenate(held)
        parts = (members[:, 0].view(np.uint64) >> np.uint64(64 - bits)).astype(np.uint16)
        members = members[np.argsort(parts, kind="stable")]
        counts = np.bincount(parts, minlength=1 << bits)
        found = np.flatnonzero(counts)
        offsets = np.concatenate(([0], np.cumsum(counts[found]))) * members.shape[1] * members.itemsize
        octets = pa.Array.from_buffers(pa.binary(), len(found), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(members)])
        return pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), octets], names=["part", "members"])

    held, waiting = [], 0
    for members in lists:
        held.append(members)
        waiting += members.nbytes
        if waiting >= GATHERED:
            yield packed(held)
            held, waiting = [], 0
    if waiting:
        yield packed(held)


def by_parts(
    batches: Iterator[pa.RecordBatch],
    width: int,
    whole: Callable[[np.ndarray], Iterator[pa.RecordBatch]],
    thinned: Callable[[np.ndarray], tuple[np.ndarray, list[pa.RecordBatch]]],
) -> Iterator[pa.RecordBatch]:
    """What ``whole`` makes of the members of whole parts, from rows of ``dealt`` sorted by part.

    Of a part beyond ``HELD`` bytes ``thinned`` says which members stay, and what it has made of the others.
    """
    held, waiting, part, bound = [], 0, None, HELD
    for batch in slices(batches, 200):
        for own, octets in zip(batch.column("part").to_pylist(), batch.column("members"), strict=True):
            if own != part and waiting >= GATHERED:
                yield from whole(np.concatenate(held))
                held, waiting = [], 0
            if own != part:
                part, bound = own, waiting + HELD
            elif waiting > bound:
                members, made = thinned(np.concatenate(held))
                yield from made
                held, waiting = [members], members.nbytes
                bound = waiting + HELD
            held.append(np.frombuffer(octets.as_buffer(), dtype=np.int64).reshape(-1, width))
            waiting += held[-1].nbytes
    if waiting:
        yield from whole(np.concatenate(held))
