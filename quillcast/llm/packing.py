"""Best-fit packing of tokenised documents into sequences, by exact-complement hashing.

The plan depends on the histogram of piece lengths only, which has at most ``capacity``
rows. For the longest pieces first, single lengths, pair sums and triple sums of what is
still available are looked up for the gap that they leave; combinations that fill it
exactly are consumed as often as the counts allow, and what remains is placed best-fit.
The plan says which ranks of each length go where; pieces are ranked by adding per-task
counts, so a length that a third of all pieces share is never gathered.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillcast.llm import tokens
from quillcast.llm.common import narrowed, slices
from quillcast.session import written

PIECE_TYPES = {"piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "task": pa.int32(), "nth": pa.int64()}


def cut(n_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones behind a first one that may be shorter."""
    if not n_tokens:
        return []
    first = n_tokens % capacity or capacity
    return [(0, first), *((start, capacity) for start in range(first, n_tokens, capacity))]


def _exact(gap: int, counts: list[int], smallest: int) -> tuple[int, ...] | None:
    """One to three available lengths that sum up to the gap, larger ones first."""
    if counts[gap]:
        return (gap,)
    for a in range(gap - smallest, (gap - 1) // 2, -1):
        b = gap - a
        if counts[a] and counts[b] and (a != b or counts[a] > 1):
            return (a, b)
    for a in range(gap - 2 * smallest, (gap - 1) // 3, -1):
        if not counts[a]:
            continue
        rest = gap - a
        for b in range(min(a, rest - smallest), (rest - 1) // 2, -1):
            c = rest - b
            if counts[b] and counts[c] and all(counts[x] >= k for x, k in Counter((a, b, c)).items()):
                return (a, b, c)
    return None


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of one sequence, number of such sequences), filling each as far as it goes."""
    counts = [0] * (capacity + 1)
    for length, count in histogram.items():
        counts[length] = count
    patterns: list[tuple[tuple[int, ...], int]] = []
    left: Counter = Counter()
    for length in range(capacity, 0, -1):
        while counts[length]:
            smallest = next(x for x in range(1, capacity + 1) if counts[x])
            if length == capacity:
                found: tuple[int, ...] | None = ()
            else:
                counts[length] -= 1
                found = _exact(capacity - length, counts, smallest) if smallest <= capacity - length else None
                counts[length] += 1
            if found is None:
                left[length] = counts[length]
                counts[length] = 0
                break
            pattern = (length, *found)
            times = min(counts[x] // k for x, k in Counter(pattern).items())
            for x in pattern:
                counts[x] -= times
            patterns.append((pattern, times))
    return patterns + _best_fit(left, capacity)


def _best_fit(left: Counter, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over counts: equal sequences are moved together."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for length in sorted(left, reverse=True):
        count = left[length]
        while count:
            gap = min((gap for gap, some in open_.items() if gap >= length and some), default=None)
            if gap is None:
                fit = capacity // length
                if count >= fit:
                    open_[capacity - fit * length].append(((length,) * fit, count // fit))
                    count %= fit
                if count:
                    open_[capacity - count * length].append(((length,) * count, 1))
                break
            pattern, times = open_[gap].pop()
            used = min(times, count)
            if times > used:
                open_[gap].append((pattern, times - used))
            open_[gap - length].append(((*pattern, length), used))
            count -= used
    return [one for some in open_.values() for one in some]


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[list[int], list[tuple[int, int, list[int]]]]]:
    """Per length: the ranks at which runs begin, and per run (first rank, first sequence, offsets)."""
    runs: dict[int, tuple[list[int], list[tuple[int, int, list[int]]]]] = defaultdict(lambda: ([], []))
    rank, sequence = Counter(), 0
    for pattern, times in patterns:
        offsets: dict[int, list[int]] = defaultdict(list)
        at = 0
        for length in pattern:
            offsets[length].append(at)
            at += length
        for length, places_ in offsets.items():
            begins, about = runs[length]
            begins.append(rank[length])
            about.append((rank[length], sequence, places_))
            rank[length] += times * len(places_)
        sequence += times
    return dict(runs)


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, capacity: int = 2048, glued: bool = True) -> DataFrame:
    """(id, piece, start, length, ids_crc32, task, nth): documents as ids, cut to the capacity.

    ``nth`` counts pieces of one length within ``task``. Every document ends with
    ``end_id``, so null and empty texts have one token.
    """
    ending = np.array([end_id], dtype="<u4").tobytes()

    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokenizer, glued)
        task, seen = TaskContext.get().partitionId(), Counter()
        for batch in slices(batches):
            owners, rows = [], []
            for owner, ids in enumerate(encoder.encode(batch.column("text").to_pylist())):
                ids += ending
                for number, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    owners.append(owner)
                    rows.append((number, start, length, zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)]), task, seen[length]))
                    seen[length] += 1
            columns = list(zip(*rows, strict=True)) or [()] * len(PIECE_TYPES)
            arrays = [pa.array(values, kind) for values, kind in zip(columns, PIECE_TYPES.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(owners, pa.int64())), *arrays], names=["id", *PIECE_TYPES])

    rows = narrowed(docs, id=id_col, text=text_col)
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(tokenized, f"id {kind}, piece int, start long, length long, ids_crc32 long, task int, nth long")


def pack(cut_pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` with (sequence_id, offset): every piece placed, sequences without gaps.

    Needs the columns length (1 to capacity), task and nth of ``pieces``, written. The
    histogram and the plan have a size bounded by the capacity; they alone pass the driver.
    """
    per_task = cut_pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(per_task.select("length", "task", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "ranks")
    histogram = {row["length"]: row["n"] for row in offsets.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = places(plan(histogram, capacity))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequences, offsets_ = [], []
            ranks = zip(*(batch.column(name).to_pylist() for name in ("length", "before", "nth")), strict=True)
            for length, before, nth in ranks:
                begins, about = runs[length]
                first, sequence, at = about[bisect_right(begins, before + nth) - 1]
                turn, slot = divmod(before + nth - first, len(at))
                sequences.append(sequence + turn)
                offsets_.append(at[slot])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in kept), pa.array(sequences, pa.int64()), pa.array(offsets_, pa.int64())],
                names=[*kept, "sequence_id", "offset"],
            )

    kept = [name for name in cut_pieces.columns if name not in ("task", "nth")]
    # A row per task and length grows with the input: shuffled, not broadcast, whatever its files' size.
    ranked = cut_pieces.join(offsets.select("length", "task", "before").hint("shuffle_hash"), ["length", "task"])
    schema = ", ".join(f"`{name}` {cut_pieces.schema[name].dataType.simpleString()}" for name in kept)
    return ranked.mapInArrow(placed, f"{schema}, sequence_id long, offset long")


def packed(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, capacity: int = 2048, glued: bool = True) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) per piece.

    Every row of ``docs`` is packed; repeated rows come back repeated, null ids stay null,
    null texts count as empty (their end id alone). Empty tables give no pieces. Other
    columns are ignored.
    """
    return pack(written(pieces(docs, tokenizer, id_col, text_col, end_id, capacity, glued), "pieces"), capacity)
