"""Exact search for similar texts among those whose candidates failed: a prefix filter.

Candidates are stars: a text is held against one member of a bucket, not against all. Where
such a comparison fails, the other members may still be similar. Two sets whose Jaccard
similarity is ``s`` or more share one of the first ``n - ceil(s * n) + 1`` members of each in
any common order; with rare shingles first few other sets share it. Pairs that do are thinned
by bounds that lose none: sizes, places in the order, and a sketch of parities.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillcast.llm.common import KEYS, TEXTS, by_parts, dealt, gathered, part_bits, slices
from quillcast.session import written

#: Buckets that shingles are counted in, for the order: 8 MB for every task.
BUCKETS = 1 << 21
#: Rows of one shingle that a task joins; beyond that the shingle is dealt out.
SALT_ROWS = 5_000
#: Rows of one shingle that are compared in one task.
CROWD = 2_000
#: Pairs compared at a time.
PAIRS = 500_000
#: Buckets whose counts travel together.
COUNTS = 1 << 10
#: Candidates on the longest way from one member of a bucket to another, by way of heads.
HOPS = 4
#: Longs of a sketch: differing parities are never more than differing shingles. Half of the bits differ in unlike texts,
#: so 16 longs tell these apart up to some 2,000 shingles; 4 did up to 500, and longer ones grew with the square of the texts.
SKETCH = 16
#: Longs of a text's row: a shingle, node and root, size and place in the order, the sketch.
KEY, NODE, ROOT, PLACE, ODD = 0, slice(1, 3), slice(3, 5), 5, slice(6, 6 + SKETCH)


def contested(failed: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, root) of all texts that may be similar to one of another component, untested.

    A bucket holds fingerprints, each with its texts. All its fingerprints are held against one of
    them, first text against first text, and all texts of a fingerprint against its first.
    ``failed(lo, hi, far, crowded, within)`` are the candidates that were not similar enough, ``roots(node, root)``
    the components found. ``within``: both have one fingerprint. ``crowded``: a third fingerprint is in the
    bucket. ``far``: less similar than 1 - HOPS * (1 - s). Candidates lead from any member to any
    other in HOPS steps, and 1 - Jaccard is a metric, so for two members that are similar but
    apart, either

    * one candidate on the way failed: it is not far, and it lies between their components;
    * several failed, all of different fingerprints: two at the head, which lead to their components;
    * or one failed within a fingerprint: their components are next to one that this splits.
    """
    lo = roots.select(F.col("node").alias("lo"), F.col("root").alias("a"), F.lit(True).alias("a_linked"))
    hi = roots.select(F.col("node").alias("hi"), F.col("root").alias("b"), F.lit(True).alias("b_linked"))
    named = failed.join(lo, "lo", "left").join(hi, "hi", "left").withColumn("a", F.coalesce("a", "lo")).withColumn("b", F.coalesce("b", "hi"))
    # A component of one text has nothing else to be compared.
    named = named.withColumn("single", F.col("a_linked").isNull() & F.col("b_linked").isNull())
    apart = written(named.where("a <> b").select("lo", "hi", "a", "b", "far", "crowded", "within", "single"), "failed")
    both = F.explode(F.array("a", "b")).alias("root")
    between = apart.where("not far and not single").select(both)

    sides = F.array(F.struct(F.col("lo").alias("head"), F.col("b").alias("root")), F.struct(F.col("hi").alias("head"), F.col("a").alias("root")))
    around = apart.where("crowded").select(F.inline(sides))
    heads = written(around.groupBy("head").agg((F.min("root") != F.max("root")).alias("several")).where("several").select("head"), "heads")
    around = around.join(heads, "head", "left_semi").select("root")

    split = written(apart.where("within").select(both).distinct(), "split")
    a, b = (split.select(F.col("root").alias(end), F.lit(True).alias(f"{end}_split")) for end in "ab")
    beside_split = apart.join(a, "a", "left").join(b, "b", "left").where("a_split or b_split").select(both)

    left = written(between.union(around).union(beside_split).distinct(), "contested")
    return left.select(F.col("root").alias("node"), "root").union(roots.join(left, "root", "left_semi").where("node <> root").select("node", "root"))


def _hashed(shingles: set | np.ndarray) -> np.ndarray:
    if isinstance(shingles, np.ndarray):
        return shingles
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter(map(digest, shingles), dtype=np.uint64, count=len(shingles)).view(np.int64))


def beside(pairs: DataFrame, roots: DataFrame, most: int) -> DataFrame:
    """(node, root) of the members of all buckets in which a candidate failed; ``pairs`` has at most ``most`` rows.

    For candidates that hold every member of a bucket against its leader: of two members that were not
    compared and are still apart, at least one differs from the leader, and both are its neighbours. Two texts that
    have only each other are done.
    """
    ends = pairs.select(F.explode(F.array("lo", "hi")).alias("node"))
    single = ends.groupBy("node").agg(F.count("*").alias("n")).where("n = 1").select("node")
    root = F.coalesce("root", "node")
    named = pairs
    for end in ("lo", "hi"):
        known = roots.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root"))
        alone = single.select(F.col("node").alias(end), F.lit(True).alias(f"{end}_alone"))
        named = named.join(known, end, "left").join(alone, end, "left")
    apart = named.where((F.coalesce("lo_root", "lo") != F.coalesce("hi_root", "hi")) & ~(F.coalesce("lo_alone", F.lit(False)) & F.coalesce("hi_alone", F.lit(False))))
    failed = written(gathered(apart.select(F.explode(F.array("lo", "hi")).alias("node")).distinct(), 2 * most, KEYS), "failed")
    either = pairs.select("lo", "hi").union(pairs.select("hi", "lo"))
    around = either.join(failed, either["lo"] == failed["node"], "left_semi").select(F.col("hi").alias("node"))
    members = around.union(failed).distinct()
    return members.join(roots, "node", "left").select("node", root.alias("root"))


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes.view(np.uint64) >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1)


def _weights(items: DataFrame, shingled: Callable[[str], set | np.ndarray], most: int) -> np.ndarray:
    """How many texts have a shingle of each bucket, counted over all of them."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, dtype=np.int32)
        for batch in slices(batches, 2000):
            found = [_bucket(_hashed(shingled(text))) for text in batch.column("text").to_pylist()]
            counts += np.bincount(np.concatenate(found or [np.empty(0, dtype=np.int64)]), minlength=BUCKETS).astype(np.int32)
        some = [(part, own.tobytes()) for part, own in enumerate(counts.reshape(-1, COUNTS)) if own.any()]
        yield pa.RecordBatch.from_pydict({"part": pa.array([part for part, _ in some], pa.int32()), "counts": pa.array([own for _, own in some], pa.binary())})

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in slices(batches):
            for part, own in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                sums[part] = sums.get(part, 0) + np.frombuffer(own, dtype=np.int32).astype(np.int64)
        counts = [np.minimum(own, 2**31 - 1).astype(np.int32).tobytes() for own in sums.values()]
        yield pa.RecordBatch.from_pydict({"part": pa.array(list(sums), pa.int32()), "counts": pa.array(counts, pa.binary())})

    schema = "part int, counts binary"
    # At most a number per bucket reaches the driver.
    counts = items.select("text").mapInArrow(counted, schema).repartition("part")
    found = gathered(counts, most, TEXTS).mapInArrow(summed, schema).toArrow()
    weights = np.zeros((BUCKETS // COUNTS, COUNTS), dtype=np.int32)
    for part, own in zip(found.column("part").to_pylist(), found.column("counts").to_pylist(), strict=True):
        weights[part] = np.frombuffer(own, dtype=np.int32)
    return weights.ravel()


def _prefixes(shingled: Callable[[str], set | np.ndarray], similarity: float, weights: np.ndarray, bits: int):
    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in slices(batches, 100):
            names = (np.frombuffer(b"".join(batch.column(name).to_pylist()), dtype=np.int64).reshape(-1, 2) for name in ("node", "root"))
            for text, *named in zip(batch.column("text").to_pylist(), *names, strict=True):
                hashes = _hashed(shingled(text))
                weight = weights[_bucket(hashes)]
                first = len(hashes) - math.ceil(similarity * len(hashes) - 1e-9) + 1
                order = np.lexsort((hashes, weight))[:first]
                # What no other text's shingle shares a bucket with, no other text has.
                at = np.flatnonzero(weight[order] > 1)
                odd = np.bincount(hashes & (64 * SKETCH - 1), minlength=64 * SKETCH) & 1
                rows = np.empty((len(at), 6 + SKETCH), dtype=np.int64)
                rows[:, KEY] = hashes[order[at]]
                rows[:, NODE], rows[:, ROOT] = named
                rows[:, PLACE] = (len(hashes) << 32) | at
                rows[:, ODD] = np.packbits(odd.astype(np.uint8)).view(np.int64)
                yield rows

    def prefixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from dealt(members(batches), bits)

    return prefixed


def _grouped(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of keys that several roots have, by key, the root that has most of them last; and which are not of that root."""
    rows = rows[np.lexsort((rows[:, ROOT][:, 1], rows[:, ROOT][:, 0], rows[:, KEY]))]
    other = (rows[1:, KEY] != rows[:-1, KEY]) | (rows[1:, ROOT] != rows[:-1, ROOT]).any(axis=1)
    runs = np.flatnonzero(np.concatenate((np.ones(min(1, len(rows)), dtype=bool), other)))
    sizes, keys = np.diff(np.append(runs, len(rows))), rows[runs, KEY]
    order = np.lexsort((sizes, keys))
    last = np.concatenate((keys[order][1:] != keys[order][:-1], np.ones(min(1, len(keys)), dtype=bool)))
    most = np.zeros(len(runs), dtype=bool)
    most[order[last]] = True
    most = np.repeat(most, sizes)
    order = np.lexsort((most, rows[:, KEY]))
    rows, left = rows[order], ~most[order]
    several = np.isin(rows[:, KEY], rows[left, KEY])
    return rows[several], left[several]


def _near(rows: np.ndarray, similarity: float) -> Iterator[pa.RecordBatch]:
    """The pairs of nodes among rows from ``_prefixes`` that share a key and pass the bounds."""
    rows, left = _grouped(rows)
    if not len(rows):
        return
    ends = np.searchsorted(rows[:, KEY], rows[:, KEY], side="right")
    lefts = np.flatnonzero(left)
    pairs = ends[lefts] - lefts - 1
    sizes, at = (rows[:, PLACE] >> 32).astype(np.int32), rows[:, PLACE].astype(np.int32)
    reach = sizes - at
    roots, nodes = np.ascontiguousarray(rows[:, ROOT]), np.ascontiguousarray(rows[:, NODE])
    sketches = np.ascontiguousarray(rows[:, ODD]).view(np.uint64)  # of a negative number, the bits of its absolute value would count
    # Blocks of a bounded number of pairs, or one row's.
    blocks = (np.cumsum(pairs) - 1) // PAIRS
    for some in np.split(np.arange(len(lefts)), np.flatnonzero(np.diff(blocks)) + 1):
        many = pairs[some]
        l = np.repeat(lefts[some], many)
        r = l + 1 + np.arange(len(l)) - np.repeat(np.cumsum(many) - many, many)
        both = sizes[l] + sizes[r]
        near = np.minimum(reach[l], reach[r]) >= similarity / (1 + similarity) * both - 1e-6
        near &= np.minimum(sizes[l], sizes[r]) >= similarity * np.maximum(sizes[l], sizes[r]) - 1e-6
        l, r, both = l[near], r[near], both[near]
        near = (roots[l] != roots[r]).any(axis=1)
        near &= np.bitwise_count(sketches[l] ^ sketches[r]).sum(axis=1, dtype=np.int32) <= (1 - similarity) / (1 + similarity) * both + 1e-6
        ends_ = np.column_stack((nodes[l[near]], nodes[r[near]]))
        yield _pairs(_ordered(ends_))


def _ordered(ends: np.ndarray) -> np.ndarray:
    """Pairs of nodes with the lesser first, mostly once each."""
    octets = ends.byteswap().view(np.uint64)
    turned = (octets[:, 0] > octets[:, 2]) | ((octets[:, 0] == octets[:, 2]) & (octets[:, 1] > octets[:, 3]))
    ends[turned] = ends[turned][:, [2, 3, 0, 1]]
    # A digest's half is as good as a hash: equal pairs lie together, and seldom others between them.
    ends = ends[np.argsort(ends[:, 0] ^ ends[:, 3], kind="stable")]
    return ends[np.concatenate((np.ones(min(1, len(ends)), dtype=bool), (ends[1:] != ends[:-1]).any(axis=1)))]


def _binary(halves: np.ndarray) -> pa.Array:
    """Digests from their halves."""
    offsets = np.arange(len(halves) + 1, dtype=np.int32) * 16
    return pa.Array.from_buffers(pa.binary(), len(halves), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(halves))])


FOUND = pa.schema(
    [("lo", pa.binary()), ("hi", pa.binary()), ("key", pa.int64()), ("node", pa.binary()), ("root", pa.binary()), ("n", pa.int32()), ("at", pa.int32())]
    + [(f"s{at}", pa.int64()) for at in range(SKETCH)]
)


def _pairs(ends: np.ndarray) -> pa.RecordBatch:
    columns = [_binary(ends[:, :2]), _binary(ends[:, 2:])]
    return pa.RecordBatch.from_arrays(columns + [pa.nulls(len(ends), field.type) for field in list(FOUND)[2:]], schema=FOUND)


def _crowd(rows: np.ndarray) -> pa.RecordBatch:
    """Rows that are left to a join."""
    columns = [pa.nulls(len(rows), pa.binary()), pa.nulls(len(rows), pa.binary()), pa.array(rows[:, KEY])]
    columns += [_binary(rows[:, NODE]), _binary(rows[:, ROOT]), pa.array((rows[:, PLACE] >> 32).astype(np.int32)), pa.array(rows[:, PLACE].astype(np.int32))]
    return pa.RecordBatch.from_arrays(columns + [pa.array(column) for column in rows[:, ODD].T], schema=FOUND)


def _searched(similarity: float):
    """Pairs of the keys with few rows, and the rows of other keys, from rows sorted by part."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crowded: set[int] = set()

        def parted(rows: np.ndarray) -> tuple[np.ndarray, list[pa.RecordBatch]]:
            keys, counts = np.unique(rows[:, KEY], return_counts=True)
            crowded.update(keys[counts > CROWD].tolist())
            many = np.isin(rows[:, KEY], np.array(list(crowded), dtype=np.int64))
            return rows[~many], [_crowd(rows[many])] if many.any() else []

        def whole(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            rows, made = parted(rows)
            yield from made
            yield from _near(rows, similarity)
            crowded.clear()

        yield from by_parts(batches, 6 + SKETCH, whole, parted)

    return searched


def close(items: DataFrame, shingled: Callable[[str], set | np.ndarray], similarity: float) -> DataFrame:
    """(lo, hi): all pairs of nodes of different roots that may be similar enough, and some others.

    ``items(node, root, text)`` has a row per node, nodes and roots being digests of 16 bytes. ``shingled`` gives
    a text's set of shingles, or their hashes as longs, each once. Rows of the
    root that has most rows of a shingle are not held against each other. A task compares the rows of
    many shingles; those of a shingle with more than ``CROWD`` go to a join that deals them over several
    tasks. The order goes by exact counts of buckets of shingles over all items: rare ones first, and
    what several share by chance only costs a comparison.
    """
    spark, most = items.sparkSession, items.count()
    weights = _weights(items, shingled, most)
    prefixes = items.select("node", "root", "text").mapInArrow(_prefixes(shingled, similarity, weights, part_bits(spark)), "part int, members binary")
    sorted_ = prefixes.repartition("part").sortWithinPartitions("part")
    schema = "lo binary, hi binary, key long, node binary, root binary, n int, at int, " + ", ".join(f"s{at} long" for at in range(SKETCH))
    # A part stays in one task, and its rows together.
    searched = written(gathered(sorted_, most, TEXTS).mapInArrow(_searched(similarity), schema), "searched")
    found = searched.where("key is null").select("lo", "hi")
    rows = searched.where("key is not null").drop("lo", "hi")
    if rows.isEmpty():
        return written(gathered(found.distinct(), searched.count(), KEYS), "close")
    return written(found.union(_joined(rows, similarity)).distinct(), "close")


def _joined(rows: DataFrame, similarity: float) -> DataFrame:
    """The pairs among rows of keys that many texts have, each key dealt over several tasks."""
    sketch = [f"s{at}" for at in range(SKETCH)]
    owned = rows.groupBy("key", "root").agg(F.count("*").alias("n"))
    shared = owned.groupBy("key").agg(F.count("*").alias("roots"), F.sum("n").alias("rows"), F.max(F.struct("n", "root")).alias("most"))
    parts = F.ceil(F.col("rows") / SALT_ROWS).cast("int")
    shared = written(shared.where("roots > 1").select("key", F.col("most.root").alias("main"), parts.alias("parts")), "shared")
    rows = written(rows.join(shared, "key"), "prefix-rows")
    left = rows.where("root <> main").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).alias("l")
    right = rows.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).alias("r")
    both = F.col("l.n") + F.col("r.n")
    apart = sum(F.bit_count(F.col(f"l.{name}").bitwiseXOR(F.col(f"r.{name}"))) for name in sketch)
    reach = F.least(F.col("l.n") - F.col("l.at"), F.col("r.n") - F.col("r.at"))
    near = (
        (F.col("l.key") == F.col("r.key"))
        & (F.col("l.part") == F.col("r.part"))
        & (F.col("l.root") != F.col("r.root"))
        & ((F.col("r.root") == F.col("r.main")) | (F.col("l.node") < F.col("r.node")))
        & (F.least("l.n", "r.n") >= similarity * F.greatest("l.n", "r.n") - 1e-6)
        & (reach >= similarity / (1 + similarity) * both - 1e-6)
        & (apart <= (1 - similarity) / (1 + similarity) * both + 1e-6)
    )
    return left.join(right, near).select(F.least("l.node", "r.node").alias("lo"), F.greatest("l.node", "r.node").alias("hi"))
