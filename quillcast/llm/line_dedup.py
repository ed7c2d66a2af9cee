"""Fuzzy line deduplication: MinHash of character shingles, banding, exact check, union-find.

Lines are brought together by bands of their signature. In a band's bucket each line is
linked to the bucket's leader and to the line whose signature is nearest to its own, two
candidates per line however large the bucket, and every bucket has a leader of its own. All
candidates are checked by the exact Jaccard similarity of their shingle sets. Where one fails,
the lines around it that are still in different components are searched for similar pairs by
their rare shingles (``overlaps``), so no bucket hides a link. One line per connected component
stays: its first by document id and line number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillcast.llm.common import KEYS, TEXTS, by_parts, dealt, gathered, matching, narrowed, part_bits, sent_if_few, slices
from quillcast.llm.components import components
from quillcast.llm.overlaps import beside, close
from quillcast.session import written

#: 14 bands of 4 rows bring a pair at similarity 0.8 together with a chance of 99.9 %.
BANDS, ROWS = 14, 4
#: Lines of one bucket compared with each other when looking for the nearest.
BLOCK = 512
#: Numbers of a bucket's member: the bucket, its turn there, the line's sketch.
MEMBER = 3
#: Characters signed at a time; the working arrays stay in the processor's cache.
STEP_CHARS = 100_000


def shingles(line: str, size: int) -> set[str]:
    """Character shingles; a shorter line is one."""
    return {line[at : at + size] for at in range(len(line) - size + 1)} or {line}


def jaccard(a: set, b: set) -> float:
    common = len(a & b)
    return common / (len(a) + len(b) - common)


def packed(line: str, size: int) -> np.ndarray | None:
    """The different shingles of a line in ascending order, a number for each, where they fit into one."""
    if size != 8 or len(line) < size:
        return None
    try:
        octets = line.encode("latin-1")
    except UnicodeEncodeError:
        return None
    # A character is a byte and a shingle all eight of a number, so no two shingles share one.
    values = np.sort(np.ndarray(len(octets) - 7, dtype="<u8", buffer=octets, strides=1))
    return values[np.concatenate(([True], values[1:] != values[:-1]))]


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether the Jaccard similarity of two sets from ``packed`` is at least ``similarity``."""
    if min(len(a), len(b)) / max(len(a), len(b)) < similarity:
        return False
    both = np.concatenate((a, b))
    both.sort()
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return common / (len(both) - common) >= similarity


def hashed(line: str, size: int) -> np.ndarray:
    """A hash of each shingle, the same in every line."""
    found = packed(line, size)
    if found is None:
        plain, other = [], []
        for one in shingles(line, size):
            value = packed(one, size)
            if value is None:
                other.append(xxhash.xxh64_intdigest(one.encode("utf-8", "surrogatepass")))
            else:
                plain.append(value)
        both = (_mixed(np.concatenate(plain or [np.empty(0, dtype=np.uint64)])), np.array(other, dtype=np.uint64))
        return np.unique(np.concatenate(both)).view(np.int64)
    return _mixed(found).view(np.int64)


def _mixed(values: np.ndarray) -> np.ndarray:
    """Each bit spread over the others; different numbers stay different."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def band_hashes(lines: list[str], size: int, bands: int = BANDS, rows: int = ROWS, seed: int = 7) -> np.ndarray:
    """One row per line: its band hashes, and last a sketch of one bit per minimum."""
    rng = np.random.default_rng(seed)
    flips = rng.integers(0, 2**32, bands * rows, dtype=np.uint32)
    factors = rng.integers(0, 2**31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    minima = np.empty((bands * rows, len(lines)), dtype=np.uint32)
    at = 0
    while at < len(lines):
        end, chars = at, 0
        while end < len(lines) and (end == at or chars + len(lines[end]) <= STEP_CHARS):
            chars += len(lines[end])
            end += 1
        padded = [line.ljust(size, "\0") for line in lines[at:end]]
        points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
        hashed = np.zeros(len(points) - size + 1, dtype=np.uint64)
        for place in range(size):
            hashed = hashed * np.uint64(0x9E3779B97F4A7C15) + points[place : place + len(hashed)]
        hashed ^= hashed >> np.uint64(29)
        hashed *= np.uint64(0xBF58476D1CE4E5B9)
        short = (hashed >> np.uint64(32)).astype(np.uint32)
        lengths = np.array([len(line) for line in padded])
        begins = np.cumsum(lengths) - lengths
        # Shingles that cross into the next line lie between a line's end and the next begin.
        cuts = np.column_stack((begins, begins + lengths - size + 1)).ravel()[:-1]
        mixed = np.empty_like(short)
        for row in range(bands * rows):
            np.bitwise_xor(short, flips[row], out=mixed)
            np.multiply(mixed, factors[row], out=mixed)
            minima[row, at:end] = np.minimum.reduceat(mixed, cuts)[::2]
        at = end
    found = np.zeros((len(lines), bands + 1), dtype=np.uint64)
    for band in range(bands):
        value = np.full(len(lines), band + 1, dtype=np.uint64)
        for row in range(rows):
            value = (value ^ minima[band * rows + row]) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(32)
        found[:, band] = value
    for row in range(bands * rows):
        found[:, bands] |= ((minima[row] * np.uint32(2654435761)) >> np.uint32(31)).astype(np.uint64) << np.uint64(row)
    return found


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, row, line, text): lines that hold a word, numbered from 0; blank ones are left alone.

    ``row`` is a digest of the whole text: rows that share an id are told apart by it.
    """
    rows = narrowed(docs, doc=id_col, text=text_col).where(F.col("text").isNotNull())
    return rows.select("doc", F.xxhash64("text").alias("row"), F.posexplode(F.split("text", "\n")).alias("line", "text")).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def _keyed(lines: DataFrame) -> DataFrame:
    """``digest`` names a line; the shorter ``key`` travels where a collision only costs a comparison."""
    return lines.withColumn("digest", F.unhex(F.md5("text"))).withColumn("key", F.xxhash64("text"))


def _bucketed(size: int, bits: int):
    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            once = dict(zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True))
            hashes = band_hashes(list(once.values()), size).view(np.int64)
            buckets = hashes[:, :BANDS].ravel()
            keys = np.repeat(np.fromiter(once, dtype=np.int64, count=len(once)), BANDS)
            # The bucket makes another order of each: every bucket gets a leader of its own.
            yield np.column_stack((buckets, keys ^ buckets, np.repeat(hashes[:, BANDS], BANDS)))

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from dealt(members(batches), bits)

    return signed


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two links per member of a bucket. Rows come sorted by part.

    Of a part too large to hold, the buckets larger than a block are linked at once and only their leaders
    held, so a large bucket is never held whole.
    """
    leading: dict[int, int] = {}

    def once(members: np.ndarray) -> np.ndarray:
        """By bucket and turn, each once."""
        members = members[np.lexsort((members[:, 1], members[:, 0]))]
        other = (members[1:, 0] != members[:-1, 0]) | (members[1:, 1] != members[:-1, 1])
        return members[np.concatenate((np.ones(min(1, len(members)), dtype=bool), other))]

    def alike(members: np.ndarray) -> np.ndarray:
        """Those not alone in their bucket."""
        order = np.argsort(members[:, 0])
        buckets = members[order, 0]
        same = np.concatenate(([False], buckets[1:] == buckets[:-1], [False]))
        return once(members[order[same[1:] | same[:-1]]])

    def linked(members: np.ndarray) -> pa.RecordBatch:
        buckets, turns, sketches = np.ascontiguousarray(members.T)
        heads = np.flatnonzero(np.concatenate((np.ones(min(1, len(buckets)), dtype=bool), buckets[1:] != buckets[:-1])))
        sizes = np.diff(np.append(heads, len(buckets)))
        first = turns[heads]
        for at in np.flatnonzero(np.isin(buckets[heads], list(leading))) if leading else ():
            first[at] = leading[int(buckets[heads[at]])]
        leaders = np.repeat(first, sizes)
        nearest = turns.copy()
        for head, size in zip(heads[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            for begin in range(head, head + size, BLOCK):
                end = min(begin + BLOCK, head + size)
                apart = np.bitwise_count(sketches[begin:end, None] ^ sketches[None, begin:end])
                np.fill_diagonal(apart, 64)
                nearest[begin:end] = turns[begin + apart.argmin(axis=1)]
        a, b = np.concatenate((leaders, nearest)), np.concatenate((turns, turns))
        buckets = np.concatenate((buckets, buckets))
        wanted = a != b
        a, b = a[wanted] ^ buckets[wanted], b[wanted] ^ buckets[wanted]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    def whole(members: np.ndarray) -> Iterator[pa.RecordBatch]:
        yield linked(alike(members))
        leading.clear()

    def thinned(members: np.ndarray) -> tuple[np.ndarray, list[pa.RecordBatch]]:
        members = once(members)
        values, counts = np.unique(members[:, 0], return_counts=True)
        large = np.isin(members[:, 0], values[counts > BLOCK])
        some = members[large]
        made = [linked(some)]
        heads = some[np.flatnonzero(np.diff(some[:, 0], prepend=~some[:1, 0]))]
        for bucket, turn in heads[:, :2].tolist():
            leading.setdefault(bucket, turn)
        # The leader stays, so that one more member is not alone.
        return np.concatenate((members[~large], heads)), made

    yield from by_parts(batches, MEMBER, whole, thinned)


def _verified(pairs: DataFrame, texts: DataFrame, size: int, similarity: float, most: int) -> DataFrame:
    """Of the pairs of digests (lo, hi), at most ``most``, those whose lines are similar enough."""

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left, own = None, None, None
        for batch in slices(batches, 2000):
            near = []
            for a, b in zip(batch.column("lo_text").to_pylist(), batch.column("hi_text").to_pylist(), strict=True):
                if a != last:
                    last, left, own = a, packed(a, size), None
                right = None if left is None else packed(b, size)
                if right is None:
                    own = own or shingles(a, size)
                    near.append(jaccard(own, shingles(b, size)) >= similarity)
                else:
                    near.append(similar(left, right, similarity))
            yield pa.RecordBatch.from_arrays([batch.column("lo"), batch.column("hi")], names=["lo", "hi"]).filter(pa.array(near, pa.bool_()))

    lo = texts.select(F.col("digest").alias("lo"), F.col("text").alias("lo_text"))
    hi = texts.select(F.col("digest").alias("hi"), F.col("text").alias("hi_text"))
    both = pairs.join(hi, "hi").join(lo, "lo").select("lo", "hi", "lo_text", "hi_text")
    return gathered(both, most, TEXTS).mapInArrow(checked, "lo binary, hi binary")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 8, similarity: float = 0.8) -> DataFrame:
    """(doc, line, class_doc, class_line, kept) for every line of ``docs`` that holds a word.

    Lines whose sets of ``size``-character shingles have a Jaccard similarity of
    ``similarity`` or more are linked; a class is a connected component, named by its first
    line in order of document id and line number, the one kept. Equal lines are always of one
    class. Null texts have no lines; blank lines are not listed. Rows with a null id come
    first in that order. Rows that share an id are told apart by their texts, in the order of
    a digest where line numbers are equal; rows that repeat id and text count as one, kept or
    dropped together. Empty tables give no rows; other columns are ignored.
    """
    return _classes(docs, id_col, text_col, size, similarity).drop("row")


def _classes(docs: DataFrame, id_col: str, text_col: str, size: int, similarity: float) -> DataFrame:
    """``classes`` with ``row``, the digest of the row's text."""
    lines = _keyed(lines_of(docs, id_col, text_col))
    bucketed = lines.select("key", "text").mapInArrow(_bucketed(size, part_bits(docs.sparkSession)), "part int, members binary")
    sorted_ = bucketed.repartition("part").sortWithinPartitions("part")
    pairs = written(sorted_.mapInArrow(_candidates, "a long, b long").distinct(), "pairs")
    paired = pairs.count()
    wanted = written(gathered(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), 2 * paired, KEYS), "colliding")
    texts = matching(lines, wanted, "key").select("key", "digest", "text").dropDuplicates(["digest"])
    texts = written(gathered(texts, wanted.count(), TEXTS), "texts")
    first, second = (texts.select(F.col("key").alias(key), F.col("digest").alias(digest)) for key, digest in (("a", "lo"), ("b", "hi")))
    # Different lines under one key are candidates too.
    twins = texts.groupBy("key").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).where("lo <> hi").select("lo", "hi")
    candidates = pairs.join(first, "a").join(second, "b").select("lo", "hi").where("lo <> hi").union(twins)
    candidates = written(gathered(candidates, paired, KEYS), "candidates")
    tested = candidates.count()
    found = written(_verified(candidates, texts, size, similarity, tested), "similar")
    roots = written(components(found, found.count()), "roots")
    # Members of a bucket that were tested against its leader only, not against each other.
    rest = beside(candidates, roots, tested).join(texts.select(F.col("digest").alias("node"), "text"), "node")
    rest = written(gathered(rest, texts.count(), TEXTS), "rest")
    if not rest.isEmpty():
        near = close(rest, lambda line: hashed(line, size), similarity)
        late = _verified(near.join(candidates, ["lo", "hi"], "left_anti"), texts, size, similarity, near.count())
        late = written(late, "late")
        if not late.isEmpty():
            # The components found so far are stars: they link what their links did.
            stars = roots.select(F.col("root").alias("lo"), F.col("node").alias("hi")).union(late)
            roots = written(components(stars, stars.count()), "roots")

    where = written(lines.select("doc", "row", "line", "digest"), "places")
    placed = where.count()
    repeated = where.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    # Most lines occur once and are like no other: those are classes of their own.
    shared = written(gathered(repeated.union(roots.select(F.col("node").alias("digest"))).distinct(), placed, KEYS), "shared")
    sent = sent_if_few(shared, 2)
    members = where.join(sent, "digest", "left_semi").join(sent_if_few(roots, 3).withColumnRenamed("node", "digest"), "digest", "left")
    members = written(gathered(members.select("doc", "row", "line", F.coalesce("root", "digest").alias("root")), placed, KEYS), "members")
    own = F.struct("doc", "line", "row")
    least = written(gathered(members.groupBy("root").agg(F.min(own).alias("class")), placed, KEYS), "least")
    told = (F.col("class.doc").alias("class_doc"), F.col("class.line").alias("class_line"), own.eqNullSafe(F.col("class")).alias("kept"))
    alone = where.join(sent, "digest", "left_anti").select("doc", "row", "line", F.col("doc").alias("class_doc"), F.col("line").alias("class_line"), F.lit(True).alias("kept"))
    return members.join(least, "root").select("doc", "row", "line", *told).union(alone)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 8, similarity: float = 0.8) -> DataFrame:
    """``docs`` with all columns, their texts without the lines that ``classes`` does not keep.

    Other lines, blank ones included, stay in place; a text may become empty. Rows
    whose text loses nothing are unchanged. Rows that share an id, a null one included, are
    told apart by their texts.
    """
    lost = _classes(docs, id_col, text_col, size, similarity).where(~F.col("kept"))
    lost = lost.groupBy("doc", "row").agg(F.collect_set("line").alias("lost_lines"))
    lost = written(lost.select(F.col("doc").alias("lost_doc"), F.col("row").alias("lost_row"), "lost_lines"), "lost")
    joined = docs.join(lost, docs[id_col].eqNullSafe(lost["lost_doc"]) & (F.xxhash64(docs[text_col]) == lost["lost_row"]), "left")
    # Set difference of line numbers, so a text of many lines with many lost ones takes linear time.
    def rest(lines: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(lines) - 1).cast(lost.schema["lost_lines"].dataType)
        return F.array_join(F.transform(F.array_except(places, F.col("lost_lines")), lambda at: F.get(lines, at.cast("int"))), "\n")

    split_once = F.transform(F.array(F.split(docs[text_col], "\n")), rest)[0]
    text = F.when(F.col("lost_lines").isNull(), docs[text_col]).otherwise(split_once)
    return joined.select(*(text.alias(name) if name == text_col else docs[name] for name in docs.columns))
