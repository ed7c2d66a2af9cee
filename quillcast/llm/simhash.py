"""Near-duplicates by SimHash: meet-in-the-middle ball hashing.

Two fingerprints at most ``radius`` bits apart share a variant within half of it. Every
fingerprint therefore emits all its variants within ``radius / 2`` flips, variants are
brought together, and those that collide give links. With 64 bits and radius 4 that is
2,081 variants each. They are shuffled in packed form: a row (first bits of the variant,
fingerprint, flips left) stands for all variants with these first bits, and its task
spells the rest out. Eight first bits make 37 rows of 2,081.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillcast.llm.common import matching, narrowed, slices
from quillcast.llm.components import components, forest
from quillcast.llm.overlaps import HOPS, close, contested
from quillcast.session import written

BITS = 64
#: Orders in which a variant's members are ranked to choose whom the others are linked to.
TURNS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93], dtype=np.uint64)
#: Variants that one group may hold before it is dealt out by more bits.
GROUP_VARIANTS = 4_000_000
#: Bits by which a group that holds more is split further.
SPLIT_BITS = 5


def fingerprint(text: str | None, shingle: int, seed: int) -> int:
    """Majority per bit over the shingles' XXH64, repeats included; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    last = ends[shingle - 1 :].tolist() or [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], seed) for a, b in zip(starts, last, strict=False)]
    octets = np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8)
    ones = sum(
        np.unpackbits(octets[at : at + 65536], axis=1).sum(axis=0, dtype=np.int64)
        for at in range(0, len(octets), 65536)
    )
    return int(np.packbits(2 * ones > len(octets)).view(">u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seed: int = 42) -> DataFrame:
    """(id, fp) per row, fp as a signed long. Whole texts, ASCII letters lower-cased."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        values = [fingerprint(text, shingle, seed) for text in texts]
        return pd.Series(np.array(values, dtype=np.uint64).view(np.int64))

    rows = narrowed(docs, id=id_col, text=text_col)
    return rows.select("id", of("text").alias("fp"))


def _flips(bits: int, most: int) -> np.ndarray:
    """All masks of ``bits`` bits with at most ``most`` set."""
    masks = [sum(1 << at for at in chosen) for size in range(most + 1) for chosen in combinations(range(bits), size)]
    return np.array(masks, dtype=np.uint64)


def _variant_count(free: int, left: int) -> int:
    return sum(comb(free, flips) for flips in range(left + 1))


def _deal(rows: DataFrame, depth: int, more: int, half: int) -> DataFrame:
    """Split rows that fix ``depth`` first bits of their variants by ``more`` further bits."""
    free = BITS - depth - more
    masks = [(int(mask), int(mask).bit_count()) for mask in _flips(more, half)]
    dealt = F.array(*(F.struct(F.lit(mask).cast("long").alias("mask"), F.lit(n).alias("n")) for mask, n in masks))
    own = F.shiftrightunsigned("fp", free) if free else F.col("fp")
    return (
        rows.withColumn("flip", F.explode(dealt))
        .where("flip.n <= left")
        .select(
            F.lit(depth + more).alias("depth"),
            F.shiftleft("prefix", more).bitwiseOR(own.bitwiseAND(F.lit((1 << more) - 1)).bitwiseXOR(F.col("flip.mask"))).alias("prefix"),
            "fp",
            (F.col("left") - F.col("flip.n")).alias("left"),
        )
    )


def _collisions(radius: int, stars: int):
    def linked(group: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"lo": np.array([], dtype=np.int64), "hi": np.array([], dtype=np.int64)})
        if stars:
            none["crowded"] = np.array([], dtype=bool)
        if len(group) < 2:
            return none
        depth, prefix = int(group["depth"].iloc[0]), int(group["prefix"].iloc[0]) & (2**BITS - 1)
        free = BITS - depth
        fps, lefts = group["fp"].to_numpy().view(np.uint64), group["left"].to_numpy()
        low = np.uint64((1 << free) - 1)
        base = (fps & low) | np.uint64((prefix << free) & (2**BITS - 1))
        reach = {int(left): _flips(free, int(left)) for left in np.unique(lefts)}
        owners = {left: np.flatnonzero(lefts == left) for left in reach}
        variants = np.empty(sum(len(owners[left]) * len(flips) for left, flips in reach.items()), dtype=np.uint64)
        end = 0
        for left, flips in reach.items():
            begin, end = end, end + len(owners[left]) * len(flips)
            np.bitwise_xor(base[owners[left], None], flips[None, :], out=variants[begin:end].reshape(-1, len(flips)))
        variants.sort()
        shared = np.unique(variants[1:][variants[1:] == variants[:-1]])
        del variants
        if not len(shared):
            return none
        at, who = [], []
        for left, flips in reach.items():
            step = max(1, 250_000 // len(flips))
            for begin in range(0, len(owners[left]), step):
                some = owners[left][begin : begin + step]
                values = base[some, None] ^ flips[None, :]
                place = np.minimum(np.searchsorted(shared, values), len(shared) - 1)
                row, column = np.nonzero(shared[place] == values)
                at.append(place[row, column])
                who.append(some[row])
        at, who = np.concatenate(at), np.concatenate(who)
        # Members of a variant are within the radius of each other: linking all to one of them
        # keeps them connected. What is asked of pairs beyond that is the caller's to follow up.
        turn = (who.astype(np.uint64) + np.uint64(1)) * TURNS[at % max(1, stars)] if stars else who
        order = np.lexsort((turn, at))
        at, who = at[order], who[order]
        head = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        sizes = np.diff(np.concatenate((head, [len(at)])))
        first = np.repeat(who[head], sizes)
        pairs = np.minimum(first, who).astype(np.int64) * len(fps) + np.maximum(first, who)
        # Of a pair that has company in one of its variants, the entry that says so is the last.
        pairs = np.unique(2 * pairs + np.repeat(sizes > 2, sizes))
        pairs = pairs[np.concatenate((pairs[1:] >> 1 != pairs[:-1] >> 1, [True]))]
        pairs, crowded = pairs >> 1, (pairs & 1).astype(bool)
        a, b = fps[pairs // len(fps)], fps[pairs % len(fps)]
        near = (a != b) & (np.bitwise_count(a ^ b) <= radius)
        found = zip(a[near].view(np.int64).tolist(), b[near].view(np.int64).tolist(), strict=True)
        if stars:
            return pd.DataFrame([(*pair, company) for pair, company in zip(found, crowded[near].tolist(), strict=True)], columns=["lo", "hi", "crowded"]) if near.any() else none
        kept = list(forest(found))
        return pd.DataFrame(kept, columns=["lo", "hi"]) if kept else none

    return linked


def links(fps: DataFrame, radius: int = 4, bits: int = BITS, stars: int = 0) -> DataFrame:
    """(lo, hi): verified links that connect all fingerprints ``radius`` or fewer bits apart.

    ``fps(fp)`` are distinct longs; only their last ``bits`` may differ, so the bits before
    can number several independent fingerprints. Not every pair is listed, but every pair
    within the radius is connected. With ``stars`` 0 a group gives a spanning forest of its
    links; otherwise the members of a variant are linked to one of them, chosen in so many
    ways by turns, and all these links are listed, with ``crowded``: whether a third fingerprint
    has the variant. Groups of variants are split until each is small, however many
    fingerprints crowd around one value.
    """
    if radius % 2:
        raise ValueError("radius must be even: half of it is the reach of the variants")
    half = radius // 2
    fixed = BITS - bits
    own = F.shiftrightunsigned("fp", bits) if fixed else F.lit(0).cast("long")
    rows = fps.select(F.lit(fixed).alias("depth"), own.alias("prefix"), "fp", F.lit(half).alias("left"))
    largest = rows.groupBy("prefix").count().agg(F.max("count")).first()[0] or 0
    more = max(3, (2 * largest * _variant_count(bits, half) // GROUP_VARIANTS).bit_length())
    rows = _deal(rows, fixed, more, half)
    depth = fixed + more
    settled = []
    while True:
        free = BITS - depth
        weight = F.element_at(F.array(*(F.lit(_variant_count(free, left)) for left in range(half + 1))), F.col("left") + 1)
        heavy = written(
            rows.groupBy("prefix").agg(F.sum(weight).alias("variants")).where(F.col("variants") > GROUP_VARIANTS).select("prefix"),
            "heavy",
        )
        if heavy.isEmpty() or not free:
            settled.append(rows)
            break
        settled.append(rows.join(heavy, "prefix", "left_anti").select("depth", "prefix", "fp", "left"))
        more = min(SPLIT_BITS, free)
        rows = written(_deal(rows.join(heavy, "prefix", "left_semi"), depth, more, half), "dealt")
        depth += more
    schema = "lo long, hi long, crowded boolean" if stars else "lo long, hi long"
    found = [part.groupBy("depth", "prefix").applyInPandas(_collisions(radius, stars), schema) for part in settled]
    edges = found[0]
    for part in found[1:]:
        edges = edges.union(part)
    return edges


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4, seed: int = 42) -> DataFrame:
    """(id, fingerprint, component_id) per row of ``docs``.

    Rows are linked when their fingerprints differ in ``radius`` or fewer bits;
    component_id is the least id reachable. Null and empty texts have fingerprint zero
    and link like any other. Repeated rows come back repeated. A null id is never a
    component id unless the component has no other. Empty tables give empty results;
    other columns are ignored.
    """
    marked = written(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    distinct = written(marked.groupBy("fp").agg(F.min("id").alias("least_id")), "distinct")
    roots = written(components(links(distinct.select("fp"), radius)), "roots")
    placed = written(
        distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root")), "placed"
    )
    least = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = written(placed.select("fp", "root").join(least, "root").select("fp", "component_id"), "named")
    return marked.join(named, "fp").select(
        "id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


#: Fingerprints per text, and bits of each, for finding texts by similarity. At a Jaccard
#: similarity of 0.8 about a quarter of the pairs are 4 or fewer of 40 bits apart; one of 12
#: independent fingerprints then links 97 %, and 99.8 % at 0.85.
TABLES, TABLE_BITS = 12, 40
_MIXERS = np.random.default_rng(5).integers(0, 2**63, TABLES * TABLE_BITS // 60, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def word_shingles(text: str | None, size: int) -> set[bytes]:
    """Word shingles of the lower-cased text; fewer words are one shingle, none give none."""
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {b" ".join(words[at : at + size]) for at in range(max(1, len(words) - size + 1))}


def _tables(text: str | None, size: int, seed: int) -> list[int]:
    """The text's fingerprints over its set of shingles, each numbered in the bits before."""
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(shingle, seed) for shingle in word_shingles(text, size)], dtype=np.uint64)
    if not len(hashes):
        return []
    ones = np.zeros(64 * len(_MIXERS), dtype=np.int64)
    for at in range(0, len(hashes), 16384):
        mixed = hashes[at : at + 16384, None] * _MIXERS
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0x94D049BB133111EB)
        ones += np.unpackbits(mixed.astype(">u8").view(np.uint8).reshape(len(mixed), -1), axis=1).sum(axis=0, dtype=np.int64)
    # The first 60 bits of each mix: the last ones of a product are the weakest.
    major = (2 * ones > len(hashes)).reshape(len(_MIXERS), 64)[:, :60].reshape(TABLES, TABLE_BITS)
    values = major @ (np.int64(1) << np.arange(TABLE_BITS - 1, -1, -1))
    return [(table << TABLE_BITS) | int(value) for table, value in enumerate(values)]


def _compared(pairs: DataFrame, texts: DataFrame, size: int, similarity: float) -> DataFrame:
    """(lo, hi, near, far) per pair (lo, hi) of digests: whether the shingle sets are similar enough, and see ``contested``."""
    least = max(0.0, 1 - HOPS * (1 - similarity)) - 1e-9

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            near, far, last, left = [], [], None, set()
            for a, b in zip(batch.column("lo_text").to_pylist(), batch.column("hi_text").to_pylist(), strict=True):
                if a != last:
                    last, left = a, word_shingles(a, size)
                right = word_shingles(b, size)
                common = len(left & right)
                near.append(common >= similarity * (len(left) + len(right) - common))
                far.append(common < least * (len(left) + len(right) - common))
            arrays = [batch.column("lo"), batch.column("hi"), pa.array(near, pa.bool_()), pa.array(far, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=["lo", "hi", "near", "far"])

    lo = texts.select(F.col("digest").alias("lo"), F.col("text").alias("lo_text"))
    hi = texts.select(F.col("digest").alias("hi"), F.col("text").alias("hi_text"))
    return pairs.join(hi, "hi").join(lo, "lo").select("lo", "hi", "lo_text", "hi_text").mapInArrow(checked, "lo binary, hi binary, near boolean, far boolean")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, radius: int = 4, seed: int = 42) -> DataFrame:
    """``docs`` with all columns, one row of each group of near-duplicates.

    Texts are linked if their sets of ``shingle``-word shingles have a Jaccard similarity
    of ``similarity`` or more; candidates come from colliding variants of several
    fingerprints, and where one fails, from the rare shingles of the texts around it
    (``overlaps``). Of a group, the row with the least id stays (any one of rows that repeat
    it). Null, empty and blank texts are one group; null ids lose to others. Empty tables
    stay empty.
    """

    @F.pandas_udf("array<long>")
    def tables(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: _tables(text, shingle, seed))

    text = F.coalesce(docs[text_col], F.lit(""))
    digest = F.when(text.rlike(r"[^\x20\x09-\x0D]"), F.unhex(F.md5(text))).otherwise(F.unhex(F.md5(F.lit(""))))
    rows = docs.select(docs[id_col].alias("id"), text.alias("text"), digest.alias("digest"))
    marked = written(rows.select("digest", tables("text").alias("fps")), "marked")
    # Equal texts have equal fingerprints: partial aggregation leaves one row of each per task.
    nodes = written(marked.select("digest", F.explode("fps").alias("fp")).distinct(), "nodes")
    distinct = written(nodes.groupBy("fp").agg(F.min("digest").alias("first")), "fingerprints")
    near = written(links(distinct.select("fp"), radius, TABLE_BITS, len(TURNS)).groupBy("lo", "hi").agg(F.max("crowded").alias("crowded")), "near")
    first = distinct.select(F.col("fp").alias("other"), F.col("first").alias("other_first"))
    across = (
        near.join(distinct, near["lo"] == distinct["fp"])
        .select(F.col("first").alias("a"), "hi", "crowded")
        .join(first, F.col("hi") == first["other"])
        .select("a", F.col("other_first").alias("b"), "crowded", F.lit(False).alias("within"))
    )
    within = nodes.join(distinct, "fp").select(F.col("first").alias("a"), F.col("digest").alias("b"), F.lit(False).alias("crowded"), F.lit(True).alias("within"))
    pairs = across.union(within).where("a <> b").groupBy(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
    pairs = written(pairs.agg(F.max("crowded").alias("crowded"), F.max("within").alias("within")), "candidates")
    wanted = written(pairs.select(F.explode(F.array("lo", "hi")).alias("digest")).distinct(), "wanted")
    texts = written(matching(rows.select("digest", "text"), wanted, "digest").dropDuplicates(["digest"]), "texts")
    # A spanning forest first; then only what would still join two groups needs a look.
    tested = written(_compared(pairs.select("lo", "hi").mapInPandas(_spanning, "lo binary, hi binary"), texts, shingle, similarity), "tested")
    found = tested.where("near").select("lo", "hi")
    roots = written(components(found), "roots")
    lo_root = roots.select(F.col("node").alias("lo"), F.col("root").alias("lo_root"))
    hi_root = roots.select(F.col("node").alias("hi"), F.col("root").alias("hi_root"))
    apart = pairs.join(lo_root, "lo", "left").join(hi_root, "hi", "left").where(F.coalesce("lo_root", "lo") != F.coalesce("hi_root", "hi"))
    late = written(_compared(apart.select("lo", "hi").join(tested, ["lo", "hi"], "left_anti"), texts, shingle, similarity), "late")
    tested = tested.union(late)
    if not late.where("near").isEmpty():
        found = tested.where("near").select("lo", "hi")
        roots = written(components(found), "roots")
    # Members of a variant or a fingerprint that were tested against its head only.
    failed = tested.where("not near").select("lo", "hi", "far").join(pairs, ["lo", "hi"])
    rest = written(contested(failed, roots).join(texts.select(F.col("digest").alias("node"), "text"), "node"), "rest")
    if not rest.isEmpty():
        untested = close(rest, lambda text: word_shingles(text, shingle), similarity).join(pairs, ["lo", "hi"], "left_anti")
        beside = written(_compared(untested, texts, shingle, similarity).where("near").select("lo", "hi"), "beside")
        if not beside.isEmpty():
            roots = written(components(found.union(beside)), "roots")

    grouped = rows.select("id", "digest").groupBy("digest", "id").agg(F.count("*").alias("copies"))
    grouped = written(grouped.join(roots, grouped["digest"] == roots["node"], "left").select("id", "digest", "copies", F.coalesce("root", "digest").alias("root")), "grouped")
    rank = F.struct(F.col("id").isNull().alias("nameless"), "id", "digest", "copies")
    kept = written(grouped.groupBy("root").agg(F.min(rank).alias("kept")).select("root", "kept.id", F.col("kept.digest").alias("kept_digest"), "kept.copies"), "kept")
    marks = docs.withColumn("__digest", digest)
    chosen = marks.join(
        kept.select(F.col("id").alias("__id"), F.col("kept_digest").alias("__kept"), F.col("copies").alias("__copies")),
        marks["__digest"].eqNullSafe(F.col("__kept")) & marks[id_col].eqNullSafe(F.col("__id")),
    )
    once = chosen.where("__copies = 1")
    again = chosen.where("__copies > 1").dropDuplicates(["__digest"])
    return once.union(again).select(*(F.col(f"`{name}`") for name in docs.columns))


def _spanning(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield pd.DataFrame(list(forest(zip(frame["lo"], frame["hi"], strict=True))), columns=["lo", "hi"])
