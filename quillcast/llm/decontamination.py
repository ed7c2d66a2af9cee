"""Benchmark decontamination: prefix-filtered set join on rare shingles, DataFrame operations only.

A window of an item occurs in a document only if the window's rarest shingle does, so
that one shingle is the whole prefix that exact containment needs. Its places in the
documents are the candidates; the offset inside the window bounds where the window may
lie, and the words there are compared one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillcast.llm.common import counted, narrowed, sent_if_few, split_words
from quillcast.session import written

#: ASCII other than digits and lower-case letters; everything beyond ASCII belongs to words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    return split_words(F.translate(text, CAPITALS, CAPITALS.lower()), SEPARATORS)


def windows_of(items: DataFrame, item_col: str, text_col: str, size: int) -> DataFrame:
    """(item, words): each item's windows of ``size`` words, or all its fewer words, once each."""
    rows = narrowed(items, item=item_col, text=text_col).select("item", words_of(F.col("text")).alias("words"))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (size - 1)))
    return (
        rows.where(F.size("words") > 0)
        .select("item", F.explode(F.transform(starts, lambda at: F.slice("words", at, size))).alias("words"))
        .distinct()
    )


def _shingle(words: Column, at: Column, size: Column) -> Column:
    """A shingle's hash. Words are compared in the end, so collisions cost time only."""
    return F.xxhash64(F.slice(words, at, size))


def _occurrences(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """(…, words, at, shingle): every shingle of the given sizes with its place, from 1."""
    placed = docs.select("*", F.posexplode("words").alias("pos", "word"))
    shingles = [
        F.when(F.size("words") - F.col("pos") >= size, _shingle(F.col("words"), F.col("pos") + 1, F.lit(size)))
        for size in sizes
    ]
    if len(shingles) == 1:
        return placed.withColumn("at", F.col("pos") + 1).withColumn("shingle", shingles[0])
    return placed.withColumn("at", F.col("pos") + 1).withColumn("shingle", F.explode(F.array(*shingles)))


def occurrences(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, window: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """Where windows occur: (doc, digest, start, length, window), and which items have a window.

    Both are written to the shared folder. The small sides of the joins are read back from
    there, so Spark knows their true size: it broadcasts small ones and otherwise shuffles,
    filtering the documents' side by a Bloom filter at run time where that pays.
    """
    pairs = written(
        windows_of(items, item_col, item_text_col, window).select(
            "item", "words", F.sha2(F.concat_ws(" ", "words"), 256).alias("window")
        ),
        "windows",
    )
    distinct = pairs.select("window", "words").distinct().withColumn("size", F.least(F.lit(shingle), F.size("words")))
    offsets = F.sequence(F.lit(0), F.size("words") - F.col("size"))
    inside = written(
        distinct.select("window", "words", "size", F.explode(offsets).alias("offset")).withColumn(
            "shingle", _shingle(F.col("words"), F.col("offset") + 1, F.col("size"))
        ),
        "window-shingles",
    )
    # At most ``shingle`` values.
    sizes = sorted(row[0] for row in inside.select("size").distinct().collect())
    texts = narrowed(docs, doc=id_col, text=text_col).select(
        "doc", F.xxhash64("text").alias("digest"), words_of(F.col("text")).alias("words")
    )
    if not sizes:
        return written(
            pairs.select(F.lit(None).cast(docs.schema[id_col].dataType).alias("doc"), F.lit(0).cast("long").alias("digest"),
                         F.lit(0).alias("start"), F.lit(0).alias("length"), "window").where("false"), "no-hits"), pairs
    known = written(inside.select("shingle").distinct(), "shingles")
    rarity = counted(_occurrences(texts, sizes).select("shingle"), known, "shingle")
    ranked = inside.join(rarity, "shingle", "left").groupBy("window").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "offset")).alias("rarest"), F.first("words").alias("window_words")
    )
    # A shingle that no document holds leaves no place for its window.
    prefixes = written(
        ranked.where("rarest.n > 0").select("window", "window_words", "rarest.shingle", "rarest.offset"), "prefixes"
    )
    # The documents meet hashes only. An inner join with distinct keys, as Spark would move a
    # semi-join below the hashing, where a row still holds all words of its document.
    wanted = sent_if_few(written(prefixes.select("shingle").distinct(), "prefix-shingles"))
    places = written(_occurrences(texts, sizes).select("doc", "digest", "at", "shingle").join(wanted, "shingle"), "places")
    # A document's places, once each: no more than its words. Its text is fetched once, for all of them.
    per_doc = places.groupBy("doc", "digest").agg(F.collect_set(F.struct("at", "shingle")).alias("places"))
    placed = written(per_doc.select(F.col("doc").alias("hit_doc"), F.col("digest").alias("hit_digest"), "places"), "placed")
    rows = narrowed(docs, doc=id_col, text=text_col).withColumn("digest", F.xxhash64("text"))
    same = rows["doc"].eqNullSafe(placed["hit_doc"]) & (rows["digest"] == placed["hit_digest"])
    rows = rows.join(sent_if_few(placed.select("hit_doc", "hit_digest")), same, "left_semi")
    first = F.greatest(F.lit(1), F.col("at") - (window - 1))
    candidates = (
        rows.join(placed, same)
        .select("doc", "digest", words_of(F.col("text")).alias("words"), "places")
        .select("doc", "digest", "words", F.inline("places"))
        .select("doc", "digest", "shingle", "at", first.alias("first"), F.slice("words", first, F.col("at") + window - first).alias("around"))
    )
    start = F.col("at") - F.col("offset")
    length = F.size("window_words")
    hits = (
        candidates.join(prefixes, "shingle")
        .where((start >= F.col("first")) & (start + length <= F.col("first") + F.size("around")))
        .where(F.slice("around", F.greatest(F.lit(1), start - F.col("first") + 1), length) == F.col("window_words"))
        .select("doc", "digest", start.alias("start"), length.alias("length"), "window")
    )
    return written(hits, "hits"), pairs


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 10, shingle: int = 3) -> DataFrame:
    """The rows of ``docs``, all columns, in which no window of an item occurs.

    Rows that share an id, a null one included, are told apart by their texts.
    """
    items = items.where(items[item_col].isNotNull())
    hits, _ = occurrences(docs, items, id_col, text_col, item_col, item_text_col, window, shingle)
    hit = written(hits.select(F.col("doc").alias("hit_doc"), F.col("digest").alias("hit_digest")).distinct(), "hit-documents")
    same = docs[id_col].eqNullSafe(hit["hit_doc"]) & (F.xxhash64(docs[text_col]) == hit["hit_digest"])
    return docs.join(sent_if_few(hit), same, "left_anti")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 10, shingle: int = 3) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated) per row of ``docs``.

    A document word is hit if it lies in an occurrence of a window of ``window``
    consecutive item words (or of a shorter item's words). ``items_sha256`` digests the
    sorted, comma-joined ids of items with an occurring window; none: of the empty text.
    Null and empty texts have no words; items without words and null item ids take no
    part. Repeated rows come back repeated, each with the same figures. Rows that share
    an id but not the text are told apart by the text. Empty tables are fine; other
    columns are ignored. Shingles are counted over all documents.
    """
    items = items.where(items[item_col].isNotNull())
    hits, pairs = occurrences(docs, items, id_col, text_col, item_col, item_text_col, window, shingle)
    # Places of one document, at most one per word: the words under their union.
    spans = F.array_sort(F.collect_set(F.struct("start", "length")))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(1).alias("next")),
        lambda acc, span: F.struct(
            (acc["n"] + F.greatest(F.lit(0), span["start"] + span["length"] - F.greatest(span["start"], acc["next"]))).alias("n"),
            F.greatest(acc["next"], span["start"] + span["length"]).alias("next"),
        ),
        lambda acc: acc["n"],
    )
    counted = hits.groupBy("doc", "digest").agg(spans.alias("spans")).select("doc", "digest", covered.alias("n_hit"))
    named = hits.select("doc", "digest", "window").distinct().join(pairs.select("window", "item"), "window")
    per_doc = (
        named.select("doc", "digest", F.col("item").cast("string").alias("item")).distinct()
        .groupBy("doc", "digest").agg(F.sort_array(F.collect_list("item")).alias("found"))
    )
    found = written(
        counted.alias("c").join(per_doc.alias("p"), F.col("c.doc").eqNullSafe(F.col("p.doc")) & (F.col("c.digest") == F.col("p.digest"))).select(
            F.col("c.doc").alias("hit_doc"), F.col("c.digest").alias("hit_digest"), "n_hit",
            F.size("found").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "found"), 256).alias("items_sha256"),
        ),
        "found",
    )
    rows = narrowed(docs, id=id_col, text=text_col).select(
        "id", F.xxhash64("text").alias("digest"), F.size(words_of(F.col("text"))).cast("long").alias("n_words")
    )
    joined = rows.join(found, F.col("id").eqNullSafe(F.col("hit_doc")) & (F.col("digest") == F.col("hit_digest")), "left")
    return joined.select(
        "id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )
