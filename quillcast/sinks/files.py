"""Raw dumps, result files and result documents."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from quillcast.functions.scalars import one_line, quoted_text
from quillcast.operators import series
from quillcast.operators.counts import NO_LANG
from quillcast.session import file_names, read_text, remove_folder, write_text, written
from quillcast.sources.dumps import AS_IS, NO_NAME, NO_REPOST, RESULTS, flatten_documents


def dump_rows(facts: DataFrame, kind: str) -> DataFrame:
    """The rows of a raw dump; all posts, sentinels in place of NULL."""
    created_ms = F.unix_millis("ts").alias("created_ms")
    rt_id = F.coalesce("rt_id", F.lit(NO_REPOST[kind])).alias("rt_id")
    if kind == "total":
        return facts.select("id", created_ms, rt_id)
    if kind == "lang":
        lang = _unbroken(F.coalesce("lang", F.lit(NO_LANG))).alias("lang")
        return facts.select("id", lang, created_ms, rt_id)
    return facts.select(
        "id",
        created_ms,
        rt_id,
        F.coalesce(F.unix_millis("rt_ts"), F.lit(0)).alias("rt_created_ms"),
        _unbroken(quoted_text(F.coalesce("rt_screen_name", F.lit(NO_NAME)))).alias("rt_screen_name"),
    )


def _unbroken(text: Column) -> Column:
    """Line breaks as backslash and letter: a dump has one line per post."""
    return F.replace(F.replace(text, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def write_dump(facts: DataFrame, kind: str, path: str, mode: str = "overwrite") -> None:
    """Write a raw dump: headerless lines, fields as they are, no further quoting."""
    _lines(dump_rows(facts, kind)).write.mode(mode).text(path)


def _lines(rows: DataFrame) -> DataFrame:
    return rows.select(F.concat_ws(",", *[_printed(F.col(f"`{f.name}`"), f.dataType) for f in rows.schema]))


def _printed(value: Column, kind: DataType) -> Column:
    """A value as text. The elements of a list are fields of their own, none if it is empty."""
    if isinstance(kind, ArrayType):
        texts = F.transform(value, lambda item: F.coalesce(item.cast("string"), F.lit("null")))
        # concat_ws skips NULL, so an empty list leaves no comma behind.
        joined = F.when(F.size(texts) > 0, F.array_join(texts, ","))
        return F.when(value.isNull(), "null").otherwise(joined)
    return F.coalesce(value.cast("string"), F.lit("null"))


def write_flattened(docs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write documents as lines: nested objects and lists spread one level, no header, no quoting."""
    _lines(flatten_documents(docs)).write.mode(mode).text(path)


def result_rows(result: DataFrame, kind: str) -> DataFrame:
    """A result in the column order of its file, window starts as epoch milliseconds."""
    columns = StructType.fromDDL(RESULTS[kind]).fieldNames()
    return result.select(
        *[
            F.unix_millis("window_start").alias(c) if c == "window_start" else F.col(c)
            for c in columns
        ]
    )


def write_results(result: DataFrame, kind: str, path: str, mode: str = "overwrite") -> None:
    """Write a result file: CSV without header, one line per row whatever the texts hold."""
    rows = result_rows(result, kind)
    texts = [f.name for f in rows.schema if f.dataType.typeName() == "string"]
    lines = rows.withColumns({name: one_line(F.col(name)) for name in texts})
    lines.write.mode(mode).options(escape='"', **AS_IS).csv(path)


def _text(value: Column) -> Column:
    return value.cast("string")


def documents(result: DataFrame, kind: str) -> DataFrame:
    """A result as search documents, one column per document field."""
    watermark = F.unix_millis("window_start")
    fields = {
        "total": lambda: {"watermark": watermark, "cnt": F.col("cnt")},
        "top": lambda: {
            "tId": _text(F.col("rt_id")),
            "screenname": F.col("screen_name"),
            "tweet": F.col("text"),
            "watermark": _text(watermark),
            "cnt": _text(F.col("cnt")),
        },
        "geo": lambda: {
            "langcode": F.col("lang"),
            "location": F.struct("lat", "lon"),
            "watermark": watermark,
            "cnt": F.col("cnt"),
        },
        "percentage": lambda: {
            "langcode": F.col("lang"),
            "watermark": watermark,
            "percentage": F.col("pct"),
            "cnt": F.col("cnt"),
        },
        "share": lambda: {
            "langcode": F.col("lang"),
            "watermark": watermark,
            "rt_total": F.col("rt_total"),
            "tw_total": F.col("tw_total"),
            "percentage": F.col("share"),
        },
        "prediction": lambda: {
            "prediction_type": F.col("prediction_type"),
            "watermark": watermark,
            "cnt": F.col("cnt"),
            "prediction": F.col("prediction"),
            "deviation": F.col("deviation"),
        },
    }[kind]()
    return result.select(*[value.alias(name) for name, value in fields.items()])


# Field names and types of the documents above.
DOCUMENTS = {
    "total": "watermark bigint, cnt bigint",
    "top": "tId string, screenname string, tweet string, watermark string, cnt string",
    "geo": "langcode string, location struct<lat double, lon double>, watermark bigint, cnt bigint",
    "percentage": "langcode string, watermark bigint, percentage double, cnt bigint",
    "share": "langcode string, watermark bigint, rt_total bigint, tw_total bigint, percentage double",
    "prediction": "prediction_type string, watermark bigint, cnt bigint, prediction double, deviation double",
}


_MAPPING = "_mapping.json"


def prepare_target(spark: SparkSession, kind: str, path: str, replace: bool = False) -> None:
    """Make a folder ready for documents of a kind; ``replace`` removes what it holds.

    The types of the fields are stored with the folder. Documents of other fields or types are
    refused before any is written.
    """
    if replace:
        remove_folder(spark, path)
    mapping = StructType.fromDDL(DOCUMENTS[kind]).json()
    if _MAPPING in file_names(spark, path):
        stored = StructType.fromJson(json.loads(read_text(spark, f"{path}/{_MAPPING}")))
        if stored.json() != mapping:
            raise ValueError(f"{path} holds documents of {stored.simpleString()}, not of kind {kind}")
    else:
        write_text(spark, f"{path}/{_MAPPING}", mapping)


def write_documents(result: DataFrame, kind: str, path: str, replace: bool = False) -> None:
    """Write result documents as JSON lines.

    The folder is created when absent; ``replace`` empties it first, otherwise the
    documents are added, if they are of the kind that is there already.
    """
    found = documents(result, kind)
    if replace:
        # The result may be read from the documents that are replaced.
        found = written(found, "documents")
    prepare_target(result.sparkSession, kind, path, replace)
    found.write.mode("append").json(path)


def write_index_dump(docs: DataFrame, path: str, per_file: str) -> None:
    """Write documents as index dumps: one JSON array of ``{_source: …}`` per value of ``per_file``.

    ``per_file`` has to split the documents into files of moderate size (a day's
    results, say), as each array is one row.
    """
    fields = [c for c in docs.columns if c != per_file]
    source = F.to_json(F.struct(F.struct(*fields).alias("_source")))
    (
        docs.groupBy(per_file)
        .agg(F.concat(F.lit("["), F.array_join(F.collect_list(source), ","), F.lit("]")).alias("hits"))
        .write.partitionBy(per_file)
        .mode("overwrite")
        .text(path)
    )


Write = Callable[[DataFrame, str], None]


def dump_writer(kind: str) -> Write:
    return lambda facts, path: write_dump(facts, kind, path)


def result_writer(kind: str) -> Write:
    return lambda result, path: write_results(result, kind, path)


def prediction_writer(prediction_type: str) -> Write:
    return lambda result, path: write_results(
        series.only(result, prediction_type), "prediction", path
    )


def show(frame: DataFrame, path: str) -> None:
    """Print a micro-batch's rows."""
    print(path)
    frame.show(truncate=False)


def document_writer(kind: str) -> Write:
    """For a folder of its own per micro-batch, so that a repeated batch replaces itself.

    :func:`prepare_target` belongs before the stream, for the folder of all batches.
    """
    return lambda result, path: documents(result, kind).write.mode("overwrite").json(path)
