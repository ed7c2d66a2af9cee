"""Readers for raw dumps, earlier result files and search-index dumps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillcast.functions.scalars import from_one_line
from quillcast.operators.counts import NO_LANG
from quillcast.session import scratch_dir

# Column order of the headerless dumps and result files, and the
# values that stand for "not a repost" and, next to NO_LANG, for "no user".
DUMPS = {
    "total": "id bigint, created_ms bigint, rt_id bigint",
    "lang": "id bigint, lang string, created_ms bigint, rt_id bigint",
    "top": "id bigint, created_ms bigint, rt_id bigint, rt_created_ms bigint, rt_screen_name string",
}
NO_REPOST = {"total": -1, "lang": -1, "top": 0}
NO_NAME = "-"
RESULTS = {
    "total": "window_start bigint, cnt bigint",
    "top": "rt_id bigint, screen_name string, text string, window_start bigint, cnt bigint",
    "geo": "lang string, lat double, lon double, window_start bigint, cnt bigint",
    "percentage": "lang string, window_start bigint, pct double, cnt bigint",
    "share": "lang string, window_start bigint, rt_total bigint, tw_total bigint, share double",
    "prediction": "window_start bigint, cnt bigint, prediction double, deviation double",
}

# Result files: blanks at the ends of texts belong to them.
AS_IS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _dump_fields(kind: str) -> list[Column]:
    """The fields of a line; a text takes all that the numbers around it leave, commas included."""
    line = F.col("value")
    if kind == "lang":
        head, tail = F.substring_index(line, ",", 1), F.substring_index(line, ",", -2)
        between = F.length(line) - F.length(head) - F.length(tail) - 2
        lang = F.when(between >= 0, F.substring(line, F.length(head) + 2, between))
        return [head, lang, F.substring_index(tail, ",", 1), F.substring_index(tail, ",", -1)]
    fields = F.split(line, ",", {"total": -1, "top": 5}[kind])
    names = StructType.fromDDL(DUMPS[kind]).fieldNames()
    return [F.when(F.size(fields) == len(names), F.get(fields, at)) for at in range(len(names))]


def _parsed_dump(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """Lines of a dump with their typed fields; a broken line lacks some."""
    schema = StructType.fromDDL(DUMPS[kind])
    fields = zip(schema, _dump_fields(kind), strict=True)
    return spark.read.text(path).select(
        *[value.try_cast(field.dataType).alias(field.name) for field, value in fields]
    )


def _whole(kind: str) -> Column:
    fields = StructType.fromDDL(DUMPS[kind]).fieldNames()
    return reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in fields])


def read_dump(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """A raw dump; short, long and ill-typed lines (a truncated tail) are left out.

    Texts may hold commas and quotes: each dump has one at most, told from the numbers
    around it. :func:`broken_lines` counts what is left out.
    """
    return _parsed_dump(spark, kind, path).filter(_whole(kind))


def broken_lines(spark: SparkSession, kind: str, path: str) -> int:
    """How many lines of a dump :func:`read_dump` leaves out."""
    return _parsed_dump(spark, kind, path).filter(~_whole(kind)).count()


def dump_facts(dump: DataFrame, kind: str) -> DataFrame:
    """Post facts of a raw dump, sentinels turned back into NULL."""
    facts = dump.withColumn("ts", F.timestamp_millis("created_ms")).withColumn(
        "rt_id", F.nullif("rt_id", F.lit(NO_REPOST[kind]))
    )
    if kind == "lang":
        facts = facts.withColumn("lang", F.nullif("lang", F.lit(NO_LANG)))
    if kind == "top":
        facts = facts.withColumn(
            "rt_ts", F.when(F.col("rt_id").isNotNull(), F.timestamp_millis("rt_created_ms"))
        ).drop("rt_created_ms")
    return facts.drop("created_ms")


def read_results(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """An earlier batch result, for the comparisons; texts as they were before writing."""
    texts = [f.name for f in StructType.fromDDL(RESULTS[kind]) if f.dataType.typeName() == "string"]
    return (
        spark.read.schema(RESULTS[kind])
        .options(escape='"', **AS_IS)
        .csv(path)
        .withColumns({name: from_one_line(F.col(name)) for name in texts})
        .withColumn("window_start", F.timestamp_millis("window_start"))
    )


def _count(text: Column, letters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, letters, ""))


def array_elements(spark: SparkSession, path: str) -> DataFrame:
    """The objects in files of JSON arrays, one ``value`` each, however few and long the files and lines are.

    A file is cut at closing braces, and Spark deals it out in splits. Whether a brace ends an element of the
    array depends on all the text before it: whether it lies in a string, and how deeply. A piece of text
    turns "in a string" over or not, and adds to the depth, differently from inside and
    outside a string. So every split sums up its pieces for both beginnings, the sums
    of the splits of a file are chained, and each split then knows how it begins. Only
    elements that reach over a split's end are gathered anew.
    """
    pieces = (
        spark.read.option("lineSep", "}")
        .text(path)
        .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"))
    )
    # Escaped characters change nothing; what remains of quotes opens or ends a string.
    parts = F.split(F.regexp_replace("value", r"\\.", ""), '"')
    depth = F.transform(parts, lambda part: (_count(part, "[{") - _count(part, "]}")).cast("bigint"))

    def total(odd: int) -> Column:
        return F.aggregate(F.filter(depth, lambda _, i: i % 2 == odd), F.lit(0).cast("bigint"), lambda a, b: a + b)

    turned = (F.size(parts) - 1) % 2
    # The brace that was cut off counts where it lies outside strings.
    told = pieces.select(
        "*", turned.alias("turned"),
        (total(0) - F.when(turned == 0, 1).otherwise(0)).alias("outside"),
        (total(1) - F.when(turned == 1, 1).otherwise(0)).alias("inside"),
    )
    until = Window.partitionBy("file", "split").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    # Running sums from the split's beginning, had it begun outside (a) or inside (b) a string.
    flipped = told.withColumn("flips", F.sum("turned").over(until) % 2)
    was = (F.col("flips") + F.col("turned")) % 2  # before the piece
    summed = flipped.withColumns(
        {"a": F.sum(F.when(was == 0, F.col("outside")).otherwise(F.col("inside"))).over(until),
         "b": F.sum(F.when(was == 0, F.col("inside")).otherwise(F.col("outside"))).over(until)}
    ).drop("turned", "outside", "inside")
    ends = summed.groupBy("file", "split").agg(F.max_by(F.struct("flips", "a", "b"), "at").alias("sums"))
    in_file = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    begins = ends.withColumn("string", F.coalesce(F.sum("sums.flips").over(in_file), F.lit(0)) % 2)
    begins = begins.withColumn("added", F.when(F.col("string") == 0, F.col("sums.a")).otherwise(F.col("sums.b")))
    begins = begins.select("file", "split", "string", F.coalesce(F.sum("added").over(in_file), F.lit(0)).alias("depth"))
    known = summed.join(begins, ["file", "split"])
    now = F.col("depth") + F.when(F.col("string") == 0, F.col("a")).otherwise(F.col("b"))
    closes = ((F.col("string") + F.col("flips")) % 2 == 0) & (now == 1)
    before = until.rowsBetween(Window.unboundedPreceding, -1)
    numbered = known.select("file", "split", "at", "value", closes.cast("int").alias("closes")).withColumn(
        "number", F.coalesce(F.sum("closes").over(before), F.lit(0))
    )
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "value"))), lambda piece: piece["value"]), "}")
    found = numbered.groupBy("file", "split", "number").agg(text.alias("value"), F.max("closes").alias("whole"))
    # The first element of a split may have begun before it, the last one goes on behind it.
    inner = found.filter((F.col("number") > 0) & (F.col("whole") == 1))
    closed = found.groupBy("file", "split").agg(F.sum("whole").alias("closed"))
    passed = closed.select("file", "split", F.coalesce(F.sum("closed").over(in_file), F.lit(0)).alias("passed"))
    edges = found.filter((F.col("number") == 0) | (F.col("whole") == 0)).join(passed, ["file", "split"])
    across = edges.groupBy("file", (F.col("passed") + F.col("number")).alias("element")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("split", "number", "value"))), lambda piece: piece["value"]), "}").alias("value"),
        F.max("whole").alias("whole"),
    )
    all_ = inner.select("value").union(across.filter("whole = 1").select("value"))
    # Between elements there are commas and brackets; line breaks can only be blanks.
    bare = F.regexp_replace(F.translate("value", "\r\n", "  "), r"^[\s,\[\]]+", "")
    return all_.select(F.concat(bare, F.lit("}")).alias("value"))


def read_index_dump(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The documents of index dumps: files holding JSON arrays of ``{_source: …}``.

    Give the document schema to spare writing the documents out and an inference pass over them.
    """
    elements = array_elements(spark, path)
    if schema is not None:
        return elements.select(F.from_json("value", f"_source struct<{schema}>")["_source"].alias("d")).select("d.*")
    lines = scratch_dir(spark, "documents")
    elements.write.text(lines)
    return spark.read.json(lines).select("_source.*")


def flattened_lines(elements: DataFrame) -> DataFrame:
    """Documents as comma-separated lines, each by its own keys in its own order: ``line``.

    Nested objects and lists are spread one level. An absent key leaves no field, a null one prints
    ``null``; numbers print without a fraction of zeros, what is nested deeper as JSON.
    """
    texts, kinds = (F.from_json("value", f"_source map<string,{kind}>")["_source"] for kind in ("string", "variant"))
    read = elements.select(F.map_entries(texts).alias("fields"), F.transform_values(kinds, lambda _, v: F.to_json(v)).alias("json"))
    # A list of one array is a fence: the maps above would otherwise be parsed once per use.
    read = read.select(F.inline(F.array(F.struct("fields", "json"))))

    def printed(text: Column, json: Column) -> Column:
        number = F.regexp_replace(json, r"^(-?\d+)\.0+$", "$1")
        return F.when(json.rlike("^-?[0-9]"), number).otherwise(F.coalesce(text, F.lit("null")))

    def nested(text: Column) -> Column:
        members = F.from_json(text, "map<string,string>")
        own = F.transform_values(F.from_json(text, "map<string,variant>"), lambda _, v: F.to_json(v))
        return F.transform(F.map_entries(members), lambda e: printed(e["value"], own[e["key"]]))

    def listed(text: Column) -> Column:
        own = F.transform(F.from_json(text, "array<variant>"), lambda v: F.to_json(v))
        return F.zip_with(F.from_json(text, "array<string>"), own, printed)

    def fields(entry: Column) -> Column:
        text, json = entry["value"], F.col("json")[entry["key"]]
        return (
            F.when(json.startswith("{"), nested(text)).when(json.startswith("["), listed(text)).otherwise(F.array(printed(text, json)))
        )

    return read.select(F.array_join(F.flatten(F.transform("fields", fields)), ",").alias("line"))


def flatten_documents(documents: DataFrame) -> DataFrame:
    """Spread one level of nested objects into columns, document order kept."""
    columns = []
    for field in documents.schema.fields:
        if field.dataType.typeName() == "struct":
            columns += [
                F.col(f"`{field.name}`.`{sub}`").alias(f"{field.name}_{sub}")
                for sub in field.dataType.fieldNames()
            ]
        else:
            columns.append(F.col(f"`{field.name}`"))
    return documents.select(*columns)
