"""Filter interaction audit: what every filter removes at every place of every order.

Each filter leaves a relation of the ids that fail it. Left-semi and left-anti joins with these
relations split the rows into classes that fail the same filters; the same joins, on classes
instead of ids, give for each prefix of each order what a step removes and what earlier steps
took from it. So ids are shuffled once per filter, not once per prefix.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillcast.llm.common import SPACES, narrowed, split_words
from quillcast.session import written

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SIGNS = r"[#$%&*|]"


def document_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """Rows to audit, written: ``row, id, part, digest, rows, good, toxic`` and A to D, true where the filter fails.

    Rows alike in id, part and text are one row that counts ``rows`` times. An id is good (toxic)
    if any of its labels says so.
    """
    said = narrowed(labels, id="doc_id", quality="quality", toxic="toxic").where("id is not null").groupBy("id")
    lost = said.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    texts = narrowed(docs, id=id_col, part=part_col, text=text_col)
    texts = texts.select("id", F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    words = texts.withColumn("words", split_words(F.col("text"), SPACES))
    size = F.size("words")
    capitals = F.length("text") - F.length(F.translate("text", CAPITALS, ""))
    measured = words.select(
        "id",
        "part",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        (size < 100).alias("A"),
        (100 * F.size(F.array_distinct("words")) < 80 * size).alias("B"),
        (100 * capitals > 10 * F.length("text")).alias("C"),
        F.col("text").rlike(SIGNS).alias("D"),
    )
    alike = measured.groupBy(*measured.columns).agg(F.count("*").alias("rows"))
    told = alike.join(lost.hint("merge"), "id", "left").withColumns({name: F.coalesce(name, F.lit(False)) for name in ("good", "toxic")})
    # The number is given while the table is written and is fixed from then on.
    return written(told.withColumn("row", F.monotonically_increasing_id()), "audited")


def failing_ids(rows: DataFrame) -> dict[str, DataFrame]:
    """One written table of ``row`` per filter: A to D by their columns, E for texts that a smaller id has, too.

    Rows without id are no copies of others, nor others of theirs.
    """
    found = {name: rows.where(name).select("row") for name in "ABCD"}
    first = rows.groupBy("digest").agg(F.min("id").alias("id"))
    found["E"] = rows.where("id is not null").join(first.hint("merge"), ["digest", "id"], "left_anti").select("row")
    return {name: written(ids, f"fails-{name}") for name, ids in found.items()}


def classes(rows: DataFrame, failing: Mapping[str, DataFrame]) -> DataFrame:
    """``part, fails, rows, good, toxic``: counts of the rows that fail the same filters, named in ``fails``.

    Every relation splits the rows into those in it and those outside. At most 2^filters
    classes a part come out, summed before the shuffle.
    """
    split = rows.select("row", "part", "rows", "good", "toxic", F.lit("").alias("fails"))
    for name, ids in failing.items():
        # Files of ascending numbers are far smaller than the numbers: not to be broadcast for their size.
        ids = ids.hint("merge")
        inside = split.join(ids, "row", "left_semi").withColumn("fails", F.concat("fails", F.lit(name)))
        split = written(inside.unionByName(split.join(ids, "row", "left_anti")), f"split-{name}")
    count = {name: F.sum(F.when(F.col(name), F.col("rows")).otherwise(0)).alias(name) for name in ("good", "toxic")}
    return written(split.groupBy("part", "fails").agg(F.sum("rows").alias("rows"), *count.values()), "classes")


def steps_of(spark: SparkSession, filters: str) -> tuple[DataFrame, DataFrame]:
    """Steps ``filter_order, step, filter`` of all orders, and ``earlier``: (filter_order, step, filter) before each step."""
    orders = ["".join(order) for order in permutations(filters)]
    steps = [(order, at + 1, name) for order in orders for at, name in enumerate(order)]
    earlier = [(order, step, name) for order, step, _ in steps for name in order[: step - 1]]
    schema = "filter_order string, step int, filter string"
    return spark.createDataFrame(steps, schema), spark.createDataFrame(earlier, schema)


def audit(rows: DataFrame, failing: Mapping[str, DataFrame]) -> DataFrame:
    """One row per part, order of the filters and step; see :func:`audit_documents` for the columns.

    ``failing`` has a relation of ``row`` per filter, named by one letter; all its orders are
    audited, so keep to a handful of filters.
    """
    spark, filters = rows.sparkSession, "".join(failing)
    counted = classes(rows, failing)
    steps, earlier = steps_of(spark, filters)
    kinds = counted.select("fails").distinct()
    fails = kinds.select("fails", F.explode(F.split("fails", "")).alias("filter")).where("filter <> ''")
    key = ["filter_order", "step", "fails"]
    here = steps.join(fails, "filter")
    gone = earlier.join(fails, "filter").select(*key)
    removed = here.join(gone, key, "left_anti").withColumn("taken", F.lit(True))
    redundant = here.join(gone, key, "left_semi").withColumn("taken", F.lit(False))
    # A row per order, class and filter that it fails: filters! * filters * 2^(filters - 1) at most, 9,600 for five.
    pairs = F.broadcast(removed.unionByName(redundant))
    each = counted.join(pairs, "fails")

    def total(of: str, taken: bool):
        return F.sum(F.when(F.col("taken") == taken, F.col(of)).otherwise(0))

    sums = each.groupBy("part", "filter_order", "step").agg(
        total("rows", True).alias("removed"),
        total("rows", False).alias("redundant"),
        F.sum(F.when(F.col("fails") == F.col("filter"), F.col("rows")).otherwise(0)).alias("unique_fails"),
        total("good", True).alias("good_lost"),
        total("toxic", True).alias("toxic_lost"),
    )
    # Every part has every step, those that remove nothing included.
    orders = F.explode(F.split(F.lit(" ".join(map("".join, permutations(filters)))), " ")).alias("filter_order")
    parts = counted.groupBy("part").agg(F.sum("rows").alias("total")).select("part", "total", orders)
    grid = parts.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))).alias("step"))
    grid = grid.withColumn("filter", F.substring("filter_order", F.col("step"), F.lit(1)))
    names = ("removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    full = grid.join(sums, ["part", "filter_order", "step"], "left").withColumns({name: F.coalesce(name, F.lit(0)) for name in names})
    so_far = Window.partitionBy("part", "filter_order").orderBy("step")
    return full.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.sum("removed").over(so_far)).alias("kept"),
        *names,
        F.sum("removed").over(Window.partitionBy("part", "filter")).alias("shapley"),
    )


def audit_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """The five document filters in all 120 orders, by part.

    ``kept`` rows are left after the step, ``removed`` by it; ``redundant`` ones fail its filter but
    went earlier, ``unique_fails`` fail no other; ``good_lost`` and ``toxic_lost`` are labelled so
    among the removed; ``shapley`` sums the filter's removals over all orders.

    Null texts are empty texts, a null part is the empty string. Repeated rows count each; rows
    of one id count each, and the least id of a text keeps all its rows. Rows without id have no
    label and never fail E. No documents give no rows; without labels nothing good or toxic
    is lost. Other columns are ignored.
    """
    rows = document_rows(docs, labels, id_col, text_col, part_col)
    return audit(rows, failing_ids(rows))
