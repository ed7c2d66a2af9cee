"""From raw documents to packed training pieces, stage by stage.

A stage takes (spark, docs, sf_dir), works on all documents that its predecessor kept and
returns a DataFrame; all but the last return the columns of documents. As a stage's result is
written before the next one starts, a stage begins by removing what the one before left in
the scratch folder, unless its documents are still read from there.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillcast.llm import decontamination, line_dedup, packing, quality_classifier, simhash
from quillcast.llm.common import table
from quillcast.session import remove_folder, taken_since, written

_left: list[str] = []


def _clear(spark: SparkSession, docs: DataFrame) -> None:
    """Remove what earlier stages left, unless ``docs`` are read from it."""
    read = "\n".join(docs.inputFiles()) if _left else ""
    if not any(path.rpartition("/")[2] in read for path in _left):
        while _left:
            remove_folder(spark, _left.pop())


def stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """``work`` as a stage that others follow."""

    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _clear(spark, docs)
        with taken_since() as folders:
            found = work(spark, docs, sf_dir)
        _left.extend(folders)
        return found

    return run_stage


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise classifier does not reject."""
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality_classifier.scored(docs, model) >= quality_classifier.CUT)


@stage
def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without lines that repeat one of an earlier place, fuzzily."""
    return _measured(line_dedup.deduplicated(docs))


@stage
def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs)


@stage
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in training sequences of 2,048 tokens."""
    import public_tokenizers

    _clear(spark, docs)
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


def _measured(docs: DataFrame) -> DataFrame:
    """With ``n_chars`` of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("line dedup", line_deduplication),
    ("simhash near-dedup", near_deduplication),
    ("benchmark decontamination", decontaminated),
    ("best-fit packing", packed),
]

#: Scores, near-duplicates and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stage's result written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES[:-1]:
        docs = written(work(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
