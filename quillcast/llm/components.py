"""Connected components of a distributed edge list."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillcast.llm.common import KEYS, gathered
from quillcast.session import written


def _root(parent: dict, node: object) -> object:
    while (above := parent.setdefault(node, node)) != node:
        parent[node] = parent[above]
        node = above
    return node


def forest(pairs: Iterator[tuple[object, object]], parent: dict | None = None) -> Iterator[tuple[object, object]]:
    """The pairs that join two trees: at most one less than there are nodes. ``parent`` keeps the trees."""
    parent = {} if parent is None else parent
    for a, b in pairs:
        a_root, b_root = _root(parent, a), _root(parent, b)
        if a_root != b_root:
            parent[max(a_root, b_root)] = min(a_root, b_root)
            yield a, b


def _thinned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per batch a star around each component's least node, so no long path is left in it; memory is bounded by the batch."""
    for frame in frames:
        parent: dict = {}
        for _ in forest(zip(frame["lo"], frame["hi"], strict=True), parent):
            pass
        stars = [(least, node) for node in list(parent) if (least := _root(parent, node)) != node]
        yield pd.DataFrame(stars, columns=["lo", "hi"])


def _least(pairs: DataFrame, of: str, value: str, most: int) -> DataFrame:
    """The least value per node, as files: joins with it can then be split at hot nodes."""
    return written(gathered(pairs.groupBy(F.col(of).alias("node")).agg(F.min(value).alias("least")), most, KEYS), "least")


def _settled(edges: DataFrame, most: int) -> bool:
    """Whether all edges are stars around their least node: every other node has one edge."""
    ends = F.array(F.struct(F.col("lo").alias("node"), F.lit(0).alias("up")), F.struct(F.col("hi").alias("node"), F.lit(1).alias("up")))
    nodes = edges.select(F.explode(ends).alias("end")).groupBy("end.node").agg(F.sum("end.up").alias("ups"), F.count("*").alias("n"))
    return gathered(nodes.where((F.col("ups") >= 1) & (F.col("n") > 1)), most, KEYS).isEmpty()


def components(edges: DataFrame, most: int | None = None) -> DataFrame:
    """(node, root) for every node of ``edges(lo, hi)``; root is the component's least node.

    Distributed union-find: batches are first thinned to stars, then large-star and
    small-star steps alternate until only stars are left, a number of rounds that grows with
    the logarithm of the longest path. No step makes more edges than there were, so ``most``, or
    else their number after the first, says how many tasks a step takes at most. A node keeps one edge per round towards its least
    neighbour, so hubs are never gathered; joins on hubs are plain equi-joins over files,
    which adaptive execution splits. Each round is written to the shared folder.
    Nulls and self-loops are no edges; repeated edges count once; no edges, no rows.
    """
    kind = edges.schema["lo"].dataType.simpleString()
    schema = f"lo {kind}, hi {kind}"
    edges = edges.select(F.least("lo", "hi").alias("lo"), F.greatest("lo", "hi").alias("hi")).where("lo < hi")
    if most is None:
        edges = written(edges.mapInPandas(_thinned, schema).distinct(), "edges")
    else:
        edges = written(gathered(gathered(edges, most, KEYS).mapInPandas(_thinned, schema).distinct(), most, KEYS), "edges")
    most = edges.count()
    while not _settled(edges, most):
        both = edges.select(F.col("lo").alias("node"), F.col("hi").alias("other")).union(
            edges.select(F.col("hi").alias("node"), F.col("lo").alias("other"))
        )
        large = (
            both.join(_least(both, "node", "other", 2 * most), "node")
            .where("other > node")
            .select(F.least("least", "node").alias("lo"), F.col("other").alias("hi"))
        )
        large = written(gathered(large.distinct(), most, KEYS), "large-star")
        small = large.join(_least(large, "hi", "lo", most), large["hi"] == F.col("node")).select(
            F.explode(
                F.array(
                    F.struct(F.col("least").alias("lo"), F.col("hi")),
                    F.struct(F.col("least").alias("lo"), F.col("lo").alias("hi")),
                )
            ).alias("edge")
        )
        edges = written(gathered(small.select("edge.*").where("lo < hi").distinct(), most, KEYS), "small-star")
    found = edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return gathered(found.union(edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()), 2 * most, KEYS)
