from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, id string, digest string, words int, fp long, line int, key long"
LONG = " ".join(f"word{at % 977}x{at}" for at in range(60_000))


def rows(*pairs):
    """Documents with columns whose names clash with the operators' own."""
    return [(doc_id, text, None, "x", None, 1, None, 2, 3) for doc_id, text in pairs]


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls, empty and very long texts, ties, repeated rows and repeated ids."""
    sentence = "The quick brown fox jumps over the lazy dog near the quiet river bank at dawn.\n"
    return spark.createDataFrame(
        rows(
            (1, sentence * 3), (1, sentence * 3), (2, sentence * 3), (3, None), (3, ""), (4, " \t\n "), (5, LONG), (6, LONG + " end"),
            (7, "one"), (None, sentence), (None, None), (8, "Ünïcödé ÄÖ  words\r\nand\x0btabs"), (8, "another text under the same id"),
        ),
        DOCS,
    ).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


class Groups:
    """Union-find for brute-force answers."""

    def __init__(self):
        self.parent = {}

    def root(self, node):
        while self.parent.setdefault(node, node) != node:
            node = self.parent[node]
        return node

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


@pytest.fixture
def groups():
    return Groups()
