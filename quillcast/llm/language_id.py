"""Language identification by a convolutional network over bytes.

A text's UTF-8 bytes are cut into overlapping windows of one length. Filters of several widths slide
over the embedded bytes of a window, the largest answer of each filter counts (max pooling), and a softmax
layer turns the answers into chances. A text's chances are the geometric mean over all its windows.

The network is trained in numpy on windows of a bounded sample. To apply it, embedding and
filters are folded into one table per place in a filter, from a byte to all answers, so a
window costs look-ups and additions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillcast.llm.common import narrowed

#: Labelled rows that a fit uses at most, the first by hash of their id and text.
LABELLED = 3_000
#: Windows per labelled row, evenly spaced over the whole text.
SAMPLED = 2
#: Bytes of a window. Neighbours share what the widest filter needs, so that it sees every run of bytes.
WINDOW = 256
WIDTHS = (2, 3, 4, 5)
FILTERS = 12
EMBEDDING = 8
EPOCHS = 8
BATCH = 64
RATE = 0.004
#: Windows that are worked on at a time: under 1 MB, which stays in the cache.
AT_ONCE = 64

#: Prediction for texts without any letter.
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


def windows(text: str) -> np.ndarray:
    """All windows of a text, a row each; the last is filled up with zero bytes."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    step = WINDOW - max(WIDTHS) + 1
    count = max(1, -(-(len(data) - WINDOW) // step) + 1)
    filled = np.zeros((count - 1) * step + WINDOW, np.uint8)
    filled[: len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(filled, WINDOW)[::step]


@dataclass
class ByteNetwork:
    """Embedding, filters by width, and the softmax layer; ``languages`` in the order of its answers."""

    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    filter_bias: list[np.ndarray]
    weights: np.ndarray
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.filter_bias, self.weights, self.bias]

    def tables(self) -> list[np.ndarray]:
        """Per width and place a table from a byte to the answers of all filters."""
        return [
            np.stack([self.embedding @ kernel[at] for at in range(width)]).astype(np.float32)
            for width, kernel in zip(WIDTHS, self.filters, strict=True)
        ]

    def answers(self, rows: np.ndarray, tables: list[np.ndarray]) -> Iterator[np.ndarray]:
        """Per width the answers of its filters, bias left out: window, place, filter."""
        for width, table in zip(WIDTHS, tables, strict=True):
            length = rows.shape[1] - width + 1
            found = table[0].take(rows[:, :length], axis=0)
            for at in range(1, width):
                found += table[at].take(rows[:, at : at + length], axis=0)
            yield found

    def pooled(self, rows: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """The largest answer of each filter in each window, none below 0."""
        best = [found.max(axis=1) + bias for found, bias in zip(self.answers(rows, tables), self.filter_bias, strict=True)]
        return np.maximum(np.concatenate(best, axis=1), 0)

    def log_chances(self, rows: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """Logarithms of the chances of each language, per window."""
        return log_softmax(self.pooled(rows, tables) @ self.weights + self.bias)


def log_softmax(scores: np.ndarray) -> np.ndarray:
    scores = scores - scores.max(axis=1, keepdims=True)
    return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


def start_network(languages: list[str], rng: np.random.Generator) -> ByteNetwork:
    total = FILTERS * len(WIDTHS)
    return ByteNetwork(
        languages,
        rng.normal(0, 0.5, (256, EMBEDDING)),
        [rng.normal(0, 1 / np.sqrt(width * EMBEDDING), (width, EMBEDDING, FILTERS)) for width in WIDTHS],
        [np.zeros(FILTERS) for _ in WIDTHS],
        rng.normal(0, 1 / np.sqrt(total), (total, len(languages))),
        np.zeros(len(languages)),
    )


def gradients(net: ByteNetwork, rows: np.ndarray, truth: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross-entropy, in the order of :meth:`ByteNetwork.parameters`.

    Behind max pooling only the place of each filter's largest answer has a gradient.
    """
    best, places = [], []
    for found, bias in zip(net.answers(rows, net.tables()), net.filter_bias, strict=True):
        places.append(found.argmax(axis=1))
        best.append(np.take_along_axis(found, places[-1][:, None, :], 1)[:, 0, :] + bias)
    answers = np.maximum(np.concatenate(best, axis=1), 0)
    error = np.exp(log_softmax(answers @ net.weights + net.bias))
    error[np.arange(len(rows)), truth] -= 1
    error /= len(rows)
    below = (error @ net.weights.T) * (answers > 0)
    embedding, filters, biases = np.zeros_like(net.embedding), [], []
    for group, (width, kernel, place) in enumerate(zip(WIDTHS, net.filters, places, strict=True)):
        part = below[:, group * FILTERS : (group + 1) * FILTERS]
        found = np.zeros_like(kernel)
        for at in range(width):
            letters = np.take_along_axis(rows, place + at, 1)
            found[at] = np.einsum("nfe,nf->ef", net.embedding[letters], part)
            np.add.at(embedding, letters, part[:, :, None] * kernel[at].T[None])
        filters.append(found)
        biases.append(part.sum(axis=0))
    return [embedding, *filters, *biases, answers.T @ error, error.sum(axis=0)]


def fit(rows: np.ndarray, labels: np.ndarray, seed: int = 7) -> ByteNetwork:
    """Adam over shuffled batches. Languages are taken equally often, however rare they are."""
    languages, truth = np.unique(labels.astype(str), return_inverse=True)
    rng = np.random.default_rng(seed)
    net = start_network([str(language) for language in languages], rng)
    if len(languages) < 2:
        return net
    counts = np.bincount(truth)
    chance = (1 / counts)[truth] / len(counts)
    first, second = ([np.zeros_like(p) for p in net.parameters()] for _ in range(2))
    steps = EPOCHS * max(1, len(rows) // BATCH)
    for step in range(1, steps + 1):
        drawn = rng.choice(len(rows), min(BATCH, len(rows)), p=chance)
        rate = RATE * (1 - (step - 1) / steps)
        for p, g, m, v in zip(net.parameters(), gradients(net, rows[drawn], truth[drawn]), first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def _sampled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = []
        for text, lang in zip(batch["text"], batch["lang"], strict=True):
            cut = windows(text)
            for at in sorted({len(cut) * part // SAMPLED for part in range(SAMPLED)}):
                found.append((cut[at].tobytes(), lang))
        yield pd.DataFrame(found, columns=["bytes", "lang"])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most: int = LABELLED, held_out: int = 0, folds: int = 5) -> ByteNetwork | None:
    """Fit on at most ``most`` labelled rows outside the held-out fold; None without any.

    The fold of a row is crc32 of its id as text modulo ``folds``; rows without id, language or a letter
    are passed over. ``SAMPLED`` windows of fixed length a row are all that reaches the driver.
    """
    known = narrowed(docs, id=id_col, text=text_col, lang=lang_col).dropna()
    known = known.where((F.crc32(F.col("id").cast("string")) % folds != held_out) & F.col("text").rlike(r"\p{L}"))
    known = known.withColumn("lang", F.col("lang").cast("string")).withColumn("order", F.xxhash64("id", "text"))
    key = ["order", "id", "lang"]
    picked = known.select(*key).distinct().orderBy(*key).limit(most)
    rows = known.join(F.broadcast(picked), key).dropDuplicates(key).select("text", "lang")
    found = rows.mapInPandas(_sampled, "bytes binary, lang string").toPandas()
    if not len(found):
        return None
    # The same windows in the same order, however Spark dealt them out.
    found = found.sort_values(["lang", "bytes"])
    cut = np.frombuffer(b"".join(found["bytes"]), np.uint8).reshape(len(found), WINDOW)
    return fit(cut, found["lang"].to_numpy())


def predict(texts: list[str | None], net: ByteNetwork | None) -> list[tuple[str, float]]:
    """Language and its chance per text; texts without letter are unknown, for certain."""
    found: list[tuple[str, float]] = [(UNKNOWN, 1.0)] * len(texts)
    if net is None:
        return found
    tables, size = net.tables(), len(net.languages)
    sums, counts = np.zeros((len(texts), size)), np.zeros(len(texts))
    held, owner, kept = [], [], 0

    def work() -> None:
        rows = np.concatenate(held)
        np.add.at(sums, np.concatenate(owner), net.log_chances(rows, tables))

    for at, text in enumerate(texts):
        if text is None or not LETTER.search(text):
            continue
        cut = windows(text)
        counts[at] = len(cut)
        for begin in range(0, len(cut), AT_ONCE):
            part = cut[begin : begin + AT_ONCE]
            held.append(part)
            owner.append(np.full(len(part), at))
            kept += len(part)
            if kept >= AT_ONCE:
                work()
                held, owner, kept = [], [], 0
    if held:
        work()
    told = np.flatnonzero(counts)
    if len(told):
        chances = np.exp(log_softmax(sums[told] / counts[told, None]))
        for at, row in zip(told, chances, strict=True):
            found[at] = (net.languages[int(row.argmax())], float(row.max()))
    return found


def _predict_udf(net: ByteNetwork | None):
    @F.pandas_udf("lang_pred string, score double")
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(predict(texts.tolist(), net), columns=["lang_pred", "score"])

    return of


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", held_out: int = 0, folds: int = 5) -> DataFrame:
    """(id, held_out, lang_pred, score) per row of ``docs``, from whole texts.

    ``lang_pred`` is a learned language, or ``und`` with score 1 if the text is null or has no letter, or if no
    row is labelled. Repeated rows come back repeated; rows with a null id are not held out and teach nothing. Equal
    chances go to the language that sorts first. Empty tables give no rows; other columns are ignored.
    """
    net = train(docs, id_col, text_col, lang_col, held_out=held_out, folds=folds)
    rows = narrowed(docs, id=id_col, text=text_col)
    fold = F.crc32(F.col("id").cast("string")) % folds
    told = rows.select("id", F.coalesce(fold == held_out, F.lit(False)).alias("held_out"), _predict_udf(net)("text").alias("told"))
    return told.select("id", "held_out", "told.lang_pred", "told.score")
