"""Quality rules: counts of each text, and a calibrated hashed n-gram logistic regression."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.features import Sparse, dot, feature_rows, fit_linear, gathered, one_text_each, platt, rows_of, sampled, sigmoid, text_features
from tickloom.llm.tokens import in_slices, words_of

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
HOW = {"char_orders": (1, 2, 3), "char_bits": 12, "word_bits": 13}
DIM = (1 << 12) + (1 << 13)


def repeated_words(codes: np.ndarray, window: int = 3) -> int:
    """Words that lie in a window of words found twice or more."""
    n = len(codes) - window + 1
    if n < 2:
        return 0
    _, small = np.unique(codes, return_inverse=True)
    key = small[:n].astype(np.int64)
    for i in range(1, window):
        # words are renumbered after each step, so that keys stay small in a text of any length
        _, key = np.unique(key * (small.max() + 1) + small[i : n + i], return_inverse=True)
    twice = np.bincount(key)[key] > 1
    covered = np.zeros(len(codes) + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + window, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if "\n" not in text:
        return 0
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return len(lines) - len(set(lines))


def counts_of(texts: pa.Array) -> dict[str, np.ndarray]:
    """The base counts of some texts."""
    words, counts = words_of(texts, lower=False)
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False) if len(words) else np.zeros(0, dtype=np.int32)
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64) if len(words) else np.zeros(0, dtype=np.int64)
    ends, sums = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(lengths)])
    plain = [t or "" for t in texts.to_pylist()]
    return {
        "n_words": counts,
        "word_chars": sums[ends[1:]] - sums[ends[:-1]],
        "n_symbols": np.array([sum(map(t.count, SYMBOLS)) for t in plain], dtype=np.int64),
        "n_dup_lines": np.array([repeated_lines(t) for t in plain], dtype=np.int64),
        "n_repeat_words": np.array([repeated_words(codes[a:b]) for a, b in zip(ends[:-1], ends[1:])], dtype=np.int64),
    }


class Model:
    """Logistic regression, calibrated on a fifth of the sample that it was not fitted on."""

    def __init__(self, x: Sparse, y: np.ndarray, l2: float = 1e-6):
        everyone = np.arange(len(y))
        held = everyone[everyone % 5 == 4]
        fitted = everyone[everyone % 5 != 4]
        self.weights = fit_linear(rows_of(x, fitted), y[fitted], DIM, "logistic", l2, 200)
        self.scale = platt(self.margin(rows_of(x, held)), y[held]) if len(held) >= 20 else (1.0, 0.0)

    def margin(self, x: Sparse) -> np.ndarray:
        return dot(x, self.weights[:-1]) + self.weights[-1]

    def chance(self, x: Sparse) -> np.ndarray:
        a, b = self.scale
        return sigmoid(a * self.margin(x) + b)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, per_class: int) -> Model | None:
    """A model from about per_class rows of each class; None if a class is missing."""
    known = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("double").alias("_y")).where("_id is not null and _y is not null")
    known = sampled(known.groupBy("_id").agg((F.avg("_y") >= 0.5).cast("int").alias("_y")), "_y", "_id", per_class)
    # at most about 2 * per_class ids, so broadcasting them is safe whatever the size of labels
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(known), "_id")
    others, x = gathered(feature_rows(one_text_each(rows, "_id", "_text", "_y").select("_id", "_y", "_text"), "_text", **HOW))
    y = np.array(others["_y"], dtype=float)
    return Model(x, y) if len(set(others["_y"])) == 2 else None


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", per_class: int = 2500, least: float = 0.5, least_words: int = 50, most_repeated: int = 50) -> DataFrame:
    """id, the base counts, base_failed, quality (0 to 1) and kept for every row.

    kept: not base_failed, and quality at least the fixed threshold. Null texts count as empty and fail.
    Without labels of both classes every text has quality 1. Labels of one id are averaged; null labels
    and ids are ignored; of an id that several rows have, one text is learned from. Equal texts are judged alike,
    every row by itself, whatever its id; texts of any length are read whole; an empty table has no rows.
    """
    model = fit(docs, labels, doc_id, text, label, per_class)
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    schema = rows.select("_id", *[F.lit(0).cast("long").alias(c) for c in names], F.lit(0.0).alias("quality")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 256):
            texts = batch.column(1)
            counts = counts_of(texts)
            chance = model.chance(text_features(texts, **HOW)) if model else np.ones(len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(counts[c], pa.int64()) for c in names], pa.array(chance, pa.float64())], names=["_id", *names, "quality"])

    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    out = rows.mapInArrow(run, schema).withColumn("base_failed", failed)
    return out.select(F.col("_id").alias(doc_id), *names, "base_failed", "quality", (~F.col("base_failed") & (F.col("quality") >= least)).alias("kept"))
