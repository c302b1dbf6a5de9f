"""Hashed n-gram features of texts, and linear models over them.

Features are sparse rows (indptr, index, value), made from whole texts with numpy over an Arrow batch.
Models are fitted on a bounded sample, whose size is a parameter of each operator.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import stage
from tickloom.llm.tokens import in_slices, plain_texts, word_bytes, words_of

#: Odd multipliers of the rolling hashes.
MIX = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)
Sparse = tuple[np.ndarray, np.ndarray, np.ndarray]


def char_grams(data: np.ndarray, orders: tuple[int, ...], bits: int) -> np.ndarray:
    """Hashed byte n-grams of one text."""
    out = []
    wide = data.astype(np.uint32)
    for n in orders:
        if len(wide) >= n:
            h = np.full(len(wide) - n + 1, n, dtype=np.uint32)
            for i in range(n):
                h = (h ^ wide[i : len(wide) - n + 1 + i]) * np.uint32(MIX[i])
                h ^= h >> np.uint32(15)
            out.append(h & np.uint32((1 << bits) - 1))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint32)


def word_hashes(words: pa.Array, bits: int) -> np.ndarray:
    """A hash of each word's bytes, computed for all words at once."""
    offsets, raw = word_bytes(words)
    if not len(words):
        return np.zeros(0, dtype=np.int64)
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]].astype(np.uint64)
    starts = offsets[:-1] - offsets[0]
    place = np.arange(len(data), dtype=np.uint64) - np.repeat(starts, np.diff(offsets)).astype(np.uint64)
    mixed = (data + np.uint64(1)) * ((place * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03)) | np.uint64(1))
    h = np.add.reduceat(mixed, starts)
    h ^= h >> np.uint64(29)
    return ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - bits)).astype(np.int64)


def text_features(texts: pa.Array, char_orders: tuple[int, ...], char_bits: int, word_bits: int = 0, lower: bool = False) -> Sparse:
    """Square roots of hashed n-gram counts, scaled to length 1; characters first, then words."""
    texts = plain_texts(texts)
    seen = pc.utf8_lower(texts) if lower else texts
    offsets, raw = word_bytes(seen)
    data = np.frombuffer(raw, dtype=np.uint8) if len(raw) else np.zeros(0, dtype=np.uint8)
    if lower:  # for languages: everything in ASCII but letters is one mark
        table = np.full(256, 32, dtype=np.uint8)
        table[97:123] = np.arange(97, 123)
        table[128:] = np.arange(128, 256)
        data = table[data]
    base = 1 << char_bits
    if word_bits:
        words, counts = words_of(texts, lower=False)
        hashes, ends = word_hashes(words, word_bits), np.concatenate([[0], np.cumsum(counts)])
    indptr, index, value = [0], [], []
    for i in range(len(texts)):
        found = np.bincount(char_grams(data[offsets[i] : offsets[i + 1]], char_orders, char_bits), minlength=base)
        at = np.flatnonzero(found)
        val = found[at]
        if word_bits:
            more = np.bincount(hashes[ends[i] : ends[i + 1]], minlength=1 << word_bits)
            also = np.flatnonzero(more)
            at, val = np.concatenate([at, base + also]), np.concatenate([val, more[also]])
        val = np.sqrt(val.astype(np.float32))
        norm = np.sqrt((val * val).sum())
        index.append(at.astype(np.int32))
        value.append(val / norm if norm else val)
        indptr.append(indptr[-1] + len(at))
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, dtype=kind)
    return np.array(indptr, dtype=np.int64), join(index, np.int32), join(value, np.float32)


def dot(x: Sparse, w: np.ndarray) -> np.ndarray:
    """Each row's inner product with w."""
    indptr, index, value = x
    sums = np.concatenate([[0.0], np.cumsum(value * w[index], dtype=np.float64)])
    return sums[indptr[1:]] - sums[indptr[:-1]]


def fit_linear(x: Sparse, y: np.ndarray, dim: int, loss: str, l2: float = 1e-4, rounds: int = 120, weight: np.ndarray | None = None) -> np.ndarray:
    """Weights and, last, the intercept, by accelerated gradient steps.

    loss: "logistic" for y in 0..1 (probabilities allowed), "hinge" for the squared hinge of a linear
    support vector machine. Each row counts as its weight; rows of length one bound the curvature.
    """
    indptr, index, value = x
    n = len(y)
    weight = np.full(n, 1.0 / max(n, 1)) if weight is None else weight / weight.sum()
    reach = np.repeat(np.arange(n), np.diff(indptr))
    longest = max(1.0, float(np.max(np.bincount(reach, weights=value.astype(np.float64) ** 2, minlength=n), initial=1.0)))
    step = 1.0 / ((0.25 if loss == "logistic" else 2.0) * (longest + 1.0) + l2)
    w, seen, momentum = np.zeros(dim + 1), np.zeros(dim + 1), 1.0
    sign = 2.0 * y - 1.0
    for _ in range(rounds):
        margin = dot(x, seen[:dim]) + seen[dim]
        if loss == "logistic":
            slope = (1.0 / (1.0 + np.exp(-np.clip(margin, -40, 40))) - y) * weight
        else:
            slope = -2.0 * sign * np.maximum(0.0, 1.0 - sign * margin) * weight
        gradient = np.bincount(index, weights=value * slope[reach], minlength=dim) + l2 * seen[:dim]
        after = seen - step * np.append(gradient, slope.sum())
        grown = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        seen = after + (momentum - 1) / grown * (after - w)
        w, momentum = after, grown
    return w


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, b) such that sigmoid(a * margin + b) is calibrated; smoothed targets, Newton steps."""
    if not len(y):
        return 1.0, 0.0
    positive, negative = y.sum(), len(y) - y.sum()
    target = np.where(y > 0.5, (positive + 1) / (positive + 2), 1 / (negative + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(a * margin + b)
        d, h = p - target, np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([(d * margin).sum() + 1e-3 * (a - 1), d.sum() + 1e-3 * b])
        hessian = np.array([[(h * margin * margin).sum() + 1e-3, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-3]])
        change = np.linalg.solve(hessian, gradient)
        a, b = a - np.clip(change[0], -5, 5), b - np.clip(change[1], -5, 5)
        if np.abs(change).max() < 1e-8:
            break
    return float(a), float(b)


def sampled(rows: DataFrame, label: str, key: str, most: int) -> DataFrame:
    """About most rows of each label, or all if fewer, chosen by a hash of the key: a bounded sample.

    Counts are joined, not collected, however many labels there are. They are a table of their own first: Spark then
    knows their size and, where it is small, sends them to the rows instead of shuffling the rows by label.
    """
    share = F.least(F.lit(1.0), F.lit(float(most)) / F.col("_n"))
    counts = stage(rows.groupBy(F.col(label).alias("_label")).agg(F.count("*").alias("_n")), "counts")
    drawn = F.pmod(F.xxhash64(F.col(key), F.lit(23)), F.lit(1_000_003)) < F.floor(share * 1_000_003)
    return rows.join(counts, F.col(label) == F.col("_label")).where((F.col("_n") <= most) | drawn).select(*rows.columns)


def feature_rows(docs: DataFrame, text: str, **how) -> DataFrame:
    """docs with columns feature_index and feature_value in place of text."""
    rest = [c for c in docs.columns if c != text]
    out = docs.select(*rest, F.array().cast("array<int>").alias("feature_index"), F.array().cast("array<float>").alias("feature_value")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 256):
            indptr, index, value = text_features(batch.column(len(rest)), **how)
            offsets = pa.array(indptr.astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(index, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(value, pa.float32()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], *lists], names=[*rest, "feature_index", "feature_value"])

    return docs.select(*rest, text).mapInArrow(run, out)


def gathered(rows: DataFrame) -> tuple[dict[str, list], Sparse]:
    """A bounded sample's other columns and features, on the driver, in a fixed order."""
    found = rows.toArrow().combine_chunks()
    others = [c for c in found.column_names if not c.startswith("feature_")]
    if found.num_rows:
        found = found.sort_by([(c, "ascending") for c in others])
    return {c: found[c].to_pylist() for c in others}, sparse_of(found["feature_index"].combine_chunks(), found["feature_value"].combine_chunks())


def sparse_of(index: pa.Array, value: pa.Array) -> Sparse:
    lengths = pc.list_value_length(index).to_numpy(zero_copy_only=False).astype(np.int64) if len(index) else np.zeros(0, dtype=np.int64)
    return np.concatenate([[0], np.cumsum(lengths)]), index.flatten().to_numpy(zero_copy_only=False), value.flatten().to_numpy(zero_copy_only=False)


def one_text_each(rows: DataFrame, key: str, text: str, *others: str) -> DataFrame:
    """One row for each key, with its smallest text: an id that documents repeat is one example."""
    return rows.groupBy(key, *others).agg(F.min(text).alias(text))


def rows_of(x: Sparse, chosen: np.ndarray) -> Sparse:
    """The chosen rows (positions)."""
    indptr, index, value = x
    lengths = np.diff(indptr)[chosen]
    at = np.repeat(indptr[:-1][chosen] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum()) if len(chosen) else np.zeros(0, dtype=np.int64)
    return np.concatenate([[0], np.cumsum(lengths)]), index[at], value[at]
