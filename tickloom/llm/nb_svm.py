"""A quality classifier: n-gram indicators scaled by naive Bayes log-count ratios, under a linear hinge-loss model.

The model is fitted by one task on a bounded sample of labelled rows, in the dual, a coordinate at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import remainder, stage, unstage
from tickloom.llm.features import char_grams, one_text_each, platt, sigmoid, word_hashes
from tickloom.llm.tokens import in_slices, plain_texts, word_bytes, words_of

#: Orders of byte n-grams, bits of the hashed space of bytes and of words (one word and two words), and the longest
#: run of one word that has a bucket of its own: which word it is says less than that it is the same.
CHARS, CHAR_BITS, WORD_BITS, LONGEST_RUN = (1, 2, 3), 16, 16, 5
RUNS = (1 << CHAR_BITS) + (1 << WORD_BITS)
DIM = RUNS + LONGEST_RUN - 1
Rows = tuple[np.ndarray, np.ndarray]


def indicators(texts: pa.Array) -> Rows:
    """(indptr, index): the distinct n-grams of each text, bytes first, then words."""
    texts = plain_texts(texts)
    offsets, raw = word_bytes(texts)
    data = np.frombuffer(raw, dtype=np.uint8) if len(raw) else np.zeros(0, dtype=np.uint8)
    words, counts = words_of(texts)
    ones, ends = word_hashes(words, WORD_BITS), np.concatenate([[0], np.cumsum(counts)])
    twos = (ones[:-1] * 40503 + ones[1:] + 12345) & ((1 << WORD_BITS) - 1)
    # each n-gram's last place in its text: the one that a second look finds again
    place, indptr, index = np.zeros(DIM, dtype=np.int64), [0], []
    for i in range(len(texts)):
        own = ones[ends[i] : ends[i + 1]]
        same, runs = own[1:] == own[:-1], []
        for n in range(LONGEST_RUN - 1):
            if not same.any():
                break
            runs.append(RUNS + n)
            same = same[1:] & same[:-1]
        grams = np.concatenate([char_grams(data[offsets[i] : offsets[i + 1]], CHARS, CHAR_BITS).astype(np.int64), (1 << CHAR_BITS) + own, (1 << CHAR_BITS) + twos[ends[i] : max(ends[i], ends[i + 1] - 1)], np.array(runs, dtype=np.int64)])
        at = np.arange(len(grams))
        place[grams] = at
        index.append(grams[place[grams] == at].astype(np.int32))
        indptr.append(indptr[-1] + len(index[-1]))
    return np.array(indptr, dtype=np.int64), np.concatenate(index) if index else np.zeros(0, dtype=np.int32)


def log_count_ratios(x: Rows, positive: np.ndarray, dim: int, smoothing: float = 1.0) -> np.ndarray:
    """For each n-gram the log of its share among the positive rows' n-grams over that among the others'."""
    indptr, index = x
    row = np.repeat(positive, np.diff(indptr))
    p = np.bincount(index[row], minlength=dim) + smoothing
    q = np.bincount(index[~row], minlength=dim) + smoothing
    return np.log((p / p.sum()) / (q / q.sum()))


def dual_descent(x: tuple[np.ndarray, np.ndarray, np.ndarray], sign: np.ndarray, dim: int, cost: np.ndarray, rounds: int = 60, tolerance: float = 1e-3, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(weights with the intercept last, dual variables) of min |w|^2 / 2 + sum cost * hinge.

    Each step solves one row's dual variable exactly, inside 0 and its cost; the intercept is a feature of value 1.
    Rows are taken in a new random order each round, until no step moved a gradient by more than tolerance.
    """
    indptr, index, value = x
    n, rng = len(sign), np.random.default_rng(seed)
    alpha, w = np.zeros(n), np.zeros(dim + 1)
    square = np.array([value[a:b] @ value[a:b] for a, b in zip(indptr[:-1], indptr[1:])]) + 1.0
    for _ in range(rounds):
        worst = 0.0
        for i in rng.permutation(n):
            a, b = indptr[i], indptr[i + 1]
            at, val = index[a:b], value[a:b]
            slope = sign[i] * (val @ w[at] + w[dim]) - 1.0
            if (alpha[i] <= 0 and slope >= 0) or (alpha[i] >= cost[i] and slope <= 0):
                continue
            worst = max(worst, abs(slope))
            after = min(max(alpha[i] - slope / square[i], 0.0), cost[i])
            step = (after - alpha[i]) * sign[i]
            w[at] += step * val
            w[dim] += step
            alpha[i] = after
        if worst < tolerance:
            break
    return w, alpha


class Model:
    """Ratios, weights on scaled indicators, and the calibration of their margins."""

    def __init__(self, ratio: np.ndarray, weights: np.ndarray, scale: tuple[float, float]):
        self.scale, self.intercept = scale, weights[-1]
        self.gain, self.square = ratio * weights[:-1], ratio * ratio

    def margin(self, x: Rows) -> np.ndarray:
        indptr, index = x
        gain, square = (np.concatenate([[0.0], np.cumsum(part[index])]) for part in (self.gain, self.square))
        norm = np.sqrt(np.maximum(square[indptr[1:]] - square[indptr[:-1]], 0.0))
        total = gain[indptr[1:]] - gain[indptr[:-1]]
        return np.divide(total, norm, out=np.zeros_like(total), where=norm > 1e-9) + self.intercept

    def chance(self, x: Rows) -> np.ndarray:
        a, b = self.scale
        return sigmoid(a * self.margin(x) + b)


def scaled(x: Rows, ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indicators times ratios, each row of length one."""
    indptr, index = x
    value = ratio[index]
    sums = np.concatenate([[0.0], np.cumsum(value * value)])
    norm = np.sqrt(np.maximum(sums[indptr[1:]] - sums[indptr[:-1]], 1e-18))
    return indptr, index, value / np.repeat(norm, np.diff(indptr))


def chosen(x: Rows, rows: np.ndarray) -> Rows:
    parts = [x[1][x[0][i] : x[0][i + 1]] for i in rows]
    return np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64), np.concatenate(parts) if parts else x[1][:0]


def weights_of(x: Rows, positive: np.ndarray, cost: float = 10.0, interpolation: float = 0.25) -> tuple[np.ndarray, np.ndarray]:
    """(ratios, weights): hinge-loss weights, drawn towards their mean size by interpolation as the naive Bayes prior."""
    ratio = log_count_ratios(x, positive, DIM)
    share = positive.mean()
    each = np.where(positive, 0.5 / share, 0.5 / (1 - share)) * cost
    w, _ = dual_descent(scaled(x, ratio), np.where(positive, 1.0, -1.0), DIM, each)
    used = w[:-1] != 0
    mean = np.abs(w[:-1][used]).mean() if used.any() else 0.0
    return ratio, np.append((1 - interpolation) * mean * used + interpolation * w[:-1], interpolation * w[-1])


def fitted(x: Rows, positive: np.ndarray, odds: float) -> Model:
    """A model of four fifths of the rows, calibrated on the other fifth; odds: how many times oftener positive rows
    are among all rows, against others, than in the sample. A fifth of under 20 rows calibrates nothing."""
    everyone = np.arange(len(positive))
    held, rest = everyone[everyone % 5 == 4], everyone[everyone % 5 != 4]
    if len(held) < 20 or not 0 < positive[rest].sum() < len(rest):
        return Model(*weights_of(x, positive), (1.0, math.log(odds)))
    model = Model(*weights_of(chosen(x, rest), positive[rest]), (1.0, 0.0))
    a, b = platt(model.margin(chosen(x, held)), positive[held].astype(float))
    model.scale = (a, b + math.log(odds))
    return model


def _fit(table: pa.Table, odds: float) -> pa.Table:
    # rows of both classes lie mixed, whatever their ids: the fifths of the calibration are alike
    table = table.combine_chunks().sort_by([("_order", "ascending"), ("_id", "ascending")])
    lists = table["grams"].combine_chunks()
    x = (np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())]), lists.flatten().to_numpy())
    model = fitted(x, table["_y"].to_numpy() > 0, odds)
    return pa.table({name: pa.array([v], pa.list_(pa.float64())) for name, v in (("gain", model.gain), ("square", model.square), ("rest", np.array([model.intercept, *model.scale])))})


def learn(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, per_class: int, seed: int = 29) -> Model | None:
    """A model from about per_class labelled rows of each class; None if a class is missing."""
    known = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("double").alias("_y")).where("_id is not null and _y is not null").where(remainder("_id", 4) != 2)
    known = known.groupBy("_id").agg((F.avg("_y") >= 0.5).cast("int").alias("_y"))
    found = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    if len(found) < 2:
        return None
    drawn = F.lit(False)
    for y, n in found.items():
        drawn |= (F.col("_y") == y) & ((F.lit(n) <= per_class) | (F.pmod(F.xxhash64("_id", F.lit(seed)), F.lit(1_000_003)) < math.floor(per_class / n * 1_000_003)))
    # at most about 2 * per_class ids, so broadcasting them is safe whatever the size of labels
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(known.where(drawn)), "_id")
    order = F.xxhash64("_id", F.lit(seed + 1)).alias("_order")
    sample = one_text_each(rows, "_id", "_text", "_y").select("_id", "_y", order, "_text")
    schema = sample.select("_id", "_y", "_order", F.array().cast("array<int>").alias("grams")).schema

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 256):
            indptr, index = indicators(batch.column(3))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.ListArray.from_arrays(pa.array(indptr, pa.int32()), pa.array(index, pa.int32()))], names=["_id", "_y", "_order", "grams"])

    made = stage(sample.mapInArrow(grams, schema), "grams")
    drawn_n = {r["_y"]: r["n"] for r in made.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    if len(drawn_n) < 2:
        return None
    odds = (found[1] / drawn_n[1]) / (found[0] / drawn_n[0])
    got = made.groupBy().applyInArrow(lambda t: _fit(t, odds), "gain array<double>, square array<double>, rest array<double>").first()
    unstage(made)
    model = Model.__new__(Model)
    model.gain, model.square = np.array(got["gain"]), np.array(got["square"])
    model.intercept, model.scale = got["rest"][0], (got["rest"][1], got["rest"][2])
    return model


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", per_class: int = 3000, least: float = 0.7) -> DataFrame:
    """id, held_out, score (0 to 1, higher: label 1 likelier) and predicted (score at least least) for every row.

    Learned from at most about per_class rows of each class whose crc32(id) mod 4 is not 2; a null id is neither held
    out nor learned from. Labels of one id are averaged, null labels and ids ignored; of an id that several rows
    have, one text is learned from. Whole texts are read, of any length; null and empty texts have no n-gram and get
    the intercept's score; equal texts get equal scores. Without labels of both classes every score is 0.5. An empty
    table has no rows; other columns are ignored.
    """
    model = learn(docs, labels, doc_id, text, label, per_class)
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    schema = rows.select("_id", F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 256):
            chance = model.chance(indicators(batch.column(1))) if model else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(chance, pa.float64())], names=["_id", "score"])

    out = rows.mapInArrow(run, schema)
    held_out = F.coalesce(remainder("_id", 4) == 2, F.lit(False)).alias("held_out")
    return out.select(F.col("_id").alias(doc_id), held_out, "score", (F.col("score") >= least).cast("int").alias("predicted"))
