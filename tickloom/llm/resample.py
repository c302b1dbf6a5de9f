"""Importance resampling towards a target: documents whose n-grams look like the target's are drawn more often.

Counts come from an external sort: each document is a stream of 16-bit buckets, one for a feature, and streams are
packed into blocks with the documents' offsets and written. Blocks are read twice: sorted and run-length encoded for
the counts of all documents, then replaced by their buckets' gains and summed between offsets.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.llm.common import free_name, partitions, stage, unstage
from tickloom.llm.tokens import in_slices

#: Letters lower-cased, digits and all bytes beyond ASCII kept, everything else a space.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: Bytes of a text that are split into words at once.
PIECE = 1 << 20
MOST_BUCKETS = 1 << 16


def word_lists(data: bytes, piece: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text, in pieces of about piece bytes that end between words."""
    data = data.translate(_WORDS)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + piece)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def bucket_stream(data: bytes, n_buckets: int, piece: int = PIECE) -> np.ndarray:
    """The bucket of every word and every two neighbouring words, repeats included, as 16-bit numbers.

    The check sum of two words goes on from that of the first.
    """
    out, last = [np.zeros(0, dtype=np.uint32)], []
    for words in word_lists(data, piece):
        ones = list(map(zlib.crc32, words))
        before = [*last, *ones[:-1]]
        twos = list(map(zlib.crc32, (b" " + w for w in words[len(words) - len(before) :]), before))
        out += [np.array(ones, dtype=np.uint32), np.array(twos, dtype=np.uint32)]
        last = ones[-1:] or last
    return (np.concatenate(out) % np.uint32(n_buckets)).astype("<u2")


def streams(docs: DataFrame, doc_id: str, text: str, n_buckets: int, rows: int = 256) -> DataFrame:
    """docs as blocks of at most rows documents: ids, offsets (one more than ids) and the packed stream."""
    if not 0 < n_buckets <= MOST_BUCKETS:
        raise ValueError(f"buckets must fit 16 bits: {n_buckets}")
    picked = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    schema = picked.select(F.array("id").alias("ids"), F.array(F.lit(0).cast("long")).alias("offsets"), F.lit(b"").alias("stream")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, rows):
            parts = [bucket_stream(t or b"", n_buckets) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            ends = np.cumsum([0, *map(len, parts)])
            ids = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(0))
            yield pa.RecordBatch.from_arrays([ids, pa.array([ends], pa.list_(pa.int64())), pa.array([b"".join(p.tobytes() for p in parts)], pa.binary())], names=["ids", "offsets", "stream"])

    return picked.mapInArrow(run, schema)


def run_lengths(stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a stream and how often each occurs: its sorted runs."""
    ordered = np.sort(stream, kind="stable")  # a radix sort for 16 bits
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, dtype=np.int64)
    return ordered[starts], np.diff(np.append(starts, len(ordered)))


def bucket_counts(blocks: DataFrame, n_buckets: int) -> DataFrame:
    """(bucket, n) over all blocks. A task merges its blocks' runs; tasks' runs meet in a shuffle of at most
    n_buckets rows a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, dtype=np.int64)
        for batch in batches:
            for one in batch.column(0):
                value, n = run_lengths(np.frombuffer(one.as_buffer(), dtype="<u2"))
                total[value] += n
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found], pa.int64())], names=["bucket", "n"])

    return blocks.select("stream").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's gain in thousandths, floored: the log of its smoothed share in target over that in source."""
    n = len(source)
    s_all, t_all = float(source.sum() + n), float(target.sum() + n)
    return np.array([math.floor(1000 * math.log(((t + 1.0) * s_all) / ((s + 1.0) * t_all))) for s, t in zip(source.tolist(), target.tolist())], dtype=np.int64)


def mean_gains(stream: np.ndarray, offsets: np.ndarray, gains: np.ndarray) -> np.ndarray:
    """The floored mean gain between neighbouring offsets; 0 where there is no feature."""
    lengths = np.diff(offsets)
    out = np.zeros(len(lengths), dtype=np.int64)
    some = np.flatnonzero(lengths)
    if len(some):
        # starts of documents with features rise strictly, and the last of them ends the stream
        out[some] = np.add.reduceat(gains[stream], offsets[:-1][some]) // lengths[some]
    return out


def noise(doc_id: object, seed: int) -> int:
    """A document's Gumbel noise in thousandths, floored, from a digest of seed and id (a null id: empty)."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def learned_gains(blocks: DataFrame, target: DataFrame, doc_id: str, text: str, n_buckets: int) -> np.ndarray:
    """The gains of all buckets; of either side's counts n_buckets numbers reach the driver."""
    counts = []
    for side in (blocks, streams(target, doc_id, text, n_buckets)):
        found = bucket_counts(side, n_buckets).toArrow()
        total = np.zeros(n_buckets, dtype=np.int64)
        total[found["bucket"].to_numpy()] = found["n"].to_numpy()
        counts.append(total)
    return gains_of(*counts)


def weighed(blocks: DataFrame, gains: np.ndarray, seed: int) -> DataFrame:
    """One row a document: id, n_features, weight, score."""
    schema = blocks.select(F.explode("ids").alias("id")).select("id", *[F.lit(0).cast("long").alias(c) for c in ("n_features", "weight", "score")]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 1):
            ids, offsets = batch.column(0).flatten(), batch.column(1).flatten().to_numpy()
            weight = mean_gains(np.frombuffer(batch.column(2)[0].as_buffer(), dtype="<u2"), offsets, gains)
            score = weight + np.array([noise(i, seed) for i in ids.to_pylist()], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, pa.int64()) for c in (np.diff(offsets), weight, score)]], names=["id", "n_features", "weight", "score"])

    return blocks.mapInArrow(run, schema)


def ranked(rows: DataFrame, eligible: Column, percent: int, order: list[Column]) -> DataFrame:
    """rows with rank: 1, 2, 3... of the eligible ones in order, for the first percent of a hundred of them; else null.

    Rows are range-sorted and written with their place in their partition; the partitions before one are
    counted, not read, so no task holds more than a range.
    """
    spark = rows.sparkSession
    # rows that are equal in the order are told apart by where they were read, so that many of them are many ranges
    marked = rows.withColumn("_in", eligible).withColumn("_at", F.monotonically_increasing_id() % 1009)
    keys = [F.col("_in").desc(), *order, F.col("_at")]
    placed = marked.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys).withColumn("_place", F.monotonically_increasing_id())
    table = stage(placed.drop("_at"), "ranks")
    part = F.shiftright("_place", 33).alias("_part")
    # one row for each partition of the range sort
    sizes = table.groupBy(part).agg(F.count_if("_in").alias("_n"), F.min("_place").alias("_from"))
    before = F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    sizes = sizes.select(F.col("_part").alias("_whose"), (F.coalesce(before, F.lit(0)) - F.col("_from") + 1).alias("_shift"), F.expr(f"sum(_n) over () * {percent} div 100").alias("_most"))
    rank = F.col("_place") + F.col("_shift")
    joined = table.join(F.broadcast(sizes), F.shiftright("_place", 33) == F.col("_whose"))
    return joined.withColumn("rank", F.when(F.col("_in") & (rank <= F.col("_most")), rank)).select(*rows.columns, "rank")


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_id: str = "item_id", target_text: str = "text", percent: int = 25, least_words: int = 20, seed: int = 7, n_buckets: int = 10_000) -> DataFrame:
    """Every row's id, n_features, weight, score and rank: of the rows with at least least_words words, the percent
    with the highest scores are drawn and ranked, ties to the smaller id, null ids last; undrawn ones have rank null.

    Features are all runs of one and two words of whole texts, of any length; a null text has none, and a text without
    features weighs 0. All rows count, repeated ones too: rows equal in id and score rank in any order among themselves.
    Without rows in target the gains are those of the smoothing alone. An empty table has no rows; other columns and
    their names are ignored. The written blocks take about two bytes a feature.
    """
    blocks = stage(streams(docs, doc_id, text, n_buckets), "streams")
    gains = learned_gains(blocks, target, target_id, target_text, n_buckets)
    # n words have 2 n - 1 features
    enough = F.col("n_features") >= max(0, 2 * least_words - 1)
    out = ranked(weighed(blocks, gains, seed), enough, percent, [F.col("score").desc(), F.col("id").asc_nulls_last()])
    unstage(blocks)
    return out.select(F.col("id").alias(doc_id), "n_features", "weight", "score", "rank")


def drawn(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_id: str = "item_id", target_text: str = "text", percent: int = 25, least_words: int = 20, seed: int = 7, n_buckets: int = 10_000) -> DataFrame:
    """The rows of docs that resample draws, with all their columns: one more pass over docs by the same gains, kept
    down to the last row drawn. Rows that are equal to that one in id and score are all kept."""
    blocks = stage(streams(docs, doc_id, text, n_buckets), "streams")
    gains = learned_gains(blocks, target, target_id, target_text, n_buckets)
    enough = F.col("n_features") >= max(0, 2 * least_words - 1)
    ranks = ranked(weighed(blocks, gains, seed), enough, percent, [F.col("score").desc(), F.col("id").asc_nulls_last()])
    cut = ranks.agg(F.max_by(F.struct("score", "id"), "rank").alias("cut")).first()["cut"]
    unstage(blocks)
    if cut is None:
        return docs.where(F.lit(False))
    n_features, score = free_name(docs, "n_features"), free_name(docs, "score")
    schema = docs.select("*", F.lit(0).cast("long").alias(n_features), F.lit(0).cast("long").alias(score)).schema
    id_at, text_at = docs.columns.index(doc_id), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 256):
            parts = [bucket_stream(t or b"", n_buckets) for t in batch.column(text_at).cast(pa.binary()).to_pylist()]
            n = np.array([len(p) for p in parts], dtype=np.int64)
            weight = mean_gains(np.concatenate(parts), np.concatenate([[0], np.cumsum(n)]), gains)
            total = weight + np.array([noise(i, seed) for i in batch.column(id_at).to_pylist()], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64()), pa.array(total, pa.int64())], names=[*batch.schema.names, n_features, score])

    whose = F.lit(True) if cut["id"] is None else F.coalesce(F.col(doc_id) <= F.lit(cut["id"]), F.lit(False))
    kept = (F.col(n_features) >= max(0, 2 * least_words - 1)) & ((F.col(score) > cut["score"]) | ((F.col(score) == cut["score"]) & whose))
    return docs.mapInArrow(run, schema).where(kept).select(*docs.columns)
