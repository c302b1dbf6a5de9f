"""Best-fit packing of documents into fixed-length training sequences, with conflicts.

Open bins are kept in order of residual space. For a document, the search starts at the successor of its
size, the tightest bin that can hold it, and goes on to the next successor while the bin conflicts with
the document: a bin carries a bitmap of the duplicate clusters it holds, which no second document of a
cluster may enter, and a bitmap of its saturated sources, which hold their share of its capacity and enter no more.
Bins of equal source bitmaps are kept together, so that bins closed to a source are not visited. Without a
compatible bin a new one is opened.

Packing is done in shards of about shard_tokens tokens. A document's shard is a hash of the row, not of
its source or cluster, so a hot source or a huge cluster is spread over all shards. Copies of one row that fill
a good part of a shard by themselves are dealt out by where they lie; they are interchangeable.

pack tells where each piece goes; sequences gives the packed texts themselves.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import WORD, stage
from tickloom.llm.components import connected_components
from tickloom.llm.simhash import fingerprints, links
from tickloom.llm.tokens import in_slices

CAPACITY, SHARD_TOKENS = 8192, 4_000_000
#: Share of a bin at which a source is saturated there.
SOURCE_SHARE = 0.5
#: Characters of a shard's texts.
SHARD_CHARS = 3 * SHARD_TOKENS
WORDS = re.compile(WORD)


class Bins:
    """Open bins of one shard, in order of (residual, number), one list for each bitmap of saturated sources: a search
    leaves out whole lists of bins that a document's source may not enter. Clusters of one row need no bit."""

    def __init__(self, capacity: int, per_source: int | None = None, limits: dict[int, float] | None = None):
        self.capacity, self.per_source, self.limits = capacity, per_source, limits or {}
        self.open: dict[int, list[tuple[int, int]]] = {}
        self.clusters: list[int] = []
        self.sources: list[dict[int, list[int]]] = []
        self.last: tuple = ()
        self.reached = (0, 0)

    def place(self, size: int, source: int, cluster: int | None) -> tuple[int, int]:
        """The bin a document goes to and its offset there."""
        own, bit = 0 if cluster is None else 1 << cluster, 1 << source
        # after an equal document the bins it passed over conflict still, and the bin it entered does now
        start = max((size, -1), self.reached) if own and self.last == (size, source, cluster) else (size, -1)
        best, saturated, where = None, 0, 0
        for mask, bins in self.open.items():
            if mask & bit:
                continue
            at = bisect_left(bins, start)
            while at < len(bins) and (best is None or bins[at] < best):
                if not self.clusters[bins[at][1]] & own:
                    best, saturated, where = bins[at], mask, at
                    break
                at += 1
        if best is None:
            residual, number = self.capacity, len(self.clusters)
            self.clusters.append(0)
            self.sources.append({})
        else:
            residual, number = best
            del self.open[saturated][where]
            if not self.open[saturated]:
                del self.open[saturated]
        self.last, self.reached = (size, source, cluster), (residual, number)
        self.clusters[number] |= own
        held = self.sources[number].setdefault(source, [0, 0])
        held[0] += 1
        held[1] += size
        if (self.per_source is not None and held[0] >= self.per_source) or held[1] >= self.limits.get(source, math.inf):
            saturated |= bit
        if residual > size:
            insort(self.open.setdefault(saturated, []), (residual - size, number))
        return number, self.capacity - residual


def source_limits(sizes: np.ndarray, sources: np.ndarray, capacity: int, source_share: float) -> dict[int, float]:
    """Words from which on a source is saturated in a bin: source_share of its capacity, or twice the source's share of
    all words if that is more; a source that is half of everything has no limit."""
    words = np.bincount(sources, weights=sizes)
    shares = np.maximum(source_share, 2 * words / max(1, words.sum()))
    return {i: float(share * capacity) for i, share in enumerate(shares) if share < 1}


def _place(frame: pd.DataFrame, capacity: int, per_source: int | None, source_share: float) -> pd.DataFrame:
    """A shard's pieces (id, piece, size, source, cluster, h) with the number of their bin and their offset in it."""
    # fixed order: largest first, equal ones of a cluster and source together
    frame = frame.sort_values(["size", "cluster", "source", "id", "piece", "h"], ascending=[False, True, True, True, True, True], na_position="last", kind="stable")
    sources = pd.factorize(frame["source"], use_na_sentinel=False)[0]
    # the most frequent clusters get the lowest bits, so that the bitmaps of most bins are short
    often = frame["cluster"].value_counts()
    bits = {c: i for i, c in enumerate(often.index[often.to_numpy() > 1])}
    bins = Bins(capacity, per_source, source_limits(frame["size"].to_numpy(), sources, capacity, source_share))
    placed = [bins.place(n, s, bits.get(c)) for n, s, c in zip(frame["size"].tolist(), sources.tolist(), frame["cluster"].tolist())]
    return frame.assign(number=np.array([p[0] for p in placed], dtype=np.int64), bin_offset=np.array([p[1] for p in placed], dtype=np.int64))


def _packer(capacity: int, per_source: int | None, source_share: float):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        placed = _place(frame, capacity, per_source, source_share)
        placed["bin_id"] = int(key[0]) * (1 << 32) + placed["number"]
        return placed.assign(id=placed["id"].astype("Int64"))[["id", "piece", "size", "source", "bin_id", "bin_offset"]]

    return run


def _joiner(capacity: int, per_source: int | None, source_share: float, separator: str):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        placed = _place(frame, capacity, per_source, source_share).sort_values(["number", "bin_offset"])
        bins = placed.groupby("number", sort=True)
        return pd.DataFrame({
            "bin_id": [int(key[0]) * (1 << 32) + n for n in bins.groups], "n_words": bins["size"].sum().to_numpy(), "doc_ids": bins["id"].agg(lambda x: [None if pd.isna(i) else int(i) for i in x]).to_numpy(),
            "text": bins["body"].agg(separator.join).to_numpy(),
        })

    return run


def _dealt(rows: DataFrame, shards: int, weight: str, most: float) -> DataFrame:
    """rows (id, h, weight) with a salt that tells their shard apart from other rows': none, but for copies of one
    row that weigh more than most together."""
    hot = stage(rows.groupBy("id", "h").agg(F.count("*").alias("n"), F.sum(weight).alias("w")).where((F.col("n") > 1) & (F.col("w") > most)).select(F.col("id").alias("_i"), F.col("h").alias("_h")), "hot")
    if shards == 1 or hot.isEmpty():
        return rows.withColumn("salt", F.lit(0).cast("long"))
    # numbered in a written table: a task that runs again deals its rows out as before
    rows = stage(rows.withColumn("salt", F.monotonically_increasing_id()), "dealt")
    # at most one such row to most of the whole weight
    on = F.col("id").eqNullSafe(F.col("_i")) & (F.col("h") == F.col("_h"))
    return rows.join(hot.withColumn("_hot", F.lit(True)), on, "left").withColumn("salt", F.when(F.col("_hot"), F.col("salt")).otherwise(0)).drop("_i", "_h", "_hot")


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("id", "h", "piece", "salt"), F.lit(shards)).alias("shard")


def _exact(text: str) -> Column:
    """A hash of the text after lower-casing and collapsing white space."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[\x20\x09-\x0D]+", " "))
    return F.xxhash64(plain)


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", cluster: str | None = None, capacity: int = CAPACITY, per_source: int | None = None, source_share: float = SOURCE_SHARE, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Placements: id, piece, first_word, n_words, source, bin_id, bin_offset; one row per piece of a document row.

    Sizes are words. A longer document is cut into pieces of capacity words, which fill bins of their own,
    and a rest that is packed; no word is dropped. A document without words takes no room but has its row,
    bin_id and bin_offset null. Duplicate clusters are given by a column, or else are the groups of near
    duplicates by SimHash, with all copies of equal words among them; a null cluster conflicts with no other row.
    Repeated rows are copies of a cluster, and equal ones are interchangeable. A source enters a bin until it holds
    source_share of its capacity there (a source with more than half of that among all words: twice its own share;
    see source_limits), and per_source documents if that is given; null is a source. Ties fall by size, cluster, source, id, piece and text, so reruns agree.
    An empty table gives no rows; other columns are ignored.
    """
    prints = docs.select(
        F.col(doc_id).cast("long").alias("id"), F.col(source).cast("string").alias("source"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"),
        (F.lit(None).cast("long") if cluster is None else F.xxhash64(F.struct(F.col(cluster)))).alias("given"), (F.lit(False) if cluster is None else F.col(cluster).isNull()).alias("lone"), F.col(text).alias("text"),
    )
    rows = stage(fingerprints(prints, "text", count="words"), "sizes")
    if cluster is None:
        distinct = rows.select("fp").distinct()
        roots = connected_components(links(distinct)).select(F.col("node").alias("fp"), "root")
        rows = rows.join(roots, "fp", "left").withColumn("cluster", F.coalesce("root", "fp")).drop("root")
    else:
        rows = rows.withColumn("cluster", F.when(F.col("lone"), F.xxhash64(F.lit("lone"), F.monotonically_increasing_id())).otherwise(F.col("given")))
    rows = rows.select("id", "h", "source", "words", "cluster")
    total = rows.agg(F.sum("words")).first()[0] or 0
    shards = max(1, math.ceil(total / shard_tokens))
    parts = _dealt(rows.where("words > 0"), shards, "words", shard_tokens / 4)
    parts = parts.withColumn("piece", F.explode(F.sequence(F.lit(0), F.ceil(F.col("words") / capacity).cast("int") - 1)))
    parts = parts.withColumn("size", F.least(F.lit(capacity), F.col("words") - F.col("piece").cast("long") * capacity).cast("long"))
    placed = parts.select(_shard(shards), "id", "piece", "size", "source", "cluster", "h").groupBy("shard").applyInPandas(
        _packer(capacity, per_source, source_share), "id long, piece int, size long, source string, bin_id long, bin_offset long"
    )
    none = F.lit(None).cast("long")
    empty = rows.where("words = 0").select("id", F.lit(0).alias("piece"), F.lit(0).cast("long").alias("size"), "source", none.alias("bin_id"), none.alias("bin_offset"))
    return placed.union(empty).select(
        F.col("id").alias(doc_id), "piece", (F.col("piece").cast("long") * capacity).alias("first_word"), F.col("size").alias("n_words"), F.col("source").alias(source), "bin_id", "bin_offset"
    )


def cut(text: str, capacity: int) -> list[tuple[int, str]]:
    """Pieces of at most capacity words: how many each has, and its text from its first word to its last."""
    spans = [m.span() for m in WORDS.finditer(text)]
    return [(len(some), text[some[0][0] : some[-1][1]]) for some in (spans[at : at + capacity] for at in range(0, len(spans), capacity))]


def sequences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", capacity: int = CAPACITY, per_source: int | None = None, source_share: float = SOURCE_SHARE, shard_chars: int = SHARD_CHARS, separator: str = "\n\n") -> DataFrame:
    """The packed training sequences: bin_id, n_words, doc_ids (of the pieces, in order) and text.

    Documents are packed as pack does, each row as often as it occurs; their clusters are texts equal after
    lower-casing and collapsing white space, so copies that a mix repeats never share a sequence. A piece is the
    text from its first word to its last, layout included; pieces are joined by separator. Documents without words
    (null, empty, blank) have no piece. Texts are shuffled once, to their shard; a shard's size is in characters,
    so it stays bounded whatever the words are like, but for a single word longer than that.
    """
    low = docs.select(
        F.col(doc_id).cast("long").alias("id"), F.col(source).cast("string").alias("source"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"), F.length(text).cast("long").alias("chars"),
        _exact(text).alias("cluster"), F.coalesce(F.col(text), F.lit("")).alias("body"),
    )
    total = low.agg(F.sum("chars")).first()[0] or 0
    shards = max(1, math.ceil(total / shard_chars))
    rows = _dealt(low, shards, "chars", shard_chars / 4).select("id", "source", "h", "cluster", "salt", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 256):
            pieces = [cut(t, capacity) for t in batch.column(5).to_pylist()]
            at = pa.array(np.repeat(np.arange(len(pieces)), [len(p) for p in pieces]))
            more = [pa.array([k for p in pieces for k in range(len(p))], pa.int32()), pa.array([n for p in pieces for n, _ in p], pa.int64()), pa.array([t for p in pieces for _, t in p], pa.string())]
            yield pa.RecordBatch.from_arrays([*[c.take(at) for c in batch.columns[:5]], *more], names=["id", "source", "h", "cluster", "salt", "piece", "size", "body"])

    parts = rows.mapInArrow(run, "id long, source string, h long, cluster long, salt long, piece int, size long, body string")
    packed = parts.select(_shard(shards), "id", "piece", "size", "source", "cluster", "h", "body").groupBy("shard")
    return packed.applyInPandas(_joiner(capacity, per_source, source_share, separator), "bin_id long, n_words long, doc_ids array<long>, text string")
