"""SimHash near-dedup by covering locality-sensitive hashing (Pagh, 2016).

Every bit position gets a non-zero vector of r+1 bits. For each of the 2^(r+1)-1 non-zero vectors a, a
mask keeps the positions whose vector has an odd inner product with a. Two fingerprints that differ in
at most r positions leave some a orthogonal to all of those, so their masked fingerprints agree in that
table: no pair inside the radius is missed, whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.blocks import Forest, pieces
from tickloom.llm.common import free_name, stage
from tickloom.llm.components import connected_components
from tickloom.llm.tokens import in_slices, word_bytes, words_of

SEED = 42
CHUNK = 1 << 16


def majority(hashes: np.ndarray) -> int:
    """The fingerprint whose bits are set in over half of the hashes; 0 for none."""
    n = len(hashes)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, CHUNK):
        part = hashes[at : at + CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True) if n else 0


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3, count: str | None = None) -> DataFrame:
    """docs with a long column fp, the SimHash of its lower-cased word shingles, and if asked the number of words
    in a column count; text itself is dropped.

    Null, empty and all-blank texts have fingerprint 0; a text with fewer words than a shingle is one shingle.
    """
    rest = [c for c in docs.columns if c not in (text, "fp", count)]
    more = [] if count is None else [count]
    out = docs.select(*rest, *[F.lit(0).cast("long").alias(c) for c in ("fp", *more)]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in in_slices(batches, 2048):
            words, counts = words_of(batch.column(len(rest)))
            offsets, data = word_bytes(words)
            raw, prints, at = bytes(data), [], 0
            for n in counts.tolist():
                bounds = (offsets[at : at + n + 1] - (offsets[at] if n else 0)).tolist()
                k = min(shingle, n)
                if n:
                    base = int(offsets[at])
                    mine = raw[base : base + bounds[-1]]
                    joined = b" ".join([mine[a:b] for a, b in zip(bounds, bounds[1:])])
                    # word i starts i separators later in the joined text
                    starts = [b + i for i, b in enumerate(bounds[: n - k + 1])]
                    ends = [b + i for i, b in enumerate(bounds[k:], k - 1)]
                    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, n - k + 1)
                    prints.append(majority(hashes))
                else:
                    prints.append(0)
                at += n
            found = [pa.array(prints, pa.int64()), *[pa.array(counts, pa.int64()) for _ in more]]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], *found], names=[*rest, "fp", *more])

    return docs.select(*rest, text).mapInArrow(run, out)


def covering_masks(radius: int, bits: int = 64) -> list[int]:
    """The 2^(radius+1)-1 masks, as signed longs. Positions take the non-zero vectors in turn."""
    size = 1 << (radius + 1)
    vector = [1 + i % (size - 1) for i in range(bits)]
    masks = [sum(1 << i for i in range(bits) if (vector[i] & a).bit_count() % 2) for a in range(1, size)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(prints: DataFrame, radius: int = 3, block: int = 1024) -> DataFrame:
    """Edges (u, v) that connect exactly the distinct fingerprints within radius of one another.

    Each bucket of a table is verified in bounded pieces; a piece returns a spanning forest of its true
    links, so that a large group of near copies costs rows in proportion to its size.
    """
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(covering_masks(radius))])
    rows = prints.select("fp", F.explode(tables).alias("k")).select("k.t", "k.key", "fp")
    work = pieces(rows, ["t", "key"], "fp", block).groupBy("t", "key", "lo", "hi").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select("fps")

    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            us: list[int] = []
            vs: list[int] = []
            for fps in frame["fps"]:
                x = np.asarray(fps, dtype=np.int64)
                if len(x) == 2:
                    if np.bitwise_count((x[0] ^ x[1]).view(np.uint64)) <= radius:
                        us.append(int(x[0]))
                        vs.append(int(x[1]))
                    continue
                forest, y = Forest(len(x)), x.view(np.uint64)
                for i in range(len(x) - 1):
                    for j in np.flatnonzero(np.bitwise_count(y[i + 1 :] ^ y[i]) <= radius).tolist():
                        forest.link(i, i + 1 + j)
                leaf, root = forest.stars()
                us += x[leaf].tolist()
                vs += x[root].tolist()
            yield pd.DataFrame({"u": pd.Series(us, dtype="int64"), "v": pd.Series(vs, dtype="int64")})

    return work.mapInPandas(verify, "u long, v long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row per document row: id, fp (long) and component_id, the smallest id reachable by links.

    Null ids get their group's component, or null where the whole group has none. Rows that repeat an id
    with several texts are linked by text only: each row has its own text's component.
    """
    prints = stage(fingerprints(docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")), "_text", shingle), "prints")
    distinct = prints.groupBy("fp").agg(F.min("_id").alias("least"))
    roots = connected_components(links(distinct.select("fp"), radius))
    linked = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    component = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    of = linked.join(component, "root").select("fp", "component_id")
    return prints.join(of, "fp").select(F.col("_id").alias(doc_id), "fp", "component_id")


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """docs without near duplicates: of each group of linked documents the one with the smallest id stays.

    A group of null ids only keeps one row too; of rows equal in id and text one stays. Null, empty and blank
    texts are one group. Columns are kept, whatever their names; an empty table stays empty.
    """
    known = F.coalesce(F.col("_id").cast("long"), F.lit(2**63 - 1))
    keyed = docs.select(F.struct(F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_h")).alias("key"), F.col(text).alias("_text"))
    prints = stage(fingerprints(keyed, "_text", shingle).select("key._id", "key._h", "fp"), "prints")
    distinct = prints.groupBy("fp").agg(F.min(F.struct(known.alias("_known"), F.col("_h"))).alias("least"))
    roots = connected_components(links(distinct.select("fp"), radius))
    root = F.coalesce("root", "fp")
    stay = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").groupBy(root.alias("root")).agg(F.min("least").alias("least"))
    stay = stage(stay.select(F.col("least._known").alias("_known"), F.col("least._h").alias("_h")), "stay")
    k, h = free_name(docs, "_known"), free_name(docs, "_h")
    named = lambda df: df.select(F.col("_known").alias(k), F.col("_h").alias(h))
    marked = docs.withColumn(h, F.xxhash64(text)).withColumn(k, F.coalesce(F.col(doc_id).cast("long"), F.lit(2**63 - 1)))
    kept = marked.join(named(stay), [k, h], "left_semi")
    repeated = prints.groupBy(known.alias("_known"), "_h").count().where("count > 1").join(stay, ["_known", "_h"], "left_semi")
    repeated = stage(named(repeated), "repeated")
    if not repeated.isEmpty():
        again = kept.join(repeated, [k, h], "left_semi").dropDuplicates([k, h])
        kept = kept.join(repeated, [k, h], "left_anti").unionByName(again)
    return kept.select(*docs.columns)
