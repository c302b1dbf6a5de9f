"""Embedding near-dedup with spherical-cap filters (Becker, Ducas, Gama, Laarhoven, 2016).

Filter directions are a random product code: the coordinates are cut into two parts, each part has its
own random codebook, and every pair of codewords is a direction. A vector belongs to all filters whose
inner product with it exceeds a threshold; these are listed without visiting the others, since the
product's score is the sum of two part scores. Vectors are joined on the filters that they share.

The codebook's size follows the number of distinct vectors, so that a filter holds OCCUPANCY vectors at any
scale. The list length is chosen by simulation on random pairs at the similarity threshold (no data
involved), such that RECALL of such pairs share a filter; closer pairs share one more often.

Verification ships each vector a few times, not once a filter. The join carries ids and sketches of BITS sign
bits only; pairs in a filter whose sketches are near make groups, by connected components. Every link lies
inside a group, so the pairs of a group are compared exactly, in double precision, each once, and near ones count
that share a filter. A group too large for that (CHAIN, as when loosely similar vectors form a chain) is joined on
filters with its vectors instead, and a near pair counts in the first filter that it shares. Either way the same
pairs are links: CHAIN decides what is sent, not what is found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.blocks import Forest, pieces
from tickloom.llm.common import stage, unstage
from tickloom.llm.components import connected_components

RECALL = 0.99
SEED = 11
#: Vectors in a filter, on average.
OCCUPANCY = 16
#: Sign bits of a sketch, and how many standard deviations beyond the expectation at the threshold two may differ.
BITS, SLACK = 256, 5.0
#: Members of a group up to which its pairs are compared piece by piece; larger ones go by filter. Links are the same.
CHAIN = 4096
#: Scores held at once while filters are listed.
SCORES = 1 << 22


class Caps:
    """The filters for one dimension, and the sketch's directions."""

    def __init__(self, dim: int, size: int, threshold: float):
        self.dim, self.size, self.threshold = dim, size, threshold
        rng = np.random.default_rng([SEED, dim, size])
        self.cut = max(1, dim // 2)
        parts = (self.cut, dim - self.cut)
        self.books = []
        for width in parts:
            book = rng.standard_normal((size, width))
            norm = np.linalg.norm(book, axis=1, keepdims=True)
            self.books.append(book / np.where(norm > 0, norm, 1) / math.sqrt(2 if min(parts) else 1))
        self.signs = np.random.default_rng([SEED, dim, 1]).standard_normal((dim, BITS))

    def __reduce__(self):
        """Tasks draw the codebooks again from their seed: nothing that grows with the data is sent."""
        return Caps, (self.dim, self.size, self.threshold)

    def scores(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.cut] @ self.books[0].T, x[:, self.cut :] @ self.books[1].T

    def lists(self, x: np.ndarray) -> list[np.ndarray]:
        """For each unit vector the sorted filters that it exceeds."""
        out, rows = [], max(1, SCORES // self.size)
        for at in range(0, len(x), rows):
            left, right = self.scores(x[at : at + rows])
            for a, b in zip(left, right):
                first = np.flatnonzero(a >= self.threshold - b.max())
                second = np.flatnonzero(b >= self.threshold - a.max())
                i, j = np.nonzero(a[first][:, None] + b[second][None, :] >= self.threshold)
                out.append(first[i].astype(np.int64) * self.size + second[j])
        return out

    def sketches(self, x: np.ndarray) -> np.ndarray:
        """BITS sign bits of each vector, in whole 64-bit numbers."""
        return np.packbits(x @ self.signs > 0, axis=1).view(np.int64)


def most_differing(cosine: float) -> int:
    """Sketch bits in which two vectors at the threshold differ at most, but for one pair in millions."""
    p = math.acos(max(-1.0, min(1.0, cosine))) / math.pi
    return math.ceil(BITS * p + SLACK * math.sqrt(BITS * p * (1 - p)))


def fit_caps(dim: int, n: int, cosine: float) -> Caps:
    """Filters for n vectors: lists as short as RECALL at the threshold allows."""
    rng = np.random.default_rng([SEED, dim])
    x = rng.standard_normal((1000, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal((1000, dim))
    z -= (z * x).sum(1, keepdims=True) * x
    norm = np.linalg.norm(z, axis=1, keepdims=True)
    y = cosine * x + math.sqrt(1 - cosine * cosine) * z / np.where(norm > 0, norm, 1)
    length = 8.0
    while True:
        size = max(4, math.ceil(math.sqrt(max(n, 1) * length / OCCUPANCY)))
        caps = Caps(dim, size, 0.0)
        a, b = caps.scores(x[:60])
        part = (a[:, :, None] + b[:, None, :]).ravel() if size <= 400 else (a[:, rng.permutation(size)[:400], None] + b[:, None, rng.permutation(size)[:400]]).ravel()
        caps.threshold = float(np.quantile(part, 1 - min(1.0, length / size**2)))
        shared = np.mean([bool(np.intersect1d(p, q, assume_unique=True).size) for p, q in zip(caps.lists(x), caps.lists(y))])
        if shared >= RECALL or length >= size**2:
            return caps
        length *= 1.15


def units(vectors) -> np.ndarray:
    """The vectors in double precision, scaled to length 1."""
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    # scaled by the largest component first: squares of very large or small ones leave the range of doubles
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _lister(caps: dict[int, Caps]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, part in frame.groupby("dim"):
                for at in range(0, len(part), 512):
                    some = part.iloc[at : at + 512]
                    x = units(some["vector"])
                    yield pd.DataFrame({"rep": some["rep"].to_numpy(), "dim": dim, "sketch": list(caps[int(dim)].sketches(x)), "filters": caps[int(dim)].lists(x)})

    return run


def _linker(most: int):
    """Of each bucket (members with rep, own and sketch; lo, hi) the pairs with near sketches that connect the
    members of a batch; groups that are connected already give no more pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("members")
            members = lists.flatten()
            lengths = np.diff(lists.offsets.to_numpy())
            rep, node = np.unique(members.field("rep").to_numpy(), return_inverse=True)
            own, width = members.field("own").to_numpy(), BITS // 64
            sketch = members.field("sketch").flatten().to_numpy().reshape(-1, width).view(np.uint64)
            ends = np.repeat(np.cumsum(lengths), lengths)
            across = np.repeat((batch.column("lo").to_numpy() != batch.column("hi").to_numpy()), lengths)
            forest, at = Forest(len(rep)), np.arange(len(node))
            root = forest.roots()
            for shift in range(1, int(lengths.max(initial=1))):
                at = at[at + shift < ends[at]]
                i, j = at, at + shift
                apart = (root[node[i]] != root[node[j]]) & ~(across[i] & (own[i] == own[j]))
                i, j = i[apart], j[apart]
                near = np.bitwise_count(sketch[i] ^ sketch[j]).sum(axis=1) <= most
                if near.any():
                    for a, b in zip(node[i[near]].tolist(), node[j[near]].tolist()):
                        forest.link(a, b)
                    root = forest.roots()
            yield pa.RecordBatch.from_arrays([pa.array(rep[side], pa.int64()) for side in forest.stars()], names=["u", "v"])

    return run


def share_a_filter(filters: list[np.ndarray], i: np.ndarray, j: np.ndarray, below: int | None = None) -> np.ndarray:
    """Of pairs of members (i, j) with their sorted filters, whether they share one (below a key, if that is given)."""
    rows, at = np.unique(np.concatenate([i, j]), return_inverse=True)
    lists = [np.asarray(filters[r]) for r in rows.tolist()]
    if below is not None:
        lists = [c[: np.searchsorted(c, below)] for c in lists]
    owner = np.repeat(np.arange(len(rows)), [len(c) for c in lists])
    _, column, often = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    common = often[column] > 1
    owner, column = owner[common], np.unique(column[common], return_inverse=True)[1]
    shared = np.zeros((len(rows), len(rows)), dtype=np.float32)
    for start in range(0, int(column.max(initial=-1)) + 1, 4096):
        here = (column >= start) & (column < start + 4096)
        member = np.zeros((len(rows), 4096), dtype=np.float32)
        member[owner[here], column[here] - start] = 1
        width = int(column[here].max(initial=start)) - start + 1
        shared += member[:, :width] @ member[:, :width].T
    return shared[at[: len(i)], at[len(i) :]] > 0


def _verifier(cosine: float, caps: dict[int, Caps]):
    """Exact links of the pairs of a piece: per member how many, and a spanning forest. A pair counts if it shares a
    filter. Pieces of a filter (bucket not null) leave out pairs that share an earlier one; pieces of a group list
    the filters of the members of near pairs again."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            us, vs, ws = [], [], []
            for key, lo, hi, members in zip(frame["bucket"], frame["lo"], frame["hi"], frame["members"]):
                x = units([m["vector"] for m in members])
                block = np.array([m["own"] for m in members])
                near = np.triu(x @ x.T >= cosine, 1)
                if lo != hi:  # pairs inside one block are met where lo = hi
                    near &= block[:, None] != block[None, :]
                i, j = np.nonzero(near)
                if len(i) and not pd.isna(key):
                    counts = ~share_a_filter([m["filters"] for m in members], i, j, below=int(key))
                    i, j = i[counts], j[counts]
                elif len(i):
                    some, at = np.unique(np.concatenate([i, j]), return_inverse=True)
                    counts = share_a_filter(caps[x.shape[1]].lists(x[some]), at[: len(i)], at[len(i) :])
                    i, j = i[counts], j[counts]
                copies = np.array([m["copies"] for m in members], dtype=np.int64)
                links = np.zeros(len(members), dtype=np.int64)
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                forest = Forest(len(members))
                for a, b in zip(i.tolist(), j.tolist()):
                    forest.link(a, b)
                for a in np.flatnonzero(links).tolist():
                    us.append(members[a]["rep"])
                    vs.append(None)
                    ws.append(int(links[a]))
                for a, b in zip(*[side.tolist() for side in forest.stars()]):
                    us.append(members[a]["rep"])
                    vs.append(members[b]["rep"])
                    ws.append(0)
            yield pd.DataFrame({"u": pd.Series(us, dtype="Int64"), "v": pd.Series(vs, dtype="Int64"), "w": pd.Series(ws, dtype="Int64")})

    return run


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", cosine: float = 0.95, block: int = 512, chain: int = CHAIN) -> DataFrame:
    """One row per vector row: id, n_links, component_id, kept.

    A vector that is null, zero, empty, or holds a null or non-finite component links with nothing, nor do
    vectors of different lengths. Equal vectors are one representative with a number of copies, which all
    link with one another; a repeated id counts as another vector. Null ids take part, and their own rows
    carry null ids and their component's. An empty table has an empty result; other columns are ignored.
    Vectors are told apart by two 64-bit hashes.
    """
    plain = F.transform(F.col(vector), lambda e: e + F.lit(0).cast(vectors.schema[vector].dataType.elementType))  # -0.0 and 0.0 are one value
    big = F.col("vector")
    hashes = (F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(SEED), "vector").alias("h2"))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), plain.alias("vector")).withColumn(
        "usable",
        F.coalesce(
            (F.size(big) > 0)
            & F.forall(big, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
            & F.exists(big, lambda e: e != 0),
            F.lit(False),
        ),
    )
    groups = rows.where("usable").groupBy("vector").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    groups = stage(groups.select(F.monotonically_increasing_id().alias("rep"), *hashes, F.size("vector").alias("dim"), "vector", "least", "copies"), "vectors")
    caps = {r["dim"]: fit_caps(r["dim"], r["n"], cosine) for r in groups.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    listed = stage(groups.select("rep", "dim", "vector").mapInPandas(_lister(caps), "rep long, dim int, sketch array<long>, filters array<long>"), "filters")

    met = pieces(listed.select("rep", "dim", "sketch", F.explode("filters").alias("filter")), ["dim", "filter"], "rep", 2 * block)
    met = met.groupBy("dim", "filter", "lo", "hi").agg(F.collect_list(F.struct("rep", "own", "sketch")).alias("members")).where(F.size("members") > 1)
    edges = stage(met.select("lo", "hi", "members").mapInArrow(_linker(most_differing(cosine)), "u long, v long"), "candidates")
    grouped = stage(connected_components(edges), "groups")
    large = stage(grouped.groupBy("root").agg(F.count("*").alias("n")).where(F.col("n") > chain).select("root"), "chains")

    member = groups.select("rep", "dim", "vector", "copies")
    chained = not large.isEmpty()
    small = grouped.join(large, "root", "left_anti") if chained else grouped
    inside = pieces(small.select("root", F.col("node").alias("rep")), ["root"], "rep", block).join(member, "rep")
    packed = [F.struct("rep", "copies", "own", "vector", *more) for more in ([], ["filters"])]
    work = inside.groupBy("root", "lo", "hi").agg(F.collect_list(packed[0]).alias("members")).where(F.size("members") > 1)
    verify, out = _verifier(cosine, caps), "u long, v long, w long"
    found = stage(work.select(F.lit(None).cast("long").alias("bucket"), "lo", "hi", "members").mapInPandas(verify, out), "links")
    if chained:
        lists = grouped.join(large, "root", "left_semi").select(F.col("node").alias("rep")).join(listed.select("rep", "filters"), "rep").join(member, "rep")
        lists = stage(lists, "chained")
        routes = pieces(lists.select("rep", "dim", F.explode("filters").alias("bucket")), ["dim", "bucket"], "rep", block)
        work = routes.join(lists.drop("dim"), "rep").groupBy("dim", "bucket", "lo", "hi").agg(F.collect_list(packed[1]).alias("members")).where(F.size("members") > 1)
        found = found.union(stage(work.select("bucket", "lo", "hi", "members").mapInPandas(verify, out), "links"))
        unstage(lists)
    unstage(listed, edges)

    links = found.where("v is null").groupBy(F.col("u").alias("rep")).agg(F.sum("w").alias("others"))
    roots = connected_components(found.where("v is not null").select("u", "v")).withColumnRenamed("node", "rep")
    joined = groups.select("h1", "h2", "rep", "least", "copies").join(links, "rep", "left").join(roots, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    component = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    of = joined.join(component, "root").select("h1", "h2", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("links"), "component_id")
    keyed = rows.select("id", "usable", *[F.when(F.col("usable"), h).alias(n) for h, n in zip(hashes, ("h1", "h2"))])
    lone = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("id"))
    return keyed.join(of, ["h1", "h2"], "left").select(
        F.col("id").alias(vec_id), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), lone.alias("component_id"), F.coalesce(F.col("id") == lone, F.lit(False)).alias("kept")
    )
