"""Mixing sources to target weights by weighted fair queueing.

Each source is a flow. Its documents are shuffled by a keyed hash and queued once per pass; a document's
virtual finish time is the source's tokens up to and including it, divided by the source's target. All
flows then advance at the rates of their targets, so sorting every document globally by finish time and
truncating at the total budget takes each source to its target. Where a source reaches its target, documents
that would cross it wait for smaller ones behind them, so that whole documents come close to it.

Running totals never put a source into one task: rows fall into buckets by their shuffle key (uniform by
construction), bucket totals are summed first, and only rows of one bucket are ordered together.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.llm.common import free_name, partitions, stage, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
PASSES = 2


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = PASSES) -> DataFrame:
    """(source, source_size) -> with weight and target.

    Sources in code-point order, null last, take the weights in turn. A target is the smaller of most
    times the source's size and a common level times its weight; the level, at which the targets add up to
    share of all tokens, is what resharing every excess by weight ends at. One row per source is windowed.
    """
    order = W.orderBy(F.col("source").isNull(), F.encode(F.col("source"), "utf-8"))
    ranked = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    cap = F.col("source_size") * F.lit(float(most))
    filled = W.orderBy("full_at", F.col("source").isNull(), "source")
    below = filled.rowsBetween(W.unboundedPreceding, -1)
    above = filled.rowsBetween(0, W.unboundedFollowing)
    levels = (
        ranked.withColumn("full_at", cap / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(W.partitionBy()) * F.lit(float(share)))
        .withColumn("level", (F.col("budget") - F.coalesce(F.sum(cap).over(below), F.lit(0.0))) / F.sum("weight").over(above))
    )
    # the level at which a source would not be full, taken at the first such source
    first = levels.withColumn("common", F.min(F.when(F.col("level") < F.col("full_at"), F.struct("full_at", "level"))).over(W.partitionBy())["level"])
    return first.select(*sizes.columns, "weight", F.when(F.col("common").isNull(), cap).otherwise(F.least(cap, F.col("common") * F.col("weight"))).alias("target"))


def _fill(bucket: pa.Table) -> pa.Table:
    """The bucket in which a flow reaches its target: documents that would cross it wait until smaller ones
    behind them have passed. Adds the running total."""
    bucket = bucket.take(pc.sort_indices(bucket, sort_keys=[("key", "ascending"), ("id", "ascending"), ("size", "ascending")], null_placement="at_start"))
    sizes, before = bucket["size"].to_pylist(), bucket["before"][0].as_py()
    room, first, later = bucket["edge"][0].as_py() - before, [], []
    for i, size in enumerate(sizes):
        if size <= room:
            room -= size
            first.append(i)
        else:
            later.append(i)
    bucket = bucket.take(pa.array([*first, *later], pa.int64()))
    total = before + np.cumsum(bucket["size"].to_numpy())
    return bucket.append_column("total", pa.array(total, pa.int64()))


def _queues(rows: DataFrame, sizes: DataFrame, per_bucket: int) -> DataFrame:
    """rows (id, size, source, key) with their source's size and target, and total: the source's tokens up to
    and including the document."""
    r, s = rows.alias("r"), sizes.alias("s")
    # shuffle keys are uniform over the longs; a document's bucket is the part of its source that its key falls in
    of = F.greatest(F.lit(1), F.floor(F.col("n_docs") / per_bucket))
    part = F.least(F.floor((F.col("key") / F.lit(2.0**64) + F.lit(0.5)) * of), of - 1)
    rows = r.join(s, F.col("r.source").eqNullSafe(F.col("s.source"))).select("r.*", part.cast("long").alias("part"))
    parts = rows.groupBy("source", "part").agg(F.sum("size").alias("inside"))
    earlier = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("inside").over(earlier), F.lit(0)).cast("long"))
    p = parts.alias("p")
    # where in its queue, in the first pass or a later one, a source reaches its target
    edge = F.col("target") - F.col("source_size") * F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)))
    known = p.join(s, F.col("p.source").eqNullSafe(F.col("s.source"))).select("p.source", "part", "before", "inside", "source_size", "target", F.coalesce(edge, F.lit(0.0)).alias("edge")).alias("k")
    r = rows.alias("r")
    on = F.col("r.source").eqNullSafe(F.col("k.source")) & (F.col("r.part") == F.col("k.part"))
    joined = r.join(known, on).select("r.*", "before", "inside", "source_size", "target", "edge")
    reached = (F.col("before") < F.col("edge")) & (F.col("edge") < F.col("before") + F.col("inside"))
    inside = W.partitionBy("source", "part").orderBy("key", F.col("id").asc_nulls_first(), "size").rowsBetween(W.unboundedPreceding, 0)
    plain = joined.where(~reached).withColumn("total", (F.col("before") + F.sum("size").over(inside)).cast("long"))
    # at most one bucket of each source
    return plain.union(joined.where(reached).groupBy("source", "part").applyInArrow(_fill, plain.schema))


def schedule(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 17, rows_per_bucket: int | None = None) -> DataFrame:
    """One row per document row: id, size, source, source_size, target, h (a hash of its text), finish (of the first
    pass), lap (virtual time of a whole pass of its source) and passes, how often the mix takes it.

    Reruns agree: the shuffle is a hash of id, text and seed, ties fall by id and size, and rows equal in these
    are interchangeable. A null source is a source of its own; only copies of one row share a shuffle key; a
    source without words has target 0 and its documents, all empty, are taken in no pass. Texts are counted
    whole, of any length; an empty table has an empty schedule; other columns are ignored.
    """
    key = F.xxhash64(F.col(doc_id), F.xxhash64(text), F.lit(seed))
    rows = stage(docs.select(F.col(doc_id).alias("id"), word_count(text).alias("size"), F.col(source).cast("string").alias("source"), key.alias("key"), F.xxhash64(text).alias("h")), "sizes")
    # buckets of about the root of the rows: ordering one, and adding up all, take tasks of like size
    total = rows.count()
    per_bucket = rows_per_bucket or max(512, math.isqrt(total))
    n = max(1, total // per_bucket)
    sizes = targets(rows.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"), F.count("*").alias("n_docs")))
    timed = stage(
        _queues(rows, sizes, per_bucket).select("id", "size", "source", "source_size", "target", "key", "h", (F.col("total") / F.nullif(F.col("target"), F.lit(0.0))).alias("finish"), (F.col("source_size") / F.nullif(F.col("target"), F.lit(0.0))).alias("lap")),
        "timed",
    )
    queued = (
        timed.where("finish is not null").withColumn("lap_no", F.explode(F.sequence(F.lit(0), F.lit(PASSES - 1))))
        .select("id", "size", "source", "key", (F.col("finish") + F.col("lap_no") * F.col("lap")).alias("at"))
        # flows run at constant rates, so equal spans of virtual time hold about equal tokens
        .withColumn("slot", F.floor(F.least("at", F.lit(2.0 * PASSES)) * n).cast("long"))
    )
    budget = rows.agg(F.sum("size")).first()[0] or 0
    cut = _cut(queued, budget * SHARE)
    if cut is None:
        return timed.withColumn("passes", F.lit(0)).drop("key")
    taken = F.lit(0)
    for lap_no in range(PASSES):
        at = F.col("finish") + F.lit(lap_no) * F.col("lap")
        same = F.struct(F.col("key"), F.coalesce("source", F.lit("")), F.coalesce(F.col("id").cast("long"), F.lit(-(2**63))), F.col("size"))
        limit = F.struct(F.lit(cut["key"]).alias("key"), F.lit(cut["source"] or ""), F.lit(cut["id"] if cut["id"] is not None else -(2**63)).cast("long"), F.lit(cut["size"]).cast("long"))
        taken = taken + F.coalesce(((at < cut["at"]) | ((at == cut["at"]) & (same <= limit))).cast("int"), F.lit(0))
    return timed.withColumn("passes", taken).drop("key")


def _cut(queued: DataFrame, budget: float):
    """The last row that the budget takes in global order, found in its slot; None if nothing is taken."""
    slots = queued.groupBy("slot").agg(F.sum("size").alias("tokens"))
    ends = slots.withColumn("total", F.sum("tokens").over(W.orderBy("slot"))).where(F.col("total") >= budget).orderBy("slot").limit(1).first()
    if ends is None:
        return queued.agg(F.max(F.struct("at", "key", "source", "id", "size")).alias("m")).first()["m"]
    before = ends["total"] - ends["tokens"]
    order = W.orderBy("at", "key", F.coalesce("source", F.lit("")), F.col("id").asc_nulls_first(), "size").rowsBetween(W.unboundedPreceding, 0)
    # one slot of virtual time: about as many rows as a bucket
    inside = queued.where(F.col("slot") == ends["slot"]).withColumn("total", F.sum("size").over(order) + before)
    last = inside.where(F.col("total") <= budget).orderBy(F.col("total").desc(), F.col("at").desc(), F.col("key").desc()).limit(1).first()
    if last is not None:
        return last
    earlier = queued.where(F.col("slot") < ends["slot"]).agg(F.max(F.struct("at", "key", "source", "id", "size")).alias("m")).first()
    return earlier["m"]


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 17) -> DataFrame:
    """The mixed documents themselves, repeats included, globally range-sorted by virtual finish time.

    A document row is matched to its schedule by id, source and text: rows equal in these are taken alike. A document
    without words counts nothing; it is in the mix if its source has words.
    """
    plan = schedule(docs, doc_id, text, source, seed).where("passes > 0").groupBy("id", "size", "source", "h").agg(F.max("passes").alias("passes"), F.min("finish").alias("finish"), F.min("lap").alias("lap"))
    size, finish, lap, passes, nth, at, of, whose, h = (free_name(docs, f"_{n}") for n in ("size", "finish", "lap", "passes", "nth", "at", "id", "source", "h"))
    plan = plan.select(F.col("id").alias(of), F.col("size").alias(f"{size}_"), F.col("source").alias(whose), F.col("h").alias(h), F.col("passes").alias(passes), F.col("finish").alias(finish), F.col("lap").alias(lap))
    sized = docs.withColumn(size, word_count(text))
    on = sized[doc_id].eqNullSafe(plan[of]) & (sized[size] == plan[f"{size}_"]) & sized[source].cast("string").eqNullSafe(plan[whose]) & (F.xxhash64(sized[text]) == plan[h])
    repeated = sized.join(plan, on).select(*[sized[c] for c in docs.columns], finish, lap, F.explode(F.sequence(F.lit(0), F.col(passes) - 1)).alias(nth))
    timed = repeated.withColumn(at, F.col(finish) + F.col(nth) * F.col(lap))
    return timed.repartitionByRange(partitions(docs.sparkSession), at, doc_id).sortWithinPartitions(at, doc_id).select(*docs.columns)
