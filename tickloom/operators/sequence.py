"""Continuity of numbered messages: classification, contiguity, order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.operators.stretches import with_previous


def state_before(rows: DataFrame, keys: list[str], arrival: str, state: Column, width: int) -> DataFrame:
    """rows with column before: the largest state among all earlier arrivals of their keys.

    The maximum is associative, so it is scanned in two levels: over stretches of width arrival numbers,
    then inside each. No source, however busy, is one task.
    """
    cut = rows.withColumn("_part", F.floor(F.col(arrival) / width)).withColumn("_state", state)
    tops = cut.groupBy(*keys, "_part").agg(F.max("_state").alias("_top"))
    earlier = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    tops = tops.withColumn("_carried", F.max("_top").over(earlier)).drop("_top")
    inside = W.partitionBy(*keys, "_part").orderBy(arrival).rowsBetween(W.unboundedPreceding, -1)
    joined = cut.join(tops, [*keys, "_part"])
    return joined.withColumn("before", F.greatest("_carried", F.max("_state").over(inside))).drop("_part", "_state", "_carried")


def stretch(rows: DataFrame, arrival: str, part_rows: int = 20_000) -> int:
    """The width of arrival numbers that holds about part_rows rows, from their range and count."""
    found = rows.agg(F.min(arrival).alias("a"), F.max(arrival).alias("b"), F.count(arrival).alias("n")).first()
    return max(1, -(-(int(found["b"]) - int(found["a"]) + 1) // max(1, found["n"] // part_rows))) if found["n"] else 1


def classify(rows: DataFrame, keys: list[str], arrival: str, width: int | None = None) -> DataFrame:
    """rows (keys, generation, sequence, arrival) with decision, missing_first and missing_last.

    The first message of a source, and of each new generation, is accepted at any number; a gap's message
    is still accepted. Accepted states only grow, so the state before a row is the running maximum. width None:
    one pass over the arrival numbers chooses it.
    """
    width = width or stretch(rows, arrival)
    state = F.struct(F.col("generation").alias("generation"), F.col("sequence").alias("sequence"))
    out = state_before(rows, keys, arrival, state, width)
    g, s = F.col("before.generation"), F.col("before.sequence")
    fresh = F.col("before").isNull() | (F.col("generation") > g)
    decision = (
        F.when(fresh, "accept")
        .when(F.col("generation") < g, "stale_generation")
        .when(F.col("sequence") <= s, "duplicate_or_reordered")
        .when(F.col("sequence") > s + 1, "gap")
        .otherwise("accept")
    )
    gap = F.col("decision") == "gap"
    return out.withColumn("decision", decision).withColumn("missing_first", F.when(gap, s + 1)).withColumn("missing_last", F.when(gap, F.col("sequence") - 1)).drop("before")


def gap_ledger(classified: DataFrame) -> DataFrame:
    """The entries that a gap ledger gets, in one shape."""
    return classified.where("decision <> 'accept'").withColumnsRenamed({"decision": "reason", "missing_first": "missing_start", "missing_last": "missing_end"})


def contiguity(rows: DataFrame, keys: list[str], number: str) -> DataFrame:
    """Per key: first, last, rows, and whether the numbers run without gap or repetition."""
    n = F.col("n_rows")
    per = rows.groupBy(*keys).agg(F.min(number).alias("first"), F.max(number).alias("last"), F.count("*").alias("n_rows"), F.count_distinct(number).alias("n_distinct"))
    return per.withColumn("contiguous", (F.col("last") - F.col("first") + 1 == n) & (n == F.col("n_distinct"))).drop("n_distinct")


def not_increasing(rows: DataFrame, keys: list[str], arrival: str, width: int | None = None) -> DataFrame:
    """Rows whose (generation, sequence) is not above that of the row before. width None: one pass over the arrival
    numbers chooses it."""
    cut = F.floor(F.col(arrival) / (width or stretch(rows, arrival)))
    now = F.struct("generation", "sequence")
    return with_previous(rows, keys, cut, [arrival], now, "_previous").where(F.col("_previous") >= now).drop("_previous")


def chunk_breaks(chunks: DataFrame, keys: list[str], width: int | None = None) -> DataFrame:
    """Chunks (generation, first, last) that do not follow the one before: the next number of a generation,
    or a later generation. width: numbers of a stretch; None chooses it as not_increasing does."""
    cut = F.struct("generation", F.floor(F.col("first") / (width or stretch(chunks, "first"))).alias("part"))
    known = with_previous(chunks, keys, cut, ["generation", "first"], F.struct("generation", "last"), "_previous")
    g, last = F.col("_previous.generation"), F.col("_previous.last")
    ok = F.col("_previous").isNull() | (F.col("generation") > g) | (F.col("first") == last + 1)
    return known.withColumn("_ok", ok).where("not _ok").drop("_ok", "_previous")
