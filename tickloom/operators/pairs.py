"""Raw frames and the events decoded from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import errors
from tickloom.operators.sequence import stretch
from tickloom.operators.stretches import with_running_sum

V1_KEY = ["generation", "frame_sequence"]
V2_KEY = ["capture_instance_id", "source_generation", "generation", "frame_sequence"]


def frame_completeness(frames: DataFrame, events: DataFrame, key: list[str], ordinal: str, expected: str) -> DataFrame:
    """Per frame key: declared and found events, distinct ordinals, and whether they agree.

    Events without a frame appear with declared null; ordinals are counted with partial aggregates, and
    only one row per frame is joined.
    """
    found = events.groupBy(*key).agg(F.count("*").alias("n_events"), F.count_distinct(ordinal).alias("n_ordinals"))
    declared = frames.groupBy(*key).agg(F.max(expected).alias("declared"), F.count("*").alias("n_frames"))
    both = declared.join(found, key, "full_outer").na.fill(0, ["n_events", "n_ordinals", "n_frames"])
    ok = (F.col("n_frames") == 1) & (F.col("n_events") == F.col("declared")) & (F.col("n_ordinals") == F.col("declared"))
    return both.withColumn("complete", F.coalesce(ok, F.lit(False)))


def hash_violations(frames: DataFrame) -> DataFrame:
    """Frames whose bytes do not have their hash."""
    return frames.where(~F.col("frame_sha256").eqNullSafe(F.sha2("frame_bytes", 256)))


def partial_references(events: DataFrame, columns: list[str]) -> DataFrame:
    """Events that hold some but not all columns of a reference to a raw frame."""
    given = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    return events.where((given > 0) & (given < len(columns)))


def chunk_digests(rows: DataFrame, chunk: list[str], order: list[str], payload: list[str]) -> DataFrame:
    """Order-sensitive digest of each chunk's rows. Chunks are bounded by construction."""
    line = F.struct(*order, F.sha2(F.to_json(F.struct(*payload)), 256).alias("h"))
    hashes = F.transform(F.sort_array(F.collect_list(line)), lambda x: x["h"])
    return rows.groupBy(*chunk).agg(F.count("*").alias("n_rows"), F.sha2(F.array_join(hashes, "\n"), 256).alias("digest"))


def depth_of(most: int, fan: int, least: int = 1) -> int:
    """Levels of a tree whose root holds the numbers from 0 to most."""
    levels, reach = least, fan**least
    while reach <= most:
        levels, reach = levels + 1, reach * fan
    return levels


def rollup_tree(digests: DataFrame, number: str, fan: int = 1024, levels: int = 3) -> DataFrame:
    """One digest over all chunks, numbered from 0: each level hashes the digests of fan neighbours in order.

    No task gathers more than fan digests. There are levels of them, or more if the last number needs it.
    """
    now = digests.select(F.col(number).cast("long").alias("_n"), "digest", F.lit(1).cast("long").alias("n_chunks"))
    for _ in range(depth_of(now.agg(F.coalesce(F.max("_n"), F.lit(0))).first()[0], fan, levels)):
        ordered = F.transform(F.sort_array(F.collect_list(F.struct("_n", "digest"))), lambda x: x["digest"])
        now = now.groupBy(F.floor(F.col("_n") / fan).cast("long").alias("_n")).agg(F.sha2(F.array_join(ordered, "\n"), 256).alias("digest"), F.sum("n_chunks").alias("n_chunks"))
    return now.drop("_n")


#: Where a chunk, or chunks that follow one another, begins and ends.
BOUNDS = ("first_generation", "first_number", "last_generation", "last_number")


def _follows(before: Column, after: Column) -> Column:
    """Whether a chunk goes on where the one before ends: the next number of its generation, or 1 of a later one."""
    same = (after["first_generation"] == before["last_generation"]) & (after["first_number"] == before["last_number"] + 1)
    return same | ((after["first_generation"] > before["last_generation"]) & (after["first_number"] == 1))


def rollup(chunks: DataFrame, keys: list[str], totals: list[str], fan: int = 1024, width: int | None = None) -> DataFrame:
    """One row per capture (keys): boundaries, n_chunks, totals, digest, and broken, how many chunks do not follow.

    chunks: keys, generation, first, last, digest, totals. The fold is associative: a node is what its chunks sum up
    to, from its first boundary to its last, and joins the nodes after it in order, fan at a time, in as many levels
    as the longest capture needs. A capture begins at number 1; a chunk that is turned, repeated or not adjacent counts
    as broken where its node meets the one before. Chunks are numbered in stretches of width first numbers, so a
    capture of any length is many tasks; null totals count as 0.
    """
    cut = F.struct("generation", F.floor(F.col("first") / (width or stretch(chunks, "first"))).alias("part"))
    numbered = with_running_sum(chunks, keys, cut, ["generation", "first", "last", "digest"], F.lit(1), "_n")
    alone = (F.col("first") > F.col("last")).cast("long") + ((F.col("_n") == 1) & (F.col("first") != 1)).cast("long")
    node = numbered.select(*keys, (F.col("_n") - 1).alias("_n"), F.col("generation").alias("first_generation"), F.col("first").alias("first_number"), F.col("generation").alias("last_generation"), F.col("last").alias("last_number"), F.lit(1).cast("long").alias("n_chunks"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in totals], "digest", alone.alias("broken"))
    sums = ["n_chunks", *totals]
    for _ in range(depth_of(node.agg(F.coalesce(F.max("_n"), F.lit(0))).first()[0], fan)):
        held = F.sort_array(F.collect_list(F.struct("_n", *BOUNDS, "digest"))).alias("_held")
        group = node.groupBy(*keys, F.floor(F.col("_n") / fan).cast("long").alias("_n")).agg(held, *[F.sum(c).alias(c) for c in sums], F.sum("broken").alias("broken"))
        seams = F.aggregate(F.sequence(F.lit(1), F.size("_held")), F.lit(0).cast("long"), lambda n, i: n + F.when((i > 1) & ~_follows(F.get("_held", i - 2), F.get("_held", i - 1)), 1).otherwise(0))
        ends = [F.element_at("_held", 1 if c.startswith("first") else -1)[c].alias(c) for c in BOUNDS]
        node = group.select(*keys, "_n", *ends, *sums, F.sha2(F.array_join(F.transform("_held", lambda x: x["digest"]), "\n"), 256).alias("digest"), (F.col("broken") + seams).alias("broken"))
    return node.drop("_n")


def require_whole(rolled: DataFrame) -> None:
    """Raise unless the chunks of every capture follow one another from its beginning."""
    bad = rolled.where("broken > 0").first()
    if bad:
        raise errors.IncompleteWindow(f"{bad['broken']} chunks of a capture do not follow the one before")


def rollup_digest(digests: DataFrame, order: list[str]) -> DataFrame:
    """One digest over all chunks' digests in order: a fold, as each step hashes the result before it.

    One short row per chunk is gathered: for the chunks of one capture. rollup_tree takes any number of them.
    """
    ordered = F.transform(F.sort_array(F.collect_list(F.struct(*order, "digest"))), lambda x: x["digest"])
    return digests.agg(F.aggregate(ordered, F.lit("").cast("string"), lambda acc, x: F.sha2(F.concat(acc, x), 256)).alias("digest"), F.count("*").alias("n_chunks"))
