"""The streaming slice: sequence checks with state, bars with a watermark, late rows apart."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickloom import errors
from tickloom.operators.sequence import gap_ledger
from tickloom.session import shared_dir

CHECKED = "provider string, feed string, generation long, sequence long, arrival long, decision string, missing_first long, missing_last long"
CURSOR = "generation long, sequence long"
#: Sources of one stream.
MOST_SOURCES = 64


def read_events(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 16) -> DataFrame:
    """A stream over a folder to which files are only added."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def classified_after(key: tuple, rows: pd.DataFrame, cursor: tuple[int, int]) -> tuple[pd.DataFrame, tuple[int, int]]:
    """Decisions on one source's messages in the order given, from a cursor, and the cursor after them.

    Accepted states only grow, so the state before a message is a running maximum, taken over all at once.
    """
    seen = np.concatenate([[cursor], rows[["generation", "sequence"]].to_numpy()]).astype(np.int64)
    states, rank = np.unique(seen, axis=0, return_inverse=True)
    top = np.maximum.accumulate(rank.ravel())
    g, s = states[top[:-1]].T
    generation, sequence = seen[1:].T
    decision = np.select([generation < g, generation > g, sequence <= s, sequence > s + 1], ["stale_generation", "accept", "duplicate_or_reordered", "gap"], "accept")
    gap = pd.Series(decision == "gap")
    out = pd.DataFrame({
        "provider": key[0], "feed": key[1], "generation": generation, "sequence": sequence, "arrival": rows["arrival"].to_numpy(), "decision": decision,
        "missing_first": pd.Series(s + 1, dtype="Int64").where(gap), "missing_last": pd.Series(sequence - 1, dtype="Int64").where(gap),
    })
    return out, tuple(int(x) for x in states[top[-1]])


def _advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Classify one source's messages of a micro-batch, from the cursor that the last one left."""
    out, cursor = classified_after(key, pd.concat(list(frames)).sort_values("arrival", kind="stable"), state.get if state.exists else (0, 0))
    state.update(cursor)
    yield out


def classify_stream(events: DataFrame) -> DataFrame:
    """Decisions on a stream of (provider, feed, generation, sequence, arrival) as it is delivered: in order of arrival
    within a micro-batch, not across them (`ordered.classify_in_order` does that). State is one cursor a source."""
    return events.select("provider", "feed", "generation", "sequence", "arrival").groupBy("provider", "feed").applyInPandasWithState(_advance, CHECKED, CURSOR, "append", GroupStateTimeout.NoTimeout)


def stream_bars(events: DataFrame, time: str, keys: list[str], width: str = "1 minute", lateness: str = "10 minutes") -> DataFrame:
    """Tumbling bars of a stream, emitted once their window is closed by the watermark.

    events: time, arrival, price and size as decimals. Rows behind the watermark change no bar.
    """
    order = F.struct(time, "arrival")
    bars = events.withWatermark(time, lateness).groupBy(*keys, F.window(time, width)).agg(
        F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"), F.sum("size").alias("volume"), F.count("*").alias("trade_count"),
    )
    return bars.select(*keys, F.col("window.start").alias("bar_start"), "open", "high", "low", "close", "volume", "trade_count")


def split_late(events: DataFrame, time: str, keys: list[str], published: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A batch's rows that are in time, and those whose bar (keys, bar_start) is published already."""
    bar = F.window(time, "1 minute")["start"]
    marked = events.withColumn("bar_start", bar)
    done = published.select(*keys, "bar_start").distinct()
    return marked.join(done, [*keys, "bar_start"], "left_anti"), marked.join(done, [*keys, "bar_start"], "left_semi")


def run_to_end(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process all that is there and stop: end of input is evidence of completeness, a watermark is not."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def collected(stream: DataFrame) -> DataFrame:
    """What a stream gives when it is run to its end, as a table in the shared folder."""
    spark, root = stream.sparkSession, f"{shared_dir(stream.sparkSession)}/stream-{uuid.uuid4().hex}"
    run_to_end(stream, f"{root}/rows", f"{root}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{root}/rows")


def persist(checked: DataFrame, root: str, checkpoint: str) -> None:
    """Write a classified stream's batches, ledger first, each under its own epoch.

    A batch that is repeated after a failure overwrites its own folder, so every message is kept exactly once.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        sources = batch.select("provider", "feed").distinct().limit(MOST_SOURCES + 1).count()
        if sources > MOST_SOURCES:
            raise errors.InputLimit(f"more than {MOST_SOURCES} sources")
        gap_ledger(batch).write.mode("overwrite").parquet(f"{root}/ledger/epoch={epoch}")
        batch.where("decision in ('accept', 'gap')").write.mode("overwrite").parquet(f"{root}/messages/epoch={epoch}")

    query = checked.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def newest(log: DataFrame, order: str, most: int = 128) -> DataFrame:
    """The last entries of an append-only log."""
    return log.orderBy(F.col(order).desc()).limit(most)
