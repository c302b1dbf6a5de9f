"""Streams that lose nothing: messages put in order by event time, bars that late rows correct, an end of input.

Both operators see every row, also those behind the watermark: the watermark is taken below them and its column is
not passed on, so Spark drops no row on their behalf. They use it as a clock only.

End of input is a row of its own, in a folder beside the input (`with_end`): it lies after all times, moves the
watermark there, and so all that is still held is released. `run_whole` runs a stream over the input, then over it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from decimal import Context
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom import errors
from tickloom.functions.time import MINUTE
from tickloom.session import shared_dir
from tickloom.streaming.ingest import CHECKED, classified_after, run_to_end

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: The time of the row that ends an input; rows of the input are earlier.
END = "9999-12-31 00:00:00"
ORDERED = CHECKED + ", late boolean"
MS = 1_000_000
#: Held messages that are classified at once.
CHUNK = 50_000
EXACT = Context(prec=76)
#: What a log says of a bar or a late row, after its keys.
ENTRY = ("bar_start_ms", "kind", "revision", "first_us", "first_arrival", "open", "high", "low", "close", "volume", "trade_count")
#: Bars whose state is kept together: those of so many bar starts in a row, and of keys of one of so many hash buckets.
#: Both, and the form of `LastingBars`' state, are part of a checkpoint: a stream goes on only with those it began with.
SPAN, BUCKETS = 32, 128


def stream_session(spark: SparkSession) -> SparkSession:
    """A session beside this one for streams with timers; settings of this one stay as they are."""
    own = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone", "spark.checkpoint.dir"):
        value = spark.conf.get(key, None)
        if value is not None and own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    return own


def with_end(events: DataFrame, time: str, folder: str) -> DataFrame:
    """A stream of events and of what `close_input` writes into folder."""
    spark = events.sparkSession
    ends = spark.readStream.schema("ended timestamp").parquet(folder)
    return events.union(ends.select(*[F.col("ended").alias(c) if c == time else F.lit(None).cast(events.schema[c].dataType).alias(c) for c in events.columns]))


def close_input(spark: SparkSession, folder: str) -> None:
    """Say that nothing more comes."""
    spark.range(1).select(F.lit(END).cast("timestamp").alias("ended")).coalesce(1).write.mode("append").parquet(folder)


def clocked(events: DataFrame, time: str, delay: str) -> DataFrame:
    """events under a watermark that follows time by delay, without the end's row; column time is a plain one after it."""
    marked = events.withColumn("_clock", F.col(time)).withWatermark("_clock", delay)
    # a condition on the clock stays above the watermark, which so has seen the end's row
    return marked.where(F.col("_clock").isNull() | (F.col("_clock") < F.lit(END).cast("timestamp"))).drop("_clock")


class InOrder(StatefulProcessor):
    """One source's messages, held back in stretches of arrival until the clock has passed them.

    State: the cursor with the first stretch that is not released yet, and the messages of each held stretch. A timer
    at a stretch's end releases it and all before it. A message of a released stretch is late: it is classified at
    once, against the cursor as it is by then.
    """

    def __init__(self, width: int):
        self.width = width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.cursor = handle.getValueState("cursor", "generation long, sequence long, frontier long")
        self.held = handle.getMapState("held", "stretch long", "generation array<long>, sequence array<long>, arrival array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = self.cursor.get() or (0, 0, -(2**62))
        for frame in rows:
            stretches = frame["arrival"].to_numpy(dtype=np.int64) // self.width
            late = stretches < state[2]
            if late.any():
                out, state = self._decided(key, frame[late], state, True)
                self.cursor.update(state)
                yield out
            for stretch, part in frame[~late].groupby(stretches[~late]):
                new = [part[c].astype("int64").tolist() for c in ("generation", "sequence", "arrival")]
                if self.held.containsKey((stretch,)):
                    new = [[*a, *b] for a, b in zip(self.held.getValue((stretch,)), new)]
                else:
                    self.handle.registerTimer(-(-(int(stretch) + 1) * self.width // MS))
                self.held.updateValue((int(stretch),), tuple(new))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # the first timer of a batch releases all that the clock has passed, so the held stretches are listed once a
        # batch; the other timers find theirs released
        due = expiredTimerInfo.getExpiryTimeInMs() * MS // self.width
        state = self.cursor.get() or (0, 0, -(2**62))
        if due <= state[2]:
            return
        passed, held = max(due, timerValues.getCurrentWatermarkInMs() * MS // self.width), []
        stretches = sorted(s for (s,) in self.held.keys() if s < passed)
        for stretch in stretches:
            held.append(self.held.getValue((stretch,)))
            self.held.removeKey((stretch,))
            if stretch == stretches[-1] or sum(len(h[0]) for h in held) >= CHUNK:
                frame = pd.DataFrame({c: np.concatenate([h[i] for h in held]).astype(np.int64) for i, c in enumerate(("generation", "sequence", "arrival"))})
                out, state = self._decided(key, frame, (*state[:2], stretch + 1), False)
                held = []
                yield out
        self.cursor.update((*state[:2], max(due, state[2])))

    def _decided(self, key, frame: pd.DataFrame, state: tuple, late: bool) -> tuple[pd.DataFrame, tuple]:
        # equal arrivals fall by generation and sequence, so the order of delivery does not show
        rows = frame.sort_values(["arrival", "generation", "sequence"], kind="stable")
        out, (generation, sequence) = classified_after(key, rows, state[:2])
        return out.assign(late=late), (generation, sequence, state[2])


def classify_in_order(events: DataFrame, delay: str, stretch_ns: int = MINUTE) -> DataFrame:
    """Decisions on (provider, feed, generation, sequence, arrival), arrival in ns, in order of arrival whatever the
    order of files and micro-batches, as long as none is more than delay behind; later ones have late set.

    Every message gives one row. State is what the last delay brought, and a cursor a source. events may be a stream
    made by `with_end` on a timestamp column at.
    """
    columns = ["provider", "feed", "generation", "sequence", "arrival"]
    timed = clocked(events.select("at", *columns), "at", delay).select(*columns)
    return timed.groupBy("provider", "feed").transformWithStateInPandas(InOrder(stretch_ns), ORDERED, "append", "eventTime")


class LastingBars(StatefulProcessor):
    """The bars of one group of keys over one span of time: each is built while it is open, published when the clock
    passes its end, corrected until `lateness` later.

    Rows that come after that are no part of any bar: they are given back one by one, as kind "late". State is one
    value, the group's bars as an Arrow stream that only this class reads, read and written once a micro-batch; one
    timer at a time is set, for the bar that is due first. Keys are texts or what else types says.
    """

    def __init__(self, keys: list[str], types: list[str], width_ms: int, lateness_ms: int):
        self.keys, self.types, self.width, self.lateness = keys, types, width_ms, lateness_ms
        self.entry = Row(*keys, *ENTRY)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "timer long, bars binary")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        return self._taken((((*(r[k] for k in self.keys), r.bar_start_ms), r.at_us, r.arrival, r.price, r.size) for r in rows), timerValues)

    def _taken(self, rows: Iterator[tuple], timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        (timer, bars), touched = self._read(), set()
        for at, us, arrival, price, size in rows:
            if now >= at[-1] + self.width + self.lateness:
                yield self._row(at, "late", us, arrival, (price, price, price, price, size, 1), 0)
                continue
            bars[at] = self._with(bars.get(at), us, arrival, price, size)
            touched.add(at)
        for at in touched:
            if now >= at[-1] + self.width:  # its time to be published has passed: a correction, or a bar that only now has rows
                bars[at] = (*bars[at][:-1], bars[at][-1] + 1)
                yield self._published(at, bars[at])
        if touched:
            self._write(timer, bars)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        _, bars = self._read()
        for at, bar in bars.items():
            if bar[-1] < 0 and now >= at[-1] + self.width:
                bars[at] = (*bar[:-1], 0)
                yield self._published(at, bars[at])
        self._write(None, {at: bar for at, bar in bars.items() if now < at[-1] + self.width + self.lateness})

    def _read(self) -> tuple[int | None, dict]:
        held, n = self.held.get(), len(self.keys) + 1
        if held is None:
            return None, {}
        columns = [c.to_pylist() for c in pa.ipc.open_stream(held[1]).read_all().columns]
        return held[0], {f[:n]: f[n:] for f in zip(*columns)}

    def _write(self, timer: int | None, bars: dict) -> None:
        if not bars:
            self.held.clear()
            return
        due = min(at[-1] + self.width + (self.lateness if bar[-1] >= 0 else 0) for at, bar in bars.items())
        if timer is None or due < timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)
            timer = due
        long, number = pa.int64(), pa.decimal128(38, 18)
        types = [pa.string() if t == "string" else None for t in self.types] + [long, long, long, number, number, number, long, long, number, number, long, long]
        columns = zip(*((*at, *bar) for at, bar in bars.items()))
        table = pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=[str(i) for i in range(len(types))])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        self.held.update((timer, sink.getvalue().to_pybytes()))

    @staticmethod
    def _with(bar: tuple | None, us: int, arrival: int, price, size) -> tuple:
        at = (us, arrival)
        if bar is None:
            return (*at, price, price, price, *at, price, size, 1, -1)
        first = bar[:3] if bar[:2] <= at else (*at, price)
        last = bar[5:8] if bar[5:7] > at else (*at, price)
        return (*first, max(bar[3], price), min(bar[4], price), *last, EXACT.add(bar[8], size), bar[9] + 1, bar[10])

    def _published(self, key, bar: tuple) -> Row:
        return self._row(key, "bar", bar[0], bar[1], (bar[2], bar[3], bar[4], bar[7], bar[8], bar[9]), bar[10])

    def _row(self, key, kind: str, at_us: int, arrival: int, values: tuple, revision: int) -> Row:
        return self.entry(*key, kind, revision, at_us, arrival, *values)


class LastingBarFrames(LastingBars):
    """LastingBars whose rows come and go as frames: a column is converted at once, not a field of a row at a time."""

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        return self._frames(self._taken((row for frame in rows for row in self._tuples(frame)), timerValues))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return self._frames(super().handleExpiredTimer(key, timerValues, expiredTimerInfo))

    def _tuples(self, frame: pd.DataFrame) -> Iterator[tuple]:
        # a null would have made the column one of floats: it fails here
        start, us, arrival = (frame[c].astype("int64").tolist() for c in ("bar_start_ms", "at_us", "arrival"))
        return zip(zip(*(frame[k].tolist() for k in self.keys), start), us, arrival, frame["price"].tolist(), frame["size"].tolist())

    def _frames(self, entries: Iterator[Row]) -> Iterator[pd.DataFrame]:
        while part := list(islice(entries, CHUNK)):
            yield pd.DataFrame(part, columns=[*self.keys, *ENTRY])


def _as_text(key: str, kind: str) -> Column:
    """A key as a text that `_of_text` turns back exactly; frames have no integers beside nulls."""
    k = F.col(key)
    return (F.hex(k) if kind == "binary" else F.unix_micros(k).cast("string") if kind == "timestamp" else k.cast("string")).alias(key)


def _of_text(key: str, kind: str) -> Column:
    k = F.col(key)
    return (F.unhex(k) if kind == "binary" else F.timestamp_micros(k.cast("long")) if kind == "timestamp" else k.cast(kind)).alias(key)


def lasting_bars(events: DataFrame, keys: list[str], delay: str, width_ms: int = 60_000, lateness_ms: int = 600_000) -> DataFrame:
    """A log of bars from (keys, at, arrival, price, size): kind "bar" with revision 0 when the watermark, delay behind
    the latest time, passes its end; a higher revision for each micro-batch that brings more of its rows within
    lateness_ms after that; kind "late" for each row that comes later still.

    The last revisions' trade_count and the late rows account for every input row (`final_bars`, `late_rows`), however
    the input is cut into files and batches. State is a bar's numbers, kept until its lateness has passed, for SPAN bar
    starts and a bucket of keys together: what a group costs beyond its rows does not grow with the number of bars.
    Prices and sizes are decimals, null rows break the contract.
    """
    number = "decimal(38,18)"
    start = F.floor(F.unix_millis("at") / width_ms) * width_ms
    rows = clocked(events.select("at", *keys, "arrival", "price", "size"), "at", delay).select(*keys, start.cast("long").alias("bar_start_ms"), F.unix_micros("at").alias("at_us"), "arrival", F.col("price").cast(number).alias("price"), F.col("size").cast(number).alias("size"))
    types = [rows.schema[k].dataType.simpleString() for k in keys]
    fields = "".join(f"{k} string, " for k in keys)
    made = f"{fields}bar_start_ms long, kind string, revision long, first_us long, first_arrival long, open {number}, high {number}, low {number}, close {number}, volume {number}, trade_count long"
    texts = [_as_text(k, t) for k, t in zip(keys, types)]
    span, bucket = F.floor(F.col("bar_start_ms") / (width_ms * SPAN)).alias("_span"), F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).alias("_bucket")
    grouped = rows.select(*texts, "bar_start_ms", "at_us", "arrival", "price", "size", span, bucket).groupBy("_span", "_bucket")
    log = grouped.transformWithStateInPandas(LastingBarFrames(keys, ["string"] * len(keys), width_ms, lateness_ms), made, "append", "eventTime")
    return log.select(*[_of_text(k, t) for k, t in zip(keys, types)], *ENTRY)


def _start() -> Column:
    return F.timestamp_millis("bar_start_ms").alias("bar_start")


def final_bars(log: DataFrame, keys: list[str]) -> DataFrame:
    """The last revision of every bar of a log."""
    names = ["open", "high", "low", "close", "volume", "trade_count"]
    last = log.where("kind = 'bar'").groupBy(*keys, "bar_start_ms").agg(F.max_by(F.struct("revision", *names), "revision").alias("_last"))
    return last.select(*keys, _start(), "_last.*")


def late_rows(log: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of a log that came after their bar's lateness."""
    return log.where("kind = 'late'").select(*keys, _start(), F.timestamp_micros("first_us").alias("at"), F.col("first_arrival").alias("arrival"), F.col("open").alias("price"), F.col("volume").alias("size"))


def run_whole(spark: SparkSession, events, time: str, made, root: str | None = None) -> DataFrame:
    """What made gives of a stream when it is run over all that is there and then over the end of input, as a table.

    events: session -> stream; made: stream -> stream. The second run goes on from the first one's checkpoint; a run
    that was cut short is repeated from its last batch, so nothing is lost or doubled.
    """
    root = root or f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    own = stream_session(spark)
    own.createDataFrame([], "ended timestamp").write.mode("ignore").parquet(f"{root}/end")
    stream = made(with_end(events(own), time, f"{root}/end"))
    run_to_end(stream, f"{root}/rows", f"{root}/checkpoint")
    close_input(own, f"{root}/end")
    run_to_end(stream, f"{root}/rows", f"{root}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{root}/rows")


def require_all(log: DataFrame, n_rows: int) -> None:
    """Raise unless the last revisions and the late rows account for n_rows input rows."""
    keys = [c for c in log.columns[: log.columns.index("bar_start_ms")]]
    counted = final_bars(log, keys).agg(F.sum("trade_count")).first()[0] or 0
    late = log.where("kind = 'late'").count()
    if counted + late != n_rows:
        raise errors.IncompleteWindow(f"{n_rows} rows came in, {counted} are in bars and {late} are late")
