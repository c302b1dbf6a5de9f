"""Streams cut into files in any way, in any order: the same rows, and none lost."""

import os
import random
from collections import Counter
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom import errors
from tickloom.operators import sequence
from tickloom.streaming import ordered
from tickloom.streaming.ingest import read_events

START = 1_791_466_200
MESSAGE = "provider string, feed string, generation long, sequence long, arrival long, at timestamp"
TRADE = "symbol string, at timestamp, arrival long, price decimal(18,4), size decimal(18,4)"


def written(rows, n_files, folder, seed):
    """rows dealt to n_files files that a stream reads in a random order."""
    files = rows.repartition(n_files, F.xxhash64(*rows.columns, F.lit(seed))) if n_files > 1 else rows.coalesce(1)
    files.write.parquet(folder)
    names = [f"{folder}/{f}" for f in os.listdir(folder) if f.endswith(".parquet")]
    random.Random(seed).shuffle(names)
    for i, name in enumerate(names):
        os.utime(name, (START + i, START + i))
    return folder


def messages(spark, n=400):
    rng = random.Random(4)
    rows = [("p", f"f{rng.randint(0, 2)}", 1 + i // 150, rng.randint(1, 90), (START + 7 * i) * 10**9) for i in range(n)]
    rows += [("p", None, 1, i, (START + i) * 10**9) for i in (1, 2, 5)]
    return spark.createDataFrame(rows, MESSAGE.removesuffix(", at timestamp")).withColumn("at", F.timestamp_micros((F.col("arrival") / 1000).cast("long")))


def decisions(rows):
    return Counter((r.feed, r.generation, r.sequence, r.arrival, r.decision, r.missing_first, r.missing_last) for r in rows.collect())


def in_order(spark, folder, delay, per_trigger=3):
    return ordered.run_whole(spark, lambda s: read_events(s, f"file://{folder}", MESSAGE, per_trigger), "at", lambda e: ordered.classify_in_order(e, delay))


@pytest.mark.parametrize("n_files", [1, 9])
def test_messages_are_classified_in_order_of_arrival(spark, tmp_path, n_files):
    rows = messages(spark)
    want = decisions(sequence.classify(rows, ["provider", "feed"], "arrival").where("feed is not null")) + decisions(sequence.classify(rows.where("feed is null").withColumn("feed", F.lit("x")), ["feed"], "arrival").withColumn("feed", F.lit(None).cast("string")))
    got = in_order(spark, written(rows, n_files, f"{tmp_path}/in", n_files), "2 hours")
    assert decisions(got) == want and got.where("late").count() == 0


def test_messages_behind_the_delay_are_late_and_not_lost(spark, tmp_path):
    rows = messages(spark)
    got = in_order(spark, written(rows, 9, f"{tmp_path}/in", 5), "30 seconds", 1)
    key = lambda t: Counter((r.feed, r.generation, r.sequence, r.arrival) for r in t.collect())
    assert key(got) == key(rows) and 0 < got.where("late").count() < rows.count()


def trades(spark, n=500):
    rng = random.Random(9)
    rows = [(rng.choice("ab"), i, Decimal(rng.randint(1, 9999)) / 100, Decimal(rng.randint(1, 50)), START + rng.randint(0, 3600)) for i in range(n)]
    return spark.createDataFrame(rows, "symbol string, arrival long, price decimal(18,4), size decimal(18,4), s long").select("symbol", F.timestamp_seconds("s").alias("at"), "arrival", "price", "size")


def plain_bars(rows):
    bars = {}
    for r in sorted(rows, key=lambda r: (r.at, r.arrival)):
        start = r.at.replace(second=0)
        o, h, low, _, v, n = bars.get((r.symbol, start), (r.price, r.price, r.price, None, 0, 0))
        bars[r.symbol, start] = (o, max(h, r.price), min(low, r.price), r.price, v + r.size, n + 1)
    return bars


def logged(spark, folder, delay, lateness_ms, per_trigger=2):
    return ordered.run_whole(spark, lambda s: read_events(s, f"file://{folder}", TRADE, per_trigger), "at", lambda e: ordered.lasting_bars(e, ["symbol"], delay, 60_000, lateness_ms))


@pytest.mark.parametrize("n_files, delay, lateness_ms", [(1, "0 seconds", 0), (8, "2 hours", 0), (8, "0 seconds", 7_200_000)])
def test_bars_are_whole_for_any_files(spark, tmp_path, n_files, delay, lateness_ms):
    rows = trades(spark)
    log = logged(spark, written(rows, n_files, f"{tmp_path}/in", 2), delay, lateness_ms)
    got = {(r.symbol, r.bar_start): (r.open, r.high, r.low, r.close, r.volume, r.trade_count) for r in ordered.final_bars(log, ["symbol"]).collect()}
    assert got == plain_bars(rows.collect())
    assert ordered.late_rows(log, ["symbol"]).count() == 0
    ordered.require_all(log, 500)
    if lateness_ms:  # published early, corrected by later files
        assert log.agg(F.max("revision")).first()[0] > 0


def test_rows_after_the_lateness_come_out_as_late(spark, tmp_path):
    rows = trades(spark)
    log = logged(spark, written(rows, 8, f"{tmp_path}/in", 3), "1 minute", 120_000, 1)
    late = ordered.late_rows(log, ["symbol"]).collect()
    by_arrival = {r.arrival: r for r in rows.collect()}
    assert 0 < len(late) < 500
    assert all((r.symbol, r.at, r.price, r.size) == (by_arrival[r.arrival].symbol, by_arrival[r.arrival].at, by_arrival[r.arrival].price, by_arrival[r.arrival].size) for r in late)
    gone = {r.arrival for r in late}
    got = {(r.symbol, r.bar_start): (r.open, r.high, r.low, r.close, r.volume, r.trade_count) for r in ordered.final_bars(log, ["symbol"]).collect()}
    assert got == plain_bars([r for i, r in by_arrival.items() if i not in gone])
    ordered.require_all(log, 500)
    with pytest.raises(errors.IncompleteWindow):
        ordered.require_all(log, 501)


@pytest.mark.parametrize("name", ["stream_bars_to_end", "stream_sequence"])
def test_queries_give_the_same_rows_for_one_file_and_for_many(spark, sf, tmp_path, name):
    from tickloom.queries_contracts import QUERIES

    events = spark.read.parquet(f"{sf}/events.parquet")
    written(events, 6, f"{tmp_path}/events.parquet", 8)
    want, got = (Counter(map(tuple, QUERIES[name](spark, d).collect())) for d in (sf, f"file://{tmp_path}"))
    assert want and got == want


def test_held_stretches_are_listed_once_a_batch():
    class Handle:
        def __init__(self):
            self.values, self.listed = {}, 0

        def keys(self):
            self.listed += 1
            return iter([(s,) for s in self.values])

        def getValue(self, key):
            return self.values[key[0]]

        def removeKey(self, key):
            del self.values[key[0]]

        def get(self):
            return self.values.get("cursor")

        def update(self, value):
            self.values["cursor"] = value

    class At:
        def __init__(self, ms):
            self.getExpiryTimeInMs = self.getCurrentWatermarkInMs = lambda: ms

    op = ordered.InOrder(10**9)
    op.cursor, op.held = Handle(), Handle()
    op.held.values = {s: ([1, 1], [2 * s + 2, 2 * s + 1], [s * 10**9 + 5, s * 10**9]) for s in range(300)}
    out = [f for s in range(250) for f in op.handleExpiredTimer(("p", "f"), At(250_000), At((s + 1) * 1000))]
    got = [(r.sequence, r.decision) for f in out for r in f.itertuples()]
    assert got == [(i, "accept") for i in range(1, 501)] and op.held.listed == 1
    assert sorted(op.held.values) == list(range(250, 300)) and op.cursor.get()[2] == 250


def test_state_of_many_bars_is_read_and_written_once_a_batch():
    class Held:
        value, gets, puts, timers = None, 0, 0, ()

        def get(self):
            self.gets += 1
            return self.value

        def update(self, value):
            self.value, self.puts = value, self.puts + 1

        def clear(self):
            self.value = None

        def registerTimer(self, at):
            self.timers = (*self.timers, at)

        def deleteTimer(self, at):
            self.timers = tuple(t for t in self.timers if t != at)

    class At:
        def __init__(self, ms, now=None):
            self.getExpiryTimeInMs, self.getCurrentWatermarkInMs = lambda: ms, lambda: ms if now is None else now

    class Trade(dict):
        __getattr__ = dict.__getitem__

    trade = lambda i, at: Trade(symbol=f"s{i % 50}", bar_start_ms=at // 1000 * 1000, at_us=at * 1000, arrival=i, price=Decimal(i), size=Decimal(1))
    op = ordered.LastingBars(["symbol"], ["string"], 1000, 5000)
    op.held = op.handle = state = Held()
    assert list(op.handleInputRows((0, 0), iter([trade(i, 1000 * (i % 4) + 10) for i in range(400)]), At(0))) == []
    assert (state.gets, state.puts, state.timers) == (1, 1, (1000,))
    state.timers = ()
    first = list(op.handleExpiredTimer((0, 0), At(2000), At(1000)))
    # 100 bars of 4 rows, half of them of the even symbols' two starts; the next one is due at 3000
    assert {(r.kind, r.revision, r.trade_count) for r in first} == {("bar", 0, 4)} and {r.bar_start_ms for r in first} == {0, 1000}
    assert (state.gets, state.puts, state.timers) == (2, 2, (3000,))
    corrected = list(op.handleInputRows((0, 0), iter([trade(0, 10), trade(2, 2010)]), At(2000)))
    assert [(r.symbol, r.bar_start_ms, r.revision, r.trade_count) for r in corrected] == [("s0", 0, 1, 5)] and state.timers == (3000,)
    state.timers = ()
    last = list(op.handleExpiredTimer((0, 0), At(9000), At(3000)))
    assert {r.bar_start_ms for r in last} == {2000, 3000} and sum(r.trade_count for r in first + last) == 401
    assert state.value is None and state.timers == ()
    late = list(op.handleInputRows((0, 0), iter([trade(7, 10)]), At(9000)))
    assert [(r.kind, r.symbol, r.first_arrival) for r in late] == [("late", "s7", 7)] and state.value is None


def test_rows_and_bars_of_a_group_pass_as_frames():
    # fields of rows were converted one at a time, and those of the state's bars by Spark's rows, which took most of a large batch's time
    class Held:
        value = None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

        def clear(self):
            self.value = None

        def registerTimer(self, at):
            self.timer = at

        def deleteTimer(self, at):
            self.timer = None

    class At:
        def __init__(self, ms):
            self.getExpiryTimeInMs = self.getCurrentWatermarkInMs = lambda: ms

    op = ordered.LastingBarFrames(["symbol"], ["string"], 1000, 5000)
    op.held = op.handle = state = Held()
    n, half = 6000, Decimal("0.5").quantize(Decimal(1).scaleb(-18))
    frame = pd.DataFrame({"symbol": [None if i % 100 == 99 else f"s{i % 100}" for i in range(n)], "bar_start_ms": [i // 200 * 1000 for i in range(n)], "at_us": [i * 5000 for i in range(n)], "arrival": range(n), "price": [Decimal(i) for i in range(n)], "size": [half] * n})
    assert list(op.handleInputRows((0, 0), iter([frame[:4000], frame[4000:]]), At(0))) == []
    timer, bars = state.value
    assert timer == 1000 and isinstance(bars, bytes) and len(bars) < 3000 * 200  # 3,000 bars of two rows
    (made,) = op.handleExpiredTimer((0, 0), At(12_000), At(12_000))
    assert len(made) == 12 * 100 and set(zip(made["kind"], made["revision"], made["trade_count"], made["volume"])) == {("bar", 0, 2, Decimal(1))}
    assert made["symbol"].isna().sum() == 12 and state.timer == 13_000  # bars of 7000 to 11000 are kept for corrections, the first of them until then
    late, corrected = (list(op.handleInputRows((0, 0), iter([frame[i : i + 1]]), At(12_000))) for i in (0, 2200))
    assert [f["kind"].tolist() for f in late] == [["late"]] and [(f["revision"][0], f["trade_count"][0]) for f in corrected] == [(1, 3)]
    with pytest.raises(ValueError):
        list(op.handleInputRows((0, 0), iter([frame[:2].assign(arrival=[1, None])]), At(0)))


def test_keys_of_bars_come_back_as_they_were(spark, tmp_path):
    keys = {"n": "bigint", "b": "binary", "t": "timestamp", "d": "decimal(38,18)", "f": "double"}
    rows = spark.range(40).selectExpr(
        "if(id % 4 = 0, null, 9007199254740993 + id % 4) as n", "if(id % 4 = 1, null, unhex(concat('FF0', id % 4))) as b", "timestamp_micros(1700000000123456 + id % 4) as t", "cast(id % 4 as decimal(38,18)) / 7 as q", "0.1D + id % 4 as f",
        "timestamp_micros(1700000000000000 + id * 1000000) as at", "id as arrival", "cast(id as decimal(18,4)) as price", "cast(1 as decimal(38,18)) as size",
    ).withColumn("d", F.col("q").cast("decimal(38,18)")).drop("q")
    folder = written(rows, 2, f"{tmp_path}/in", 4)
    log = ordered.run_whole(spark, lambda own: read_events(own, folder, rows.schema, 1), "at", lambda r: ordered.lasting_bars(r, list(keys), "1 hour", 3_600_000, 3_600_000), f"{tmp_path}/run")
    assert {k: log.schema[k].dataType.simpleString() for k in keys} == keys
    got = {tuple(r)[:-1]: r.trade_count for r in ordered.final_bars(log, list(keys)).select(*keys, "trade_count").collect()}
    assert got == {tuple(r): 10 for r in rows.select(*keys).distinct().collect()}
