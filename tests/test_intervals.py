"""Interval operators against sets of points."""

import random

import pytest

from tickloom.functions.market import MAPPING_PRIORITY, RESPONSE_PRIORITY
from tickloom.functions.time import DAY
from tickloom.operators import intervals as I

TOP = 60


def random_intervals(seed, n=120, keys=5):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a = rng.randint(0, TOP - 2)
        out.append((rng.randint(0, keys - 1), i, a, rng.randint(a + 1, min(TOP, a + 12)), rng.choice(MAPPING_PRIORITY)))
    return out


SCHEMA = "key int, id int, start long, end long, reason string"


@pytest.mark.parametrize("order", [MAPPING_PRIORITY, RESPONSE_PRIORITY])
@pytest.mark.parametrize("seed", [1, 2])
def test_normalize(spark, order, seed):
    rows = random_intervals(seed)
    got = {}
    for r in I.normalize_gaps(spark.createDataFrame(rows, SCHEMA), ["key"], order).collect():
        for t in range(r.start, r.end):
            assert (r.key, t) not in got
            got[r.key, t] = r.reason
    want = {}
    for k, _, a, b, reason in rows:
        for t in range(a, b):
            old = want.get((k, t))
            want[k, t] = reason if old is None or order.index(reason) < order.index(old) else old
    assert got == want


def test_normalize_is_minimal(spark):
    rows = [(1, 1, 0, 5, "unknown"), (1, 2, 5, 9, "unknown"), (1, 3, 9, 12, "source_gap")]
    got = sorted((r.start, r.end, r.reason) for r in I.normalize_gaps(spark.createDataFrame(rows, SCHEMA), ["key"], MAPPING_PRIORITY).collect())
    assert got == [(0, 9, "unknown"), (9, 12, "source_gap")]


def test_merge_keeps_touching_apart(spark):
    rows = [(1, 1, 0, 5, "source_gap"), (1, 2, 5, 9, "excluded"), (1, 3, 8, 12, "excluded")]
    got = sorted((r.start, r.end, r.reason) for r in I.merge_overlapping(spark.createDataFrame(rows, SCHEMA), ["key"]).collect())
    assert got == [(0, 5, "source_gap"), (5, 12, "unknown")]


@pytest.mark.parametrize("seed", [3, 4])
def test_uncovered(spark, seed):
    covers, windows = random_intervals(seed, 25, 4), random_intervals(seed + 10, 30, 5)
    got = {}
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    for r in I.uncovered(frame(windows).drop("reason"), frame(covers), ["key"], ["id"]).collect():
        got.setdefault((r.key, r.id), set()).update(range(r.start, r.end))
    for k, i, a, b, _ in windows:
        want = set(range(a, b)) - {t for c in covers if c[0] == k for t in range(c[2], c[3])}
        assert got.get((k, i), set()) == want


def test_conflicts(spark):
    rows = random_intervals(6, 60, 8)
    got = {r.id for r in I.conflicts(spark.createDataFrame(rows, SCHEMA), ["key"], "id").collect()}
    assert got == {a[1] for a in rows for b in rows if a[1] != b[1] and a[0] == b[0] and a[2] < b[3] and b[2] < a[3]}


def test_containment_and_as_of(spark):
    h = DAY // 24
    slices = spark.createDataFrame([("a", 0, 30 * h), ("b", 30 * h, 40 * h), ("c", 35 * h, 50 * h)], "name string, start long, end long")
    rows = spark.createDataFrame([(1, 0, h), (2, 29 * h, 31 * h), (3, 36 * h, 37 * h), (4, 25 * h, 30 * h), (5, 41 * h, 50 * h)], "id int, start long, end long")
    assert {r.id: r.name for r in I.contained_in_one(rows, slices, ["name"]).collect()} == {1: "a", 2: None, 3: None, 4: "a", 5: "c"}
    at = spark.createDataFrame([(1, -1), (2, 0), (3, 29 * h), (4, 30 * h), (5, 400 * h)], "id int, at long")
    got = {r.id: r.name for r in I.latest_before(at, slices.select("start", "name"), "at", ["name"]).collect()}
    assert got == {1: None, 2: "a", 3: "a", 4: "b", 5: "c"}


def test_bars_outside_gaps(spark):
    h = DAY // 24
    bars = spark.createDataFrame([(1, i * h, (i + 1) * h) for i in range(48)], "key int, start long, end long")
    gaps = spark.createDataFrame([(1, 20 * h + 5, 26 * h), (2, 0, 48 * h)], "key int, start long, end long")
    kept = {r.start // h for r in I.outside(bars, gaps, ["key"], ["start", "end"]).collect()}
    assert kept == set(range(48)) - set(range(20, 26))


@pytest.mark.parametrize(("bars", "want"), [
    ([(0, 60), (60, 120), (120, 150)], True), ([(0, 60), (120, 150)], False), ([(60, 120), (120, 150)], False), ([(0, 60), (60, 120)], False), ([(0, 30), (30, 90), (90, 150)], False), ([], False),
])
def test_tiling(spark, bars, want):
    frame = spark.createDataFrame([(1, a, b) for a, b in bars], "key int, start long, end long")
    phases = spark.createDataFrame([(1, 0, 150)], "key int, phase_start long, phase_end long")
    (row,) = I.tiling(frame, phases, ["key"], 60).collect()
    assert (row.complete, row.n_bars) == (want, len(bars))


def test_spread_intervals_are_not_broadcast(spark):
    # a year is 24 stretches in two rows' worth of estimated size; only small tables without keys may be broadcast
    years = spark.range(1000).selectExpr("id as key", "0L as start", f"{365 * DAY}L as end")
    gaps = spark.range(1000).selectExpr("id as key", f"id * {DAY} as start", f"(id + 2) * {DAY} as end", "'unknown' as reason")
    covers = gaps.withColumnsRenamed({"start": "_cs", "end": "_ce"})
    for made in (I.overlapping(years, covers, ["key"]), I.clip_to(gaps, years, ["key"]), I.coverage_status(years, gaps, ["key"])):
        plan = made._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin [key" not in plan


def test_normalize_sorts_boundaries_once_and_joins_nothing(spark):
    # open counts of earlier stretches come ahead of a stretch's boundaries as rows; a join sorted all boundaries three times over in one task
    gaps = spark.createDataFrame([(1, 1, 0, 400 * DAY, "unknown"), (1, 2, 40 * DAY, 41 * DAY, "source_gap"), (1, 3, 400 * DAY, 401 * DAY, "unknown"), (1, 4, 5, 9, None), (2, 5, 7, 7, "unknown")], SCHEMA.replace("int", "long"))
    made = I.normalize_gaps(gaps, ["key"], MAPPING_PRIORITY)
    plan = made._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan
    got = sorted((r.key, r.start, r.end, r.reason) for r in made.collect())
    assert got == [(1, 0, 40 * DAY, "unknown"), (1, 40 * DAY, 41 * DAY, "source_gap"), (1, 41 * DAY, 401 * DAY, "unknown")]


def test_normalize_takes_more_tasks_for_more_gaps(spark, monkeypatch):
    # the number of tasks was the session's, so a task's memory grew with the gaps
    from tickloom import session

    monkeypatch.setattr(session, "ROWS_A_TASK", 40, raising=False)
    rows = random_intervals(7, 400)
    made = {n: I.normalize_gaps(spark.createDataFrame(rows[:n], SCHEMA), ["key"], MAPPING_PRIORITY) for n in (200, 400)}
    held = {n: 2 * sum(r[2] < r[3] for r in rows[:n]) for n in made}
    assert {n: m.rdd.getNumPartitions() for n, m in made.items()} == {n: -(-h // 40) for n, h in held.items()}
    monkeypatch.undo()
    assert sorted(map(tuple, made[400].collect())) == sorted(map(tuple, I.normalize_gaps(spark.createDataFrame(rows, SCHEMA), ["key"], MAPPING_PRIORITY).collect()))
