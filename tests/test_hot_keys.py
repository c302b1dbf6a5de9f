"""Sweeps and ordered checks on one key that holds everything, and on null keys, against plain Python."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tickloom import errors
from tickloom.functions.market import MAPPING_PRIORITY
from tickloom.functions.time import DAY, HOUR
from tickloom.operators import intervals as I
from tickloom.operators import pairs, reconcile, sequence, stretches
from tickloom.plans import sessions
from tickloom.sources import research

BASE = 1_600_000_000_000_000_000
GAP = "key string, id int, start long, end long, reason string"


def gap_rows(n=260, seed=3):
    rng, rows = random.Random(seed), []
    for i in range(n):
        start = BASE + rng.randint(0, 400) * DAY + rng.randint(0, 3) * HOUR
        rows.append((rng.choice(["hot"] * 8 + ["a", None]), i, start, start + rng.choice([0, HOUR, DAY, 3 * DAY, 70 * DAY if i % 40 == 0 else DAY]), rng.choice(MAPPING_PRIORITY)))
    return rows


def of_key(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def plain_normal(rows):
    cuts, out = sorted({t for r in rows if r[2] < r[3] for t in r[2:4]}), []
    for a, b in zip(cuts, cuts[1:]):
        found = [r[4] for r in rows if r[2] <= a and r[3] >= b]
        if found:
            top = min(found, key=MAPPING_PRIORITY.index)
            if out and out[-1][1] == a and out[-1][2] == top:
                out[-1] = (out[-1][0], b, top)
            else:
                out.append((a, b, top))
    return out


def test_sweeps_on_one_key(spark):
    rows = gap_rows()
    gaps, keyed = spark.createDataFrame(rows, GAP), of_key(rows)
    assert len({r[2] // I.GRAIN for r in keyed["hot"]}) > 10
    got = Counter((r.key, r.start, r.end, r.reason) for r in I.normalize_gaps(gaps, ["key"], MAPPING_PRIORITY).collect())
    assert got == Counter((k, *g) for k, part in keyed.items() for g in plain_normal(part))
    real = [r for r in rows if r[2] < r[3]]
    bad = {r[1] for r in real for o in real if r[0] == o[0] and r[1] != o[1] and r[2] < o[3] and o[2] < r[3]}
    assert {r.id for r in I.conflicts(gaps.where("start < end"), ["key"], "id").collect()} == bad
    merged, want = I.merge_overlapping(gaps.where("start < end"), ["key"]).collect(), Counter()
    for k, part in of_key(real).items():
        block = []
        for r in sorted(part, key=lambda r: (r[2], r[3])):
            if block and r[2] >= max(x[3] for x in block):
                want[k, block[0][2], max(x[3] for x in block), block[0][4] if len(block) == 1 else "unknown"] += 1
                block = []
            block.append(r)
        want[k, block[0][2], max(x[3] for x in block), block[0][4] if len(block) == 1 else "unknown"] += 1
    assert Counter((r.key, r.start, r.end, r.reason) for r in merged) == want


def test_one_window_with_all_covers(spark):
    rows = [r for r in gap_rows(seed=4) if r[0] == "hot" and r[2] < r[3]]
    window = ("hot", BASE - DAY, BASE + 500 * DAY)
    bare, cursor = [], window[1]
    for r in sorted(rows, key=lambda r: r[2]):
        if r[2] > cursor:
            bare.append((cursor, r[2]))
        cursor = max(cursor, r[3])
    bare.append((cursor, window[2]))
    got = I.uncovered(spark.createDataFrame([window], "key string, start long, end long"), spark.createDataFrame(rows, GAP), ["key"], []).collect()
    assert sorted((r.start, r.end) for r in got) == bare
    bars = [("hot", BASE + i * DAY, BASE + (i + 1) * DAY) for i in range(300) if i not in (70, 200)]
    phases = [("hot", BASE + a * DAY, BASE + b * DAY) for a, b in ((0, 60), (60, 120), (120, 180), (180, 240), (240, 300), (300, 310))]
    tiled = I.tiling(spark.createDataFrame(bars, "key string, start long, end long"), spark.createDataFrame(phases, "key string, phase_start long, phase_end long"), ["key"], DAY)
    assert {(r.phase_start - BASE) // DAY: (r.n_bars, r.complete) for r in tiled.collect()} == {0: (60, True), 60: (59, False), 120: (60, True), 180: (59, False), 240: (60, True), 300: (0, False)}


def test_order_on_one_key(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["hot"] * 9 + [None]), i * 10, 1 + i // 70, rng.randint(i // 2, i)) for i in range(300)]
    df = spark.createDataFrame(rows, "key string, arrival long, generation long, sequence long")
    bad, runs, sums = Counter(), [], Counter()
    for k, part in of_key(rows).items():
        bad.update(b for a, b in zip(part, part[1:]) if a[2:] >= b[2:])
        sources = [(r[3] % 3, r[1]) for r in part if r[3] % 5]
        for n, (s, at) in enumerate(sources):
            if n == 0 or sources[n - 1][0] != s:
                runs.append([k, s, at, at, 0])
            runs[-1][3:] = [at, runs[-1][4] + 1]
        total = 0
        for r in part:
            total += r[3]
            sums[k, r[1], total] += 1
    for width in (1, 130, None):
        assert Counter(map(tuple, sequence.not_increasing(df, ["key"], "arrival", width).collect())) == bad
        got = sessions.runs(df.withColumn("source", F.col("sequence") % 3), ["key"], "arrival", "source", F.col("sequence") % 5 != 0, width).collect()
        assert Counter((r.key, r.source, r.first, r.last, r.n_slices) for r in got) == Counter(map(tuple, runs))
        if width:
            summed = stretches.with_running_sum(df, ["key"], F.floor(F.col("arrival") / width), ["arrival"], F.col("sequence"), "total")
            assert Counter((r.key, r.arrival, r.total) for r in summed.collect()) == sums
    days = spark.createDataFrame([("A", i, f"2024-01-{d:02d}") for i, d in enumerate([1, 2, 2, 3, 9, 8, 10])], "symbol string, o long, event_ts_utc string")
    assert sorted(r.o for r in research.out_of_order(days, "o", 2).collect()) == sorted(r.o for r in research.out_of_order(days, "o").collect()) == [2, 5]
    verdicts = reconcile.session_verdicts(spark.createDataFrame([("a", "equal"), ("b", "equal")], "s string, status string"), "s").collect()
    assert len(verdicts) == 2 and not any(r.batch_rejected for r in verdicts)


CHUNK = "capture string, generation long, first long, last long, n_frames long, digest string"


def chunk_rows(capture, n, per=5):
    rows, generation, number = [], 1, 1
    for i in range(n):
        if i and i % 11 == 0:
            generation, number = generation + 1, 1
        rows.append((capture, generation, number, number + per - 1, per, hashlib.sha256(f"{capture}{i}".encode()).hexdigest()))
        number += per
    return rows


@pytest.mark.parametrize("n, fan", [(1, 4), (4, 4), (5, 4), (70, 4)])
def test_rollup_ends_in_one_row_of_a_capture(spark, n, fan):
    rows = chunk_rows("c", n) + chunk_rows(None, 2)
    random.Random(1).shuffle(rows)
    got = {r.capture: r for r in pairs.rollup(spark.createDataFrame(rows, CHUNK), ["capture"], ["n_frames"], fan, 7).collect()}
    level = [r[5] for r in chunk_rows("c", n)]
    while True:
        level = [hashlib.sha256("\n".join(level[i : i + fan]).encode()).hexdigest() for i in range(0, len(level), fan)]
        if len(level) == 1:
            break
    last = chunk_rows("c", n)[-1]
    c = got["c"]
    assert len(got) == 2 and (c.n_chunks, c.n_frames, c.digest, c.broken) == (n, 5 * n, level[0], 0)
    assert (c.first_generation, c.first_number, c.last_generation, c.last_number) == (1, 1, last[1], last[3])
    pairs.require_whole(pairs.rollup(spark.createDataFrame(rows, CHUNK), ["capture"], ["n_frames"], fan))


@pytest.mark.parametrize("change, broken", [
    (lambda r: r[:20] + r[21:], 1), (lambda r: r + [r[3]], 1), (lambda r: r[1:], 1), (lambda r: [*r[:5], (*r[5][:3], r[5][3] + 1, *r[5][4:]), *r[6:]], 1), (lambda r: [x for x in r if x[1] != 2 or x[2] != 1], 1),
])
def test_rollup_refuses_chunks_that_do_not_follow(spark, change, broken):
    rolled = pairs.rollup(spark.createDataFrame(change(chunk_rows("c", 40)), CHUNK), ["capture"], ["n_frames"], 4, 9)
    assert [r.broken for r in rolled.collect()] == [broken]
    with pytest.raises(errors.IncompleteWindow):
        pairs.require_whole(rolled)


def test_tree_depth_follows_the_numbers(spark):
    many = spark.range(300).select("id", F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    assert pairs.rollup_tree(many, "id", 4, 1).count() == 1 and pairs.rollup_tree(many, "id", 4, 1).first().n_chunks == 300
    assert [pairs.depth_of(m, 4) for m in (0, 3, 4, 15, 16, 63, 64)] == [1, 1, 2, 2, 3, 3, 4]
