"""Plans of many requests against a plain planner that takes one at a time."""

import random
from collections import Counter

import pytest

from tickloom.functions.market import MAPPING_PRIORITY, SCOPES
from tickloom.functions.time import HOUR, MINUTE, SECOND
from tickloom.plans import requests as R
from tickloom.sources import calendar

CUTOFF = 1_451_624_400 * SECOND  # 2016-01-01 05:00 UTC
SCHEMA = "request_id long, symbol string, start long, end long, as_of long, resolution string, scope string, mode string, adjustment string, allow_daily_downgrade boolean"
CAPABILITY = "provider string, feed string, phase string, interval string, historical boolean, realtime boolean, priority int"


@pytest.fixture(scope="module")
def world(spark):
    days = calendar.civil_days(spark, "2015-12-21", "2016-01-17", ("2015-12-25", "2016-01-01")).cache()
    phases = calendar.phase_instances(days, {"2015-12-24": "13:00:00"}).where("trade_date <> '2016-01-06'")
    nights = calendar.overnight_instances(days).where("trade_date in ('2015-12-29', '2016-01-04', '2016-01-05', '2016-01-12')")
    return days, phases.unionByName(nights).cache()


def capabilities():
    out = [("alpaca", "sip", p, "1m", True, False, 1) for p in ("pre", "regular", "after")] + [("alpaca", "boats", "over", "1m", True, False, 1), ("alpaca", "sip", None, "1d", True, False, 1)]
    out += [("futu", None, "regular", "1m", True, True, 1), ("futu", None, "pre", "1m", False, True, 1), ("futu", None, None, "1d", True, False, 1), ("futu", None, None, "1d", False, False, 2)]
    return [*out, ("yfinance", "daily", None, "1d", True, False, 1)]


def clip(a, b, c, d):
    return (max(a, c), min(b, d)) if max(a, c) < min(b, d) else None


def minus(window, covers):
    out, cursor = [], window[0]
    for a, b in sorted(c for c in (clip(*window, *x) for x in covers) if c):
        if a > cursor:
            out.append((cursor, a))
        cursor = max(cursor, b)
    return [*out, (cursor, window[1])] if cursor < window[1] else out


def normal(gaps):
    cuts, out = sorted({t for a, b, _ in gaps for t in (a, b)}), []
    for a, b in zip(cuts, cuts[1:]):
        reasons = [r for s, e, r in gaps if s <= a and e >= b]
        if reasons:
            top = min(reasons, key=MAPPING_PRIORITY.index)
            if out and out[-1][1] == a and out[-1][2] == top:
                out[-1] = (out[-1][0], b, top)
            else:
                out.append((a, b, top))
    return out


def source_of(mode, date, daily, phase, rank):
    if rank is None:
        return None, None, "future_session"
    if date < "2016-01-01" and daily:
        return ("yfinance", "daily", None) if mode in ("auto", "research") else (None, None, "source_mode_excludes_required_provider")
    if mode == "research":
        return "yfinance", "daily", None
    if mode == "futu_only" or (mode == "auto" and rank in ("new", "buffer")):
        return "futu", None, None
    return "alpaca", "boats" if phase == "over" else "sip", None


def plain_plan(r, days, instances):
    _, _, start, end, as_of, resolution, scope, mode, _, downgrade = r
    first, last = days[0].start, days[-1].end
    intraday = resolution != "1d"
    early = intraday and (mode == "research" or start < CUTOFF)
    daily = not intraday or (early and downgrade)
    gaps = [(a, b, "unknown") for a, b in ((start, min(end, first)), (max(start, last), end)) if a < b]
    window = clip(start, end, first, last)
    if window and early and not downgrade:
        cut = window[1] if mode == "research" else min(window[1], CUTOFF)
        if window[0] < cut:
            gaps.append((window[0], cut, "unsupported_resolution"))
        window = (max(window[0], cut), window[1]) if max(window[0], cut) < window[1] else None
    order = sorted(instances, key=lambda i: (i.start, i.trade_date, i.phase))
    opened = max((k for k, i in enumerate(order) if i.start <= as_of < i.end), default=None)
    done = max((k for k, i in enumerate(order) if i.end <= as_of), default=None)

    def rank(k):
        if opened is not None:
            return "new" if k == opened else "buffer" if k == opened - 1 else "old" if k < opened else None
        return None if done is None or k > done else "buffer" if k == done else "old"

    slices = []
    for day in days if window else []:
        if day.status != "open" or not clip(*window, day.start, day.end):
            continue
        part, own = clip(*window, day.start, day.end), [(k, i) for k, i in enumerate(order) if i.session_id == day.session_id]
        if daily:
            started = [(k, i) for k, i in own if i.start <= as_of]
            k, i = started[-1] if started else (None, None)
            found = source_of(mode, day.trade_date, True, None, rank(k) if i else None) if own else (None, None, "missing_calendar_phase")
            slices.append((day.trade_date, i and i.session_instance_id, None, *part, *found, bool(i and i.start <= as_of < i.end)))
        else:
            for a, b in minus(part, [(i.start, i.end) for i in order]):
                at_edge = own and (b <= min(i.start for i in order if i.trade_date == day.trade_date) or a >= max(i.end for i in order if i.trade_date == day.trade_date))
                if scope == "all" or (scope == "overnight" and at_edge):
                    slices.append((day.trade_date, None, None, a, b, None, None, "missing_calendar_phase", False))
    for k, i in enumerate(order):
        part = window and not daily and i.phase in SCOPES[scope] and clip(*window, i.start, i.end)
        if part:
            slices.append((i.trade_date, i.session_instance_id, i.phase, *part, *source_of(mode, i.trade_date, False, i.phase, rank(k)), i.start <= as_of < i.end))
    out = []
    for date, instance, phase, a, b, provider, feed, gap, active in slices:
        cap = next((c for c in sorted(capabilities(), key=lambda c: c[-1]) if c[:4] == (provider, feed, phase, "1d" if daily else resolution)), None)
        if gap is None and not (cap and (cap[4] or (active and a <= as_of < b and cap[5]))):
            gap = "missing_provider_capability"
        if daily and scope in ("extended", "overnight"):
            provider, feed, gap = None, None, "unsupported_resolution"
        out.append((date, instance, phase, a, b, provider, feed, gap))
        if gap:
            gaps.append((a, b, {"missing_provider_capability": "provider_unavailable", "unsupported_resolution": gap}.get(gap, "unknown")))
    if not daily and scope in ("all", "overnight"):
        trusted = [(s[3], s[4]) for s in out if s[2] == "over"]
        for day in days:
            if day.status == "closed":
                for band in ((day.start, day.end - 20 * HOUR), (day.end - 4 * HOUR, day.end)):
                    part = clip(start, end, *band)
                    gaps += [(a, b, "unknown") for a, b in (minus(part, trusted) if part else [])]
    fetched = sorted((s for s in out if s[7] is None), key=lambda s: (-s[3], -s[4]))
    runs, groups = [], {}
    for s in fetched:
        key = (s[5], s[6])
        if runs and runs[-1][0] == key:
            runs[-1] = (key, min(runs[-1][1], s[3]), max(runs[-1][2], s[3]), runs[-1][3] + 1)
        else:
            runs.append((key, s[3], s[3], 1))
        a, b, n = groups.get(key, (s[3], s[4], 0))
        groups[key] = (min(a, s[3]), max(b, s[4]), n + 1)
    return out, normal(gaps), [(k + 1, *r) for k, r in enumerate(runs)], groups


def some_requests(first, last, n=160, seed=3):
    rng, rows = random.Random(seed), []
    for i in range(n):
        start = first + rng.randint(-30, 24 * 28) * HOUR + rng.choice([0, 7 * MINUTE])
        length = rng.choice([MINUTE, HOUR, 20 * HOUR, 75 * HOUR, 400 * HOUR])
        rows.append((i, "QQQ", start, start + length, first + rng.randint(0, (last - first) // MINUTE - 1) * MINUTE, rng.choice(["1m", "1m", "1h", "1d"]), rng.choice(list(SCOPES)), rng.choice(R.MODES), "unadjusted", rng.random() < 0.4))
    return rows


def test_plans_of_many_requests_against_a_plain_planner(spark, world):
    days, instances = (sorted(t.collect(), key=lambda r: r.start) for t in world)
    rows = some_requests(days[0].start, days[-1].end)
    caps = spark.createDataFrame(capabilities(), CAPABILITY)
    plan = R.plan_requests(spark.createDataFrame(rows, SCHEMA).repartition(5), *world, caps)
    got = {name: part.cache() for name, part in plan.items()}
    want = {r[0]: plain_plan(r, days, instances) for r in rows}
    assert {r.request_id: r.problem for r in got["requests"].collect()} == dict.fromkeys(want)
    names = ("trade_date", "session_instance_id", "phase", "start", "end", "provider", "feed", "gap")
    assert Counter((r.request_id, *[r[c] for c in names]) for r in got["slices"].collect()) == Counter((i, *s) for i, w in want.items() for s in w[0])
    assert Counter((r.request_id, r.start, r.end, r.reason) for r in got["gaps"].collect()) == Counter((i, *g) for i, w in want.items() for g in w[1])
    assert Counter((r.request_id, r.run, (r.provider, r.feed), r.oldest_start, r.newest_start, r.n_slices) for r in got["runs"].collect()) == Counter((i, *x) for i, w in want.items() for x in w[2])
    assert {(r.request_id, (r.provider, r.feed)): (r.start, r.end, r.n_slices) for r in got["groups"].collect()} == {(i, k): g for i, w in want.items() for k, g in w[3].items()}
    newest = [r for r in got["groups"].collect() if r.position == 1]
    assert all(r.end == max(g[1] for g in want[r.request_id][3].values()) for r in newest)
    kinds = {s[7] for w in want.values() for s in w[0]}
    assert kinds == {None, "future_session", "missing_calendar_phase", "missing_provider_capability", "source_mode_excludes_required_provider", "unsupported_resolution"}
    for part in got.values():
        part.unpersist()


def test_requests_with_a_problem_are_not_planned(spark, world):
    first = world[0].agg({"start": "min"}).first()[0]
    good = (1, "QQQ", first, first + HOUR, first + HOUR, "1m", "all", "auto", "unadjusted", False)
    but = lambda i, **c: tuple({**dict(zip(R.REQUEST, good)), "request_id": i, **c}[k] for k in R.REQUEST)
    rows = [good, but(2, symbol="qqq"), but(3, symbol="QQQ260105C00500000"), but(4, end=first), but(5, mode="x"), but(6, as_of=first - 1), but(7, scope=None), but(8, resolution="2m")]
    plan = R.plan_requests(spark.createDataFrame(rows, SCHEMA), *world, spark.createDataFrame(capabilities(), CAPABILITY))
    assert {r.request_id: r.problem for r in plan["requests"].collect()} == {1: None, 2: "symbol", 3: "symbol", 4: "window", 5: "resolution, scope or mode", 6: "as_of", 7: "missing_value", 8: "resolution, scope or mode"}
    assert {r.request_id for r in plan["gaps"].collect()} == {1}
    empty = R.plan_requests(spark.createDataFrame([], SCHEMA), *world, spark.createDataFrame(capabilities(), CAPABILITY))
    assert all(part.count() == 0 for part in empty.values())


def test_requests_are_not_sorted_by_their_times(spark, world):
    # requests met a table of their own distinct times, which grows with them, and so were shuffled and sorted by as_of in the session's few tasks
    first = world[0].first().start
    many = spark.range(10**9).selectExpr("id as request_id", f"{first} + id * {MINUTE} as as_of")
    plan = R.clocks(many, world[1])._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin [_day" in plan


def test_times_at_the_edges_of_instances(spark, world):
    order = sorted(world[1].collect(), key=lambda i: (i.start, i.trade_date, i.phase))
    times = sorted({t + d for i in order for t in (i.start, i.end) for d in (-1, 0, 1)} | {order[0].start - 400 * HOUR, order[-1].end + 4000 * HOUR})
    got = {r.as_of: (r.opened, r.done) for r in R.clocks(spark.createDataFrame([(t,) for t in [*times, *times]], "as_of long"), world[1]).collect()}
    last = lambda on: max((k for k, i in enumerate(order, 1) if on(i)), default=None)
    assert got == {t: (last(lambda i: i.start <= t < i.end), last(lambda i: i.end <= t)) for t in times}
