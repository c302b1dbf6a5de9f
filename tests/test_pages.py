"""Pages of several requests and runs at once, against the single-page mapping and against their statuses by hand."""

import pytest

from tickloom.functions.time import MINUTE, SECOND
from tickloom.plans import pages

T0 = 1_767_589_200 * SECOND
ROW = "request_id int, run int, row_id int, provenance_id string, start long, end long, symbol string, asset_class string, resolution string, adjustment string, row_state string"
SLICE = "request_id int, run int, start long, end long, session_instance_id string, provider string, feed string, interval string, provisional boolean"
SOURCE = "request_id int, run int, provenance_id string, provider string, feed string, entitlement string"


def at(i):
    return T0 + i * MINUTE


@pytest.fixture(scope="module")
def parts(spark):
    table = spark.createDataFrame
    slices = table([(q, 1, at(0), at(30), "s1", "alpaca", "sip", "1m", False) for q in (1, 2)] + [(q, 1, at(30), at(39), "s2", "alpaca", "sip", "1m", True) for q in (1, 2)] + [(2, 2, at(39), at(60), "s3", "futu", None, "1m", False)], SLICE)
    sources = [("p1", "Alpaca", "SIP", "authorized"), ("p2", "futu", "sip", "authorized"), ("p3", "alpaca", "sip", "unauthorized"), ("p4", "Mixed", "sip", "authorized")]
    provenance = table([(q, 1, *s) for q in (1, 2) for s in sources] + [(2, 2, "p1", "futu", "own", "authorized")], SOURCE)
    spans = [(0, 1), (1, 2), (2, 3), (3, 4), (4, 5), (29, 31), (6, 8), (7, 9), (31, 32), (12, 13)]
    ids = {1: "none", 2: "p2", 3: "p3", 9: "p4"}
    base = lambda q, run, i, a, b: (q, run, i, ids.get(i, "p1") if run == 1 else "p1", at(a), at(b), "SPY" if i == 4 and run == 1 else "QQQ", "etf", "1m", "unadjusted", "validated")
    rows = table([base(1, 1, i, a, b) for i, (a, b) in enumerate(spans)] + [base(2, 1, 0, 5, 6), base(2, 2, 0, 40, 41), base(2, 2, 1, 58, 61), base(3, 1, 0, 0, 1)], ROW)
    requests = table([(q, "QQQ", "etf", "unadjusted", at(0), at(60)) for q in (1, 2)], "request_id int, symbol string, asset_class string, adjustment string, start long, end long")
    made = table([(1, 1, "complete", False, True), (2, 1, "complete", False, True), (2, 2, "complete", False, False)], "request_id int, run int, status string, truncated boolean, calendar_matches boolean")
    return rows, provenance, slices, requests, made


def test_rows_and_gaps_stay_with_their_page(spark, parts):
    out = pages.map_pages(*parts)
    good = {(r.request_id, r.run, r.row_id): (r.session_instance_id, r.validation_state) for r in out["rows"].collect()}
    assert good == {(1, 1, 0): ("s1", "validated"), (1, 1, 8): ("s2", "provisional"), (1, 1, 9): ("s1", "provisional"), (2, 1, 0): ("s1", "validated"), (2, 2, 0): ("s3", "provisional")}
    gaps = {(r.request_id, r.run, (r.start - T0) // MINUTE, (r.end - T0) // MINUTE, r.reason) for r in out["gaps"].collect()}
    # touching gaps of one reason are one gap
    assert gaps == {(1, 1, 1, 2, "unknown"), (1, 1, 2, 3, "validation_conflict"), (1, 1, 3, 4, "entitlement_limited"), (1, 1, 4, 5, "validation_conflict"), (1, 1, 6, 9, "validation_conflict"), (1, 1, 29, 31, "unknown"), (2, 2, 58, 60, "unknown")}
    assert [(r.request_id, r.row_id) for r in out["unplanned"].collect()] == [(3, 0)]
    assert {(r.request_id, r.run, r.provenance_id) for r in out["provenance"].collect()} == {(1, 1, "p1"), (1, 1, "p4"), (2, 1, "p1"), (2, 2, "p1")}


def test_statuses_and_answers(spark, parts):
    rows, provenance, slices, requests, made = parts
    segments = spark.createDataFrame([(2, 1, at(0), at(39), "complete", "p1"), (2, 2, at(45), at(60), "complete", "p1"), (1, 1, at(0), at(10), "complete", "p3"), (1, 1, at(5), at(39), "complete", None)], "request_id int, run int, start long, end long, status string, provenance_id string")
    out = pages.map_pages(rows, provenance, slices, requests, made, segments)
    cut = sorted((r.request_id, r.run, (r.start - T0) // MINUTE, (r.end - T0) // MINUTE, r.status) for r in out["segments"].collect())
    assert cut == [(1, 1, 5, 30, "unknown"), (1, 1, 30, 39, "unknown"), (2, 1, 0, 30, "complete"), (2, 1, 30, 39, "complete"), (2, 2, 45, 58, "complete")]
    assert {(r.request_id, r.run): r.status for r in out["statuses"].collect()} == {(1, 1): "partial", (2, 1): "complete", (2, 2): "partial"}
    plan_gaps = spark.createDataFrame([(2, at(5), at(7), "unknown")], "request_id int, start long, end long, reason string")
    said = pages.answers(out, plan_gaps)
    assert {(r.request_id, r.run, r.row_id) for r in said["rows"].collect()} == {(1, 1, 8), (1, 1, 9), (2, 2, 0)}
    assert {((r.start - T0) // MINUTE, (r.end - T0) // MINUTE, r.reason) for r in said["gaps"].where("request_id = 2").collect()} == {(5, 6, "validation_conflict"), (6, 7, "unknown"), (58, 60, "unknown")}
    summary = {r.request_id: r for r in said["summaries"].collect()}
    assert (summary[1].status, summary[1].n_rows, summary[1].source) == ("partial", 2, "mixed") and (summary[2].status, summary[2].n_rows, summary[2].provisional) == ("partial", 1, True)


@pytest.mark.parametrize("said, truncated, cover, status", [
    ("unsupported", False, [(0, 30)], "unsupported"), ("complete", False, [(0, 30), (30, 39)], "complete"), ("empty", False, [(0, 39)], "empty"), ("complete", False, [(0, 12)], "partial"),
    ("complete", False, [(3, 12)], "unknown"), ("complete", False, [], "unknown"), ("complete", True, [(0, 39)], "partial"), ("complete", True, [], "unknown"),
])
def test_every_state_of_a_page(spark, said, truncated, cover, status):
    table = spark.createDataFrame
    slices = table([(1, 1, at(0), at(30), "s1", "alpaca", "sip", "1m", False), (1, 1, at(30), at(39), "s2", "alpaca", "sip", "1m", False)], SLICE)
    made = table([(1, 1, said, truncated, True)], "request_id int, run int, status string, truncated boolean, calendar_matches boolean")
    segments = table([(1, 1, at(a), at(b), "complete", "p1") for a, b in cover], "request_id int, run int, start long, end long, status string, provenance_id string")
    requests = table([(1, "QQQ", "etf", "unadjusted", at(0), at(60))], "request_id int, symbol string, asset_class string, adjustment string, start long, end long")
    out = pages.map_pages(table([], ROW), table([(1, 1, "p1", "alpaca", "sip", "authorized")], SOURCE), slices, requests, made, segments)
    assert [r.status for r in out["statuses"].collect()] == [status]


def test_rows_meet_their_runs_first_and_are_judged_once(spark, parts, monkeypatch):
    seen, once = [], []
    contained, kept = pages.contained_in_one, pages.staged
    monkeypatch.setattr(pages, "contained_in_one", lambda rows, *a: seen.append(rows.count()) or contained(rows, *a))
    monkeypatch.setattr(pages, "staged", lambda df, name: once.append(name) or kept(df, name))
    out = pages.map_pages(*parts)
    assert seen == [parts[0].count() - out["unplanned"].count()] and once == ["judged-rows"]
