"""Calendar, planner, mapping, reconciliation, versions, cursors, pairs and streams."""

import pytest
from pyspark.sql import functions as F

from tickloom import errors
from tickloom.functions.time import HOUR, MINUTE, SECOND
from tickloom.operators import pairs, paging, reconcile
from tickloom.plans import mapping, sessions
from tickloom.sources import calendar, datasets, research
from tickloom.streaming import ingest

MONDAY = 1_767_589_200 * SECOND  # 2026-01-05 00:00 in New York


@pytest.fixture(scope="module")
def week(spark):
    days = calendar.civil_days(spark, "2026-01-03", "2026-01-11").cache()
    return days, calendar.phase_instances(days).cache()


def caps(spark, *more):
    rows = [(*source, p, r, True, source[0] == "futu", 1) for source in (("futu", None), ("alpaca", "sip")) for p, r in (("pre", "1m"), ("regular", "1m"), ("after", "1m"), (None, "1d"))]
    return spark.createDataFrame([*rows, *more], "provider string, feed string, phase string, interval string, historical boolean, realtime boolean, priority int")


def test_calendar(spark, week):
    days, instances = week
    assert calendar.calendar_violations(days, instances).isEmpty() and instances.count() == 15
    assert days.where("trade_date = '2026-01-05'").first().start == MONDAY
    spring = calendar.civil_days(spark, "2026-03-07", "2026-03-09")
    assert [(r.end - r.start) // HOUR for r in spring.orderBy("trade_date").collect()] == [24, 23, 24]
    bands = calendar.closed_night_bands(spring.where("trade_date = '2026-03-08'")).orderBy("start").collect()
    assert [(b.end - b.start) // HOUR for b in bands] == [3, 4]
    early = calendar.phase_instances(days, {"2026-01-06": "13:00:00"}).where("trade_date = '2026-01-06'").orderBy("start").collect()
    assert [(r.end - r.start) / HOUR for r in early] == [5.5, 3.5, 4.0]
    night = calendar.overnight_instances(days)
    assert calendar.calendar_violations(days, instances.unionByName(night)).isEmpty()


def test_ranks_open_and_closed(spark, week):
    _, instances = week
    of = lambda at: {r.session_instance_id: r["rank"] for r in sessions.ranked(instances, at).collect()}
    opened = of(MONDAY + 34 * HOUR)  # Tuesday 10:00
    assert opened["XNYS:2026-01-06:regular"] == "new" and opened["XNYS:2026-01-06:pre"] == "buffer" and opened["XNYS:2026-01-05:after"] == "old" and opened["XNYS:2026-01-06:after"] is None
    closed = of(MONDAY + 21 * HOUR)
    assert "new" not in closed.values() and closed["XNYS:2026-01-05:after"] == "buffer" and closed["XNYS:2026-01-06:pre"] is None


def test_plan_routes_and_gaps(spark, week):
    days, instances = week
    request = sessions.Request("QQQ", MONDAY, MONDAY + 48 * HOUR)
    plan = sessions.plan_market_bars(request, MONDAY + 34 * HOUR, days, instances, caps(spark))
    by = {r.session_instance_id: r for r in plan["slices"].collect()}
    assert by["XNYS:2026-01-06:regular"].provider == "futu" and by["XNYS:2026-01-05:regular"].provider == "alpaca" and by["XNYS:2026-01-05:regular"].feed == "sip"
    assert by["XNYS:2026-01-06:after"].gap == "future_session" and by["XNYS:2026-01-06:regular"].realtime
    assert [(g.provider, g.n_slices) for g in plan["groups"].collect()] == [("futu", 2), ("alpaca", 3)]
    # nights of open days have no phase here, and the last evening's has not come yet
    assert [((g.start - MONDAY) // HOUR, (g.end - MONDAY) // HOUR, g.reason) for g in plan["gaps"].collect()] == [(0, 4, "unknown"), (20, 28, "unknown"), (40, 48, "unknown")]
    only = sessions.plan_market_bars(sessions.Request("QQQ", MONDAY, MONDAY + 24 * HOUR, mode="futu_only", scope="regular"), MONDAY + 34 * HOUR, days, instances, caps(spark).where("provider <> 'futu'"))
    assert [r.reason for r in only["gaps"].collect()] == ["provider_unavailable"] and only["groups"].isEmpty()


def test_weekend_bands_follow_the_scope(spark, week):
    days, instances = week
    request = lambda scope: sessions.Request("QQQ", MONDAY - 48 * HOUR, MONDAY, scope=scope)
    plan = lambda scope: sessions.plan_market_bars(request(scope), MONDAY + 34 * HOUR, days, instances, caps(spark))["gaps"].collect()
    assert plan("regular") == []
    assert [(g.end - g.start) // HOUR for g in plan("all")] == [4, 8, 4]


def test_old_requests_are_cut_or_downgraded(spark):
    days = calendar.civil_days(spark, "2015-12-28", "2016-12-30", ("2016-01-01",))
    instances = calendar.phase_instances(days)
    start = days.agg(F.min("start")).first()[0]
    as_of = start + 300 * 24 * HOUR
    request = sessions.Request("QQQ", start, start + 10 * 24 * HOUR)
    plan = sessions.plan_market_bars(request, as_of, days, instances, caps(spark))
    assert [r.reason for r in plan["gaps"].collect() if r.start == start] == ["unsupported_resolution"]
    assert plan["slices"].agg(F.min("trade_date")).first()[0] >= "2016-01-04"
    daily = sessions.plan_market_bars(sessions.Request("QQQ", start, start + 10 * 24 * HOUR, allow_daily_downgrade=True), as_of, days, instances, caps(spark, ("yfinance", "daily", None, "1d", True, False, 1)))
    providers = {r.trade_date: r.provider for r in daily["slices"].collect()}
    assert providers["2015-12-30"] == "yfinance" and providers["2016-01-05"] == "alpaca"


ROW = "row_id int, provenance_id string, start long, end long, symbol string, asset_class string, resolution string, adjustment string, row_state string, session_instance_id string"


def page(spark, spans, **changes):
    base = {"provenance_id": "p1", "symbol": "QQQ", "asset_class": "equity", "resolution": "1m", "adjustment": "unadjusted", "row_state": "validated", "session_instance_id": "theirs"}
    rows = [(i, *[(base | changes.get(i, {}))["provenance_id"]], a, b, *[(base | changes.get(i, {}))[k] for k in ("symbol", "asset_class", "resolution", "adjustment", "row_state", "session_instance_id")]) for i, (a, b) in enumerate(spans)]
    return spark.createDataFrame(rows, ROW)


def test_rows_are_mapped_or_leave_gaps(spark):
    t = [MONDAY + i * MINUTE for i in range(40)]
    slices = spark.createDataFrame([(t[0], t[30], "s1", False), (t[30], t[39], "s2", True)], "start long, end long, session_instance_id string, slice_provisional boolean")
    provenance = spark.createDataFrame([("p1", "Alpaca", "SIP", "authorized"), ("p2", "futu", "sip", "authorized"), ("p3", "alpaca", "sip", "unauthorized")], "provenance_id string, provider string, feed string, entitlement string")
    spans = [(t[0], t[1]), (t[1], t[2]), (t[2], t[3]), (t[3], t[4]), (t[4], t[5]), (t[29], t[31]), (t[6], t[8]), (t[7], t[9]), (t[31], t[32])]
    rows = page(spark, spans).withColumn("provenance_id", F.when(F.col("row_id") == 1, "none").when(F.col("row_id") == 2, "p2").when(F.col("row_id") == 3, "p3").otherwise(F.col("provenance_id"))).withColumn("symbol", F.when(F.col("row_id") == 4, "SPY").otherwise(F.col("symbol")))
    expected = {"provider": F.lit("alpaca"), "feed": F.lit("sip"), "symbol": F.lit("QQQ"), "asset_class": F.lit("equity"), "resolution": F.lit("1m"), "adjustment": F.lit("unadjusted")}
    out = mapping.map_page(rows, provenance, slices, expected, t[0], t[39])
    good = {r.row_id: (r.session_instance_id, r.validation_state) for r in out["rows"].collect()}
    assert good == {0: ("s1", "validated"), 8: ("s2", "provisional")}
    gaps = {((r.start - t[0]) // MINUTE, (r.end - t[0]) // MINUTE, r.reason) for r in out["gaps"].collect()}
    assert gaps == {(1, 2, "unknown"), (2, 3, "validation_conflict"), (3, 4, "entitlement_limited"), (4, 5, "validation_conflict"), (29, 30, "unknown"), (30, 31, "unknown"), (6, 8, "validation_conflict"), (7, 9, "validation_conflict")}
    segments = spark.createDataFrame([(t[0], t[39], "complete")], "start long, end long, status string")
    answer = mapping.answer(out["rows"], out["gaps"], slices, segments, provenance)
    assert answer["status"] == "partial" and answer["source"] == "Alpaca" and [r.row_id for r in answer["rows"].collect()] == [0, 8]
    clean = out["rows"].where("row_id = 0")
    none = out["gaps"].limit(0)
    assert mapping.answer(clean, none, slices, segments, provenance)["status"] == "complete"
    assert mapping.answer(clean, none, slices, segments, provenance, unsupported=True)["status"] == "unsupported"
    assert mapping.answer(clean.limit(0), none, slices, segments, provenance)["status"] == "empty"
    assert mapping.answer(clean, none, slices, segments.limit(0), provenance)["status"] == "unknown"
    assert [r.reason for r in mapping.failed(slices, none, "provider_unavailable").collect()] == ["provider_unavailable"]


def test_reconciliation(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "id int, price string, state string").withColumn("price", F.col("price").cast("decimal(38,18)"))
    old = rows((1, "10.00", "a"), (2, "10.00", "a"), (3, "1", "a"), (4, None, "a"))
    new = rows((1, "10.01", "a"), (2, "10.02", "a"), (3, "1.00", "b"), (4, None, "a"), (5, "1", "a"))
    out = {r.id: r.status for r in reconcile.compared(old, new, ["id"], {"price": "0.01"}, ["state"]).collect()}
    assert out == {1: "tolerated", 2: "conflict", 3: "conflict", 4: "equal", 5: "added"}
    same = reconcile.verdict(reconcile.compared(old, old, ["id"], {"price": "0"}, ["state"])).first()
    assert same.accepted and same.equal == 4
    twice = rows((1, "1", "a"), (1, "1.00", "a"))
    assert reconcile.deduplicated(twice, ["id"]).count() == 1
    with pytest.raises(errors.CacheConflict):
        reconcile.deduplicated(rows((1, "1", "a"), (1, "1.01", "a")), ["id"])
    assert reconcile.same_bag(old, old.orderBy(F.desc("id"))) and not reconcile.same_bag(old, old.union(old.limit(1)))
    statuses = spark.createDataFrame([("s1", "equal"), ("s2", "conflict")], "session string, status string")
    assert all(r.batch_rejected for r in reconcile.session_verdicts(statuses, "session").collect())
    segments = spark.createDataFrame([("a", 0, 5, "complete"), ("a", 5, 9, "complete"), ("b", 0, 5, "complete"), ("b", 6, 9, "complete"), ("c", 0, 5, "partial")], "session string, start long, end long, status string")
    assert [(r.session, r.start, r.end) for r in reconcile.session_bounds(segments, "session").collect()] == [("a", 0, 9)]
    pages = spark.createDataFrame([(1, None, "x", 1), (2, "x", "y", 2), (3, "z", None, 3)], "number int, token string, next_token string, received_ns long").withColumn("k", F.lit(1))
    assert [r.number for r in reconcile.broken_pages(pages, ["k"]).collect()] == [3]


def test_versions_and_rollback(spark, tmp_path):
    root, rows = f"file://{tmp_path}/cache", spark.range(3)
    assert datasets.load_current(spark, root, "k", 0) is None
    datasets.publish_version(rows, root, "k", "v1", 100, True)
    datasets.publish_version(spark.range(5), root, "k", "v2", 100, True)
    assert datasets.load_current(spark, root, "k", 99).count() == 5 and datasets.load_current(spark, root, "k", 100) is None
    datasets.publish_version(spark.range(9), root, "k", "v3", 100, False)
    assert datasets.load_current(spark, root, "k", 99).count() == 5
    datasets.rollback(spark, root, "k", "v1", 100)
    assert datasets.load_current(spark, root, "k", 99).count() == 3 and datasets.list_versions(spark, root, "k") == ["v1", "v2", "v3"]


def test_cursor():
    args = (b"secret", {"symbol": "QQQ"}, "plan", [1, 2], "me", 5, 1000)
    token = paging.make_token(*args)
    assert paging.read_token(b"secret", token, {"symbol": "QQQ"}, "plan", "me", 1000 + paging.TTL_SECONDS - 1)["position"] == [1, 2]
    for bad in ((b"other", token, {"symbol": "QQQ"}, "plan", "me", 1000), (b"secret", token, {"symbol": "SPY"}, "plan", "me", 1000), (b"secret", token, {"symbol": "QQQ"}, "plan", "me", 1000 + paging.TTL_SECONDS), (b"secret", "x.y", {"symbol": "QQQ"}, "plan", "me", 1000)):
        with pytest.raises(errors.Contract):
            paging.read_token(*bad)
    assert paging.date_pages(0, 8000) == [(4350, 8000), (700, 4350), (0, 700)]


def test_frames_and_events(spark):
    frames = spark.createDataFrame([(1, 1, 2), (1, 2, 1), (1, 3, 1)], "generation int, frame_sequence int, event_count int")
    events = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (1, 2, 0), (1, 2, 0), (1, 9, 0)], "generation int, frame_sequence int, ordinal int")
    got = {r.frame_sequence: r.complete for r in pairs.frame_completeness(frames, events, pairs.V1_KEY, "ordinal", "event_count").collect()}
    assert got == {1: True, 2: False, 3: False, 9: False}
    raw = spark.createDataFrame([(bytearray(b"x"), "2d711642b726b04401627ca9fbac32f5c8530fb1903cc4db02258717921a4881"), (bytearray(b"y"), "0")], "frame_bytes binary, frame_sha256 string")
    assert pairs.hash_violations(raw).count() == 1
    chunks = pairs.chunk_digests(spark.range(10).select((F.col("id") % 2).alias("c"), "id"), ["c"], ["id"], ["id"])
    assert pairs.rollup_digest(chunks, ["c"]).first().n_chunks == 2


def test_stream_equals_batch(spark, tmp_path):
    from tickloom.operators import sequence

    rows = spark.createDataFrame([("p", "f", 1 + i // 30, (i * 7) % 31, i) for i in range(90)], "provider string, feed string, generation long, sequence long, arrival long")
    rows.repartition(1).sortWithinPartitions("arrival").write.parquet(f"{tmp_path}/in")
    stream = ingest.classify_stream(ingest.read_events(spark, f"{tmp_path}/in", "provider string, feed string, generation long, sequence long, arrival long"))
    ingest.run_to_end(stream, f"{tmp_path}/out", f"{tmp_path}/ck")
    got = {r.arrival: (r.decision, r.missing_first, r.missing_last) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    want = {r.arrival: (r.decision, r.missing_first, r.missing_last) for r in sequence.classify(rows, ["provider", "feed"], "arrival").collect()}
    assert got == want


def test_late_rows_change_no_bar(spark):
    events = spark.createDataFrame([("a", "2026-01-05 10:00:30"), ("a", "2026-01-05 10:01:30")], "symbol string, t string").withColumn("t", F.to_timestamp("t"))
    published = spark.createDataFrame([("a", "2026-01-05 10:00:00")], "symbol string, bar_start string").withColumn("bar_start", F.to_timestamp("bar_start"))
    fresh, late = ingest.split_late(events, "t", ["symbol"], published)
    assert (fresh.count(), late.count()) == (1, 1)


def test_research_pages(spark):
    bar = '{"symbol":"QQQ","asset_class":"equity","event_ts_utc":"2026-01-0%d","resolution":"1d","adjustment":"all","open":"10","high":"%s","low":"9","close":"10","adj_close":"10","volume":"5","dividends":"0","stock_splits":"0"}'
    bars = research.parse_bars(spark.createDataFrame([('{"bars":[' + bar % (5, "11") + "," + bar % (6, "9.5") + "]}",)], "page string"))
    from tickloom.operators.bars import broken_rules

    assert [(r.event_ts_utc, r.rule) for r in broken_rules(bars, research.bar_rules()).collect()] == [("2026-01-06", "high_low")]
    declared = spark.createDataFrame([("QQQ", 3, "2026-01-05", "2026-01-06")], "symbol string, n long, first string, last string")
    assert research.coverage_mismatch(bars, declared).first().declared_n == 3
    assert research.out_of_order(bars.withColumn("o", -F.dayofmonth(F.to_date("event_ts_utc"))), "o").count() == 1


def test_request_checks_and_routes(spark, week):
    days, instances = week
    sessions.check_request(sessions.Request("QQQ", 0, 1))
    for bad in (sessions.Request("qqq", 0, 1), sessions.Request("SPY261218C00600000", 0, 1), sessions.Request("QQQ", 1, 1), sessions.Request("QQQ", 0, 1, resolution="2m")):
        with pytest.raises(errors.Contract):
            sessions.check_request(bad)
    more = caps(spark, ("futu", None, "over", "1m", True, True, 1), ("alpaca", "boats", "over", "1m", True, False, 1))
    routes = spark.createDataFrame([("alpaca", "boats")], "provider string, feed string")
    assert {r.provider for r in sessions.overnight_capabilities(more, routes).where("phase = 'over'").collect()} == {"alpaca"}
    night = calendar.overnight_instances(days).withColumn("issued", F.lit(0).cast("long")).withColumn("lease_end", F.when(F.col("trade_date") == "2026-01-06", 5).otherwise(50).cast("long"))
    assert sessions.overlay(days, instances, night, 10).where("phase = 'over'").count() == 4


def test_evidence_and_completeness(spark):
    rows = spark.createDataFrame([("a", 0, 5), ("a", 5, 9), ("b", 3, 6)], "session string, start long, end long")
    segments = spark.createDataFrame([("a", 0, 9, "complete"), ("b", 0, 5, "complete"), ("b", 5, 9, "complete")], "session string, start long, end long, status string")
    evidence = reconcile.coverage_evidence(rows, segments, "session")
    assert {(r.session, r.start): (r.n_rows, r.n_straddling) for r in evidence.collect()} == {("a", 0): (2, 0), ("b", 0): (0, 1), ("b", 5): (0, 1)}
    assert {r.session: r.complete for r in reconcile.is_complete(evidence, "session", 1, 8).collect()} == {"a": True, "b": False}
