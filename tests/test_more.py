"""Smaller operators: ledgers, order, chunks, snapshots, budgets, reasons, streaming bars."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tickloom import errors
from tickloom.functions import market
from tickloom.functions.time import HOUR, MINUTE, SECOND
from tickloom.operators import pairs, reconcile, sequence
from tickloom.plans import mapping, sessions
from tickloom.sources import calendar, datasets
from tickloom.sources.envelopes import synthetic_events
from tickloom.streaming import ingest


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_ledger_order_and_chunks(spark):
    rows = spark.createDataFrame([("f", 1, 1, 1), ("f", 1, 5, 2), ("f", 1, 5, 3), ("f", 1, 6, 4)], "feed string, generation long, sequence long, arrival long")
    ledger = sequence.gap_ledger(sequence.classify(rows, ["feed"], "arrival")).orderBy("arrival").collect()
    assert [(r.reason, r.missing_start, r.missing_end) for r in ledger] == [("gap", 2, 4), ("duplicate_or_reordered", None, None)]
    assert [r.arrival for r in sequence.not_increasing(rows, ["feed"], "arrival").collect()] == [3]
    chunks = spark.createDataFrame([("c", 1, 0, 4), ("c", 1, 5, 9), ("c", 1, 11, 12), ("c", 2, 3, 4)], "capture string, generation long, first long, last long")
    assert [r.first for r in sequence.chunk_breaks(chunks, ["capture"]).collect()] == [11]
    events = spark.createDataFrame([(1, 1), (1, None), (None, None)], "a int, b int")
    assert pairs.partial_references(events, ["a", "b"]).count() == 1


def test_reasons_and_ends(spark):
    assert one(spark, market.bar_end(F.lit(0).cast("long"), F.lit("5m"), F.lit(3 * MINUTE))) == 3 * MINUTE
    assert one(spark, market.bar_end(F.lit(0).cast("long"), F.lit("1m"), F.lit(3 * MINUTE))) == MINUTE
    assert one(spark, market.bar_end(F.lit(0).cast("long"), F.lit("1d"), F.lit(9 * HOUR))) == 9 * HOUR
    assert one(spark, market.failure_reason(F.lit("forbidden"))) == "entitlement_limited" and one(spark, market.failure_reason(F.lit("timeout"))) == "provider_unavailable"
    strongest = [one(spark, market.priority_of(F.lit("validation_conflict"), o)) for o in (market.MAPPING_PRIORITY, market.RESPONSE_PRIORITY)]
    assert strongest == [5, 6]
    a, b = ({"symbol": F.lit("QQQ"), "limit": F.lit(x)} for x in (1, None))
    assert one(spark, reconcile.key_fingerprint(a)) != one(spark, reconcile.key_fingerprint(b))


def test_policies(spark):
    slices = spark.createDataFrame([("pre", "1m", "new", True), ("regular", "1m", "new", True), ("regular", "1m", "old", True), ("after", "1m", "buffer", False)], "phase string, interval string, rank string, historical boolean")
    assert [r.phase for r in mapping.permitted(slices).collect()] == ["pre"]
    segments = spark.createDataFrame([(1, "complete"), (2, "complete")], "id int, status string")
    assert {r.id: r.status for r in reconcile.downgraded(segments, F.col("id") == 1).collect()} == {1: "partial", 2: "complete"}


def test_calendar_snapshot(spark, tmp_path):
    day = lambda d, state: {"trade_date": f"2026-01-0{d}", "day_window": {"start": f"2026-01-0{d}T05:00:00Z", "end_exclusive": f"2026-01-0{d + 1}T05:00:00Z"}, "state": state, "verification_status": "verified"}
    phase = lambda p, a, b: {"session_id": "X", "session_instance_id": f"X:{p}", "trade_date": "2026-01-05", "phase": p, "window": {"start": f"2026-01-05T{a}Z", "end_exclusive": f"2026-01-0{6 if b < a else 5}T{b}Z"}}
    body = {"days": [day(4, {"status": "closed", "reason": "weekend"}), day(5, {"status": "open", "session_id": "X"})], "instances": [phase("pre", "09:00:00", "14:30:00"), phase("regular", "14:30:00", "21:00:00"), phase("after", "21:00:00", "01:00:00")]}
    raw = json.dumps(body).encode()
    path = tmp_path / "calendar.json"
    path.write_bytes(raw)
    days, instances = calendar.read_snapshot(spark, f"file://{path}", hashlib.sha256(raw).hexdigest())
    assert days.count() == 2 and instances.count() == 3
    with pytest.raises(errors.Contract):
        calendar.read_snapshot(spark, f"file://{path}", "0" * 64)
    del body["instances"][1]
    raw = json.dumps(body).encode()
    path.write_bytes(raw)
    with pytest.raises(errors.Contract, match="phases"):
        calendar.read_snapshot(spark, f"file://{path}", hashlib.sha256(raw).hexdigest())


def test_budget_and_tampering(spark, tmp_path):
    path = f"file://{tmp_path}/events"
    events = synthetic_events(spark, 1000, 1_791_466_200 * SECOND)
    manifest = datasets.write(events, path, "event_v1", "snappy")
    datasets.check_budget(spark, path)
    with pytest.raises(errors.InputLimit):
        datasets.check_budget(spark, path, most_bytes=10)
    assert datasets.verify(spark, path, "event_v1") == manifest
    datasets.read(spark, path, "event_v1").limit(1).write.mode("append").parquet(path)
    with pytest.raises(errors.Contract, match="content"):
        datasets.verify(spark, path, "event_v1")
    with pytest.raises(errors.Contract):
        datasets.read(spark, path, "trade_bar")
    with pytest.raises(errors.Contract):
        datasets.write(events.withColumn("event_kind", F.lit("control")), f"file://{tmp_path}/control", "event_v1")


def test_stream_bars_equal_batch(spark, tmp_path):
    rows = spark.range(600).select(F.lit("a").alias("symbol"), F.timestamp_seconds(F.lit(1_791_466_200) + F.col("id")).alias("t"), F.col("id").alias("arrival"), ((F.col("id") * 37) % 101).cast("decimal(18,4)").alias("price"), F.lit(1).cast("decimal(18,4)").alias("size"))
    late = spark.createDataFrame([("a", 1_791_466_200 + 7200)], "symbol string, s long").select("symbol", F.timestamp_seconds("s").alias("t"), F.lit(999).cast("long").alias("arrival"), F.lit(1).cast("decimal(18,4)").alias("price"), F.lit(1).cast("decimal(18,4)").alias("size"))
    rows.union(late).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = ingest.stream_bars(ingest.read_events(spark, f"{tmp_path}/in", rows._jdf.schema().toDDL()), "t", ["symbol"])
    ingest.run_to_end(stream, f"{tmp_path}/out", f"{tmp_path}/ck")
    got = {r.bar_start: (r.open, r.high, r.low, r.close, r.volume, r.trade_count) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    order = F.struct("t", "arrival")
    bars = rows.groupBy(F.window("t", "1 minute")["start"].alias("b")).agg(F.min_by("price", order), F.max("price"), F.min("price"), F.max_by("price", order), F.sum("size"), F.count("*")).collect()
    assert got == {r[0]: tuple(r[1:]) for r in bars} and len(got) == 10


def test_stream_keeps_messages_once_and_its_ledger(spark, tmp_path):
    schema = "provider string, feed string, generation long, sequence long, arrival long"
    for part, numbers in enumerate(([1, 2, 5], [5, 6, 9])):
        spark.createDataFrame([("p", "f", 1, n, part * 10 + i) for i, n in enumerate(numbers)], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = ingest.classify_stream(ingest.read_events(spark, f"{tmp_path}/in", schema, files_per_trigger=100))
    ingest.persist(stream, f"{tmp_path}/out", f"{tmp_path}/ck")
    assert sorted(r.sequence for r in spark.read.parquet(f"{tmp_path}/out/messages").collect()) == [1, 2, 5, 6, 9]
    ledger = spark.read.parquet(f"{tmp_path}/out/ledger").orderBy("arrival").collect()
    assert [(r.reason, r.missing_start, r.missing_end) for r in ledger] == [("gap", 3, 4), ("duplicate_or_reordered", None, None), ("gap", 7, 8)]


def test_provider_bars_are_written_as_one_page(spark, tmp_path):
    from tickloom.sources.schemas import MARKET_BAR

    base = {"schema_version": 1, "symbol": "QQQ", "asset_class": "etf", "resolution": "1m", "adjustment": "unadjusted", "bar_start_utc": 0, "bar_end_exclusive_utc": MINUTE, "received_at_utc": 0, "available_at_utc": 0, "open": "2", "high": "3", "low": "1", "close": "2", "volume": "0", "provenance_id": "p", "session_instance_id": "s", "validation_state": "validated"}
    bars = lambda *changes: spark.createDataFrame([tuple((base | c)[f.name] for f in MARKET_BAR.fields) for c in changes], MARKET_BAR)
    manifest = datasets.write(bars({}, {"bar_start_utc": MINUTE, "bar_end_exclusive_utc": 2 * MINUTE}), f"file://{tmp_path}/good", "market_bar", source={"provider": "alpaca", "feed": "sip"})
    assert manifest["rows"] == 2 and datasets.manifest_of(spark, f"file://{tmp_path}/good")["source"] == {"provider": "alpaca", "feed": "sip"}
    assert datasets.read_checked(spark, f"file://{tmp_path}/good", "market_bar").count() == 2
    for i, (bad, error) in enumerate((({"volume": "-1"}, errors.Contract), ({"high": "1"}, errors.Contract), ({"provenance_id": " "}, errors.Contract), ({"symbol": "SPY"}, errors.MixedProvenance))):
        with pytest.raises(error):
            datasets.write(bars({}, bad), f"file://{tmp_path}/bad{i}", "market_bar")
        assert not (tmp_path / f"bad{i}").exists()
    with pytest.raises(errors.InputLimit):
        datasets.write(bars(*[{"bar_start_utc": i} for i in range(1001)]), f"file://{tmp_path}/many", "market_bar")


def test_a_chunk_of_frames_and_events_is_published_together(spark, tmp_path):
    from tickloom.sources.schemas import EVENT_V2, RAW_FRAME_V1

    body = b"frame"
    frame = lambda n, count: (1, "p", "f", "unknown", None, 1, n, 0, hashlib.sha256(body).hexdigest(), body, count, "market_data", "[]")
    event = lambda n, k, count: (1, "p", "f", "unknown", "decimal_token", None, None, 1, n, 0, 0, "stock_trade", "QQQ", "1", "1", None, None, None, None, 1, n, k, count)
    typed = lambda rows, schema: spark.createDataFrame(rows, ", ".join(f"{f.name} {f.dataType.simpleString().replace('decimal(20,0)', 'long')}" for f in schema.fields)).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    frames = typed([frame(1, 2), frame(2, 1)], RAW_FRAME_V1)
    events = typed([event(1, 0, 2), event(1, 1, 2), event(2, 0, 1)], EVENT_V2)
    receipt = datasets.publish_pair(frames, events, f"file://{tmp_path}/chunk", 1)
    assert (receipt["frames"]["rows"], receipt["events"]["rows"]) == (2, 3) and (tmp_path / "chunk" / "receipt").exists()
    with pytest.raises(errors.Contract):
        datasets.publish_pair(frames, events.limit(2), f"file://{tmp_path}/short", 1)
    with pytest.raises(errors.Contract):  # a reference to a frame is given whole or not at all
        datasets.write(events.withColumn("raw_frame_event_count", F.lit(None).cast("bigint")), f"file://{tmp_path}/partial", "event_v2")
    with pytest.raises(errors.Contract):
        datasets.write(frames.withColumn("frame_sha256", F.lit("0" * 64)), f"file://{tmp_path}/hash", "raw_frame_v1")
    with pytest.raises(errors.Contract):
        datasets.write(frames.union(frames), f"file://{tmp_path}/twice", "raw_frame_v1")


def test_versions_have_one_successor_and_keep_their_authority(spark, tmp_path):
    root, rows = f"file://{tmp_path}", spark.range(3)
    datasets.publish_version(rows, root, "k", "v1", 100, False)
    datasets.publish_version(rows, root, "k", "v2", 100, True)
    datasets.rollback(spark, root, "k", "v1", 100)
    assert datasets.current_pointer(spark, root, "k") == {"version": "v1", "expires": 100, "authoritative": False}
    with pytest.raises(errors.CacheConflict):
        datasets._point(spark, root, "k", {"version": "v2", "expires": 1, "authoritative": True}, 1)


def test_the_next_run_follows_success_and_failure(spark):
    runs = spark.createDataFrame([(1, "futu"), (2, "alpaca")], "run long, provider string")
    assert sessions.next_run(runs, None)["provider"] == "futu" and sessions.next_run(runs, 1)["provider"] == "alpaca" and sessions.next_run(runs, 2) is None


def test_verified_at_needs_every_row_in_the_cache(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "id int, v string")
    times = lambda cached: {r.verified_at for r in reconcile.with_verified_at(rows, cached, 7).collect()}
    assert times(rows.union(rows)) == {7} and times(rows.dropDuplicates()) == {None}


def test_stretches_follow_range_and_count(spark):
    rows = spark.range(1000).select((F.col("id") * 1_000_000_000).alias("arrival"))
    width = sequence.stretch(rows, "arrival", 100)
    assert rows.select(F.floor(F.col("arrival") / width)).distinct().count() in (10, 11) and sequence.stretch(rows.limit(0), "arrival") == 1


def test_research_pages_are_read_once_and_by_all_cores(spark, sf):
    from tickloom.queries_contracts import research_pages

    made = research_pages(spark, sf)
    assert made.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
    # the rules judge parts that an earlier step has read
    assert "get_json_object" not in made._jdf.queryExecution().optimizedPlan().toString().splitlines()[0]
