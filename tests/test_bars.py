"""Bars, facts, sequence checks and envelopes on small fixtures."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tickloom import errors
from tickloom.functions import time, values
from tickloom.operators import bars as B
from tickloom.operators import sequence
from tickloom.sources import datasets, envelopes
from tickloom.sources.schemas import TRADE_BAR, fingerprint

START = 1_791_466_200 * time.SECOND  # 2026-10-08T13:30:00Z
SHA = "a" * 64


def seven(extra=()):
    rows = [(10, "trade", "10.000", "2"), (20, "quote", "9.9", "10.1"), (50, "trade", "10.500", "3"), (63, "trade", "10.250", "1"), (90, "trade", "10.750", "4"), (132, "trade", "10.625", "2"), (224, "trade", "10.875", "3"), *extra]
    out = []
    for i, (sec, kind, a, b) in enumerate(rows):
        stamp = lambda s: f"2026-10-08T13:{30 + int(s) // 60:02d}:{s % 60:04.1f}Z" if s % 1 else f"2026-10-08T13:{30 + s // 60:02d}:{s % 60:02d}Z"
        event = {"kind": f"stock_{kind}", "symbol": "QQQ"} | ({"price": a, "size": b} if kind == "trade" else {"bid": a, "ask": b})
        out.append({"schema_version": 1, "source": {"provider": "synthetic", "feed": "synthetic", "entitlement": "unknown", "numeric_encoding": "decimal_token"}, "generation": "1", "sequence": str(i + 1), "source_timestamp": stamp(sec), "received_timestamp": stamp(sec), "event": event})
    return out


def window(**changes):
    base = {"start": START, "end": START + 4 * time.MINUTE, "session_start": START, "session_end": START + 390 * time.MINUTE, "symbols": ("QQQ",), "available_at": START + time.HOUR, "trade_date": "2026-10-08", "session_id": "XNYS:2026-10-08", "policy_id": "p", "policy_sha256": SHA}
    return B.BarWindow(**(base | changes))


@pytest.fixture
def write_lines(tmp_path):
    def write(lines):
        path = tmp_path / f"{random.random()}.jsonl"
        path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\r\n\n")
        return f"file://{path}"

    return write


def test_seven_events_make_four_bars(spark, write_lines, tmp_path):
    events = envelopes.read_envelopes(spark, write_lines(seven()))
    assert events.count() == 7 and B.broken_rules(envelopes.as_event_v1(events), envelopes.event_rules()).isEmpty()
    bars = B.trade_bars(events, window())
    got = bars.collect()
    assert bars.schema.fieldNames() == TRADE_BAR.fieldNames()
    assert [(r.open, r.high, r.low, r.close, r.volume, r.trade_count, r.quote_events_excluded) for r in got] == [
        ("10.000", "10.5", "10", "10.500", "5", 2, 1), ("10.250", "10.75", "10.25", "10.750", "5", 2, 0), ("10.625", "10.625", "10.625", "10.625", "2", 1, 0), ("10.875", "10.875", "10.875", "10.875", "3", 1, 0),
    ]
    assert got[0].source_end_exclusive_utc == START + 50 * time.SECOND + 1
    assert {r.window_empty_trade_minutes for r in got} == {0} and got[0].completion_mode == "synthetic_eof"
    path = f"file://{tmp_path}/bars"
    manifest = datasets.write(bars, path, "trade_bar")
    assert manifest["rows"] == 4 and datasets.verify(spark, path, "trade_bar") == manifest and manifest["fingerprint"] == fingerprint("trade_bar")
    assert datasets.query_bars(spark, path, "QQQ").count() == 4 and datasets.query_bars(spark, path, "SPY").count() == 0
    with pytest.raises(errors.InputLimit):
        datasets.query_bars(spark, path, most=3)
    with pytest.raises(Exception, match="exists"):
        datasets.write(bars, path, "trade_bar")
    datasets.export_jsonl(bars, f"file://{tmp_path}/out")
    assert json.loads(spark.read.text(f"file://{tmp_path}/out").first()[0])["trade_count"] in {"1", "2"}


@pytest.mark.parametrize(("change", "error"), [
    ({"symbols": ("QQQ", "SPY")}, errors.IncompleteWindow), ({"symbols": ("SPY",)}, errors.UnexpectedSymbol), ({"end": START + 3 * time.MINUTE}, errors.IncompleteWindow), ({"mode": "historical"}, errors.IncompleteWindow),
    ({"input_eof": False}, errors.IncompleteWindow), ({"available_at": START}, errors.IncompleteWindow), ({"session_start": START + 1}, errors.Contract), ({"source_is_paged": True}, errors.IncompleteWindow),
    ({"symbols": tuple(f"S{i}" for i in range(501))}, errors.InputLimit),
])
def test_a_batch_fails_as_a_whole(spark, write_lines, change, error):
    events = envelopes.read_envelopes(spark, write_lines(seven()))
    with pytest.raises(error):
        B.trade_bars(events, window(**change))


def test_sparse_minutes_are_declared(spark, write_lines):
    events = envelopes.read_envelopes(spark, write_lines(seven()[:3]))
    (bar,) = B.trade_bars(events, window(end=START + 2 * time.MINUTE)).collect()
    assert (bar.window_expected_minutes, bar.window_empty_trade_minutes) == (2, 1)


@pytest.mark.parametrize("line", ["{}", '{"event": {}, "control": 1}', "[1]", "no json", '{"event": {"kind": "a", "kind": "b"}}', '{"event": {}, "extra": 1}', '{"event": {}, "event": {}}', '{"event": {"symbol": "' + "x" * 17000 + '"}}'])
def test_bad_lines_stop_the_scan(spark, write_lines, line):
    with pytest.raises(errors.TickloomError):
        envelopes.read_envelopes(spark, write_lines([*seven(), line]))


def test_rules_name_what_is_broken(spark, write_lines):
    bars = B.trade_bars(envelopes.read_envelopes(spark, write_lines(seven())), window())
    assert B.broken_rules(bars, B.bar_rules()).isEmpty() and B.grid_violations(bars).isEmpty()
    for column, value, rule in (("high", "1", "high_low"), ("volume", "0", "positive_volume"), ("bar_end_exclusive_utc", 5, "bar_length"), ("nbbo_input_status", "x", "quotes_excluded"), ("completion_mode", "historical_eof_paged", "completion"), ("session_id", " x", "labels")):
        bent = bars.withColumn(column, F.lit(value))
        assert rule in {r.rule for r in B.broken_rules(bent, B.bar_rules()).collect()}
    assert B.grid_violations(bars.limit(3)).first().rule == "undeclared_gap"


def plain_classes(stream):
    g = s = 0
    for generation, number in stream:
        if g and generation < g:
            yield "stale_generation"
        elif generation > g:
            g, s = generation, number
            yield "accept"
        elif number <= s:
            yield "duplicate_or_reordered"
        else:
            yield "gap" if number > s + 1 else "accept"
            s = number


@pytest.mark.parametrize("width", [3, 1000])
def test_sequence_classes(spark, width):
    rng = random.Random(width)
    streams = {f: [(rng.randint(1, 3), rng.randint(1, 12)) for _ in range(60)] for f in "abc"}
    rows = [(f, g, s, i) for f, stream in streams.items() for i, (g, s) in enumerate(stream)]
    out = sequence.classify(spark.createDataFrame(rows, "feed string, generation long, sequence long, arrival long"), ["feed"], "arrival", width)
    got = {f: [r.decision for r in out.where(F.col("feed") == f).orderBy("arrival").collect()] for f in streams}
    assert got == {f: list(plain_classes(s)) for f, s in streams.items()}
    gap = out.where("decision = 'gap'").first()
    assert gap.missing_last == gap.sequence - 1 and gap.missing_first <= gap.missing_last


def test_time_and_decimals(spark):
    ns = [0, 1, -1, 1_791_466_200_000_000_001, -1_500_000_000]
    df = spark.createDataFrame([(n,) for n in ns], "ns long").withColumn("text", time.format_rfc3339(F.col("ns"))).withColumn("back", time.parse_rfc3339(F.col("text")))
    got = df.collect()
    assert [r.back for r in got] == ns and got[2].text == "1969-12-31T23:59:59.999999999Z" and got[0].text == "1970-01-01T00:00:00Z"
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(time.parse_rfc3339(F.lit("2026-10-08T09:30:00.5-04:00"))) == START + time.SECOND // 2
    assert one(time.parse_rfc3339(F.lit("2026-13-08T09:30:00Z"))) is None and one(time.parse_rfc3339(F.lit("x"))) is None
    assert one(time.local_time_ns(F.lit("2026-03-09"), "00:00:00") - time.local_time_ns(F.lit("2026-03-08"), "00:00:00")) == 23 * time.HOUR
    assert [one(values.normal_form(F.lit(x).cast("decimal(38,18)"))) for x in ("1.00", "2", "600.250000000000000001", "100", "0.50")] == ["1", "2", "600.250000000000000001", "100", "0.5"]
    assert one(values.exact(F.lit("12345678901234567890")).cast("string")).startswith("12345678901234567890.")
    assert [one(time.is_canonical_date(F.lit(x))) for x in ("2024-02-29", "2023-02-29", "2024-2-9")] == [True, False, False]
    assert one(values.is_option_symbol(F.lit("SPY261218C00600000"))) and not one(values.is_option_symbol(F.lit("SPY")))
