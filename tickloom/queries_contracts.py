"""More queries over the test tables: rules, contracts, plans and streams, each with the operator that it shows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import market, time, values
from tickloom.operators import bars as B
from tickloom.operators import pairs, reconcile, sequence
from tickloom.plans import mapping, requests, sessions
from tickloom.queries import AS_OF, _bars, _calendar, _events, _parts, _t
from tickloom.sources import envelopes, research
from tickloom.streaming import ingest, ordered

MINUTE, HOUR, DAY = time.MINUTE, time.HOUR, time.DAY


def market_bar_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Daily bars as a provider's; each rule is broken by every seventh of them."""
    n = F.pmod(F.col("bar_start") / DAY + F.col("symbol"), F.lit(7)).cast("int")
    bent = _bars(spark, sf, DAY).withColumn("n", n).select(
        "symbol", "bar_start", F.lit(1).alias("schema_version"), "open", "low", "close", F.when(n == 3, F.col("low") - 1).otherwise(F.col("high")).alias("high"),
        F.when(n == 1, -1).when(n == 2, 0).otherwise(F.col("volume")).alias("volume"), F.col("bar_start").alias("bar_start_utc"), (F.col("bar_start") + F.when(n == 4, 0).otherwise(DAY)).alias("bar_end_exclusive_utc"),
        F.when(n == 5, "  ").otherwise("p1").alias("provenance_id"), F.lit("s1").alias("session_instance_id"), F.when(n == 6, "2d").otherwise("1d").alias("resolution"),
    )
    return B.broken_rules(bent, B.market_bar_rules()).select("symbol", "bar_start", "rule")


def trade_bar_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Minute bars in windows of a day; most rules are broken by every sixteenth of them."""
    bars = _bars(spark, sf, MINUTE)
    day = time.bucket_start(F.col("bar_start"), 0, DAY)
    n = F.pmod(F.col("bar_start") / MINUTE + F.col("symbol"), F.lit(16)).cast("int")
    to = lambda k, value, other: F.when(n == k, value).otherwise(other)
    full = bars.select(
        "symbol", "bar_start", to(1, 2, 1).alias("schema_version"), F.col("bar_start").alias("bar_start_utc"), (F.col("bar_start") + to(14, 2 * MINUTE, MINUTE)).alias("bar_end_exclusive_utc"),
        day.alias("session_start_utc"), (day + DAY - to(2, MINUTE, 0)).alias("session_end_exclusive_utc"), day.alias("window_start_utc"), (day + DAY).alias("window_end_exclusive_utc"),
        (day + DAY - to(4, 1, 0)).alias("available_at_utc"), (F.col("source_start") - to(3, DAY, 0)).alias("source_start_utc"), F.col("source_end").alias("source_end_exclusive_utc"),
        "open", "close", to(15, F.lit(-1), F.col("low")).alias("low"), to(5, F.col("low") - 1, F.col("high")).alias("high"), to(6, F.lit(0), F.col("volume")).alias("volume"),
        to(7, F.lit(0), F.col("trade_count")).alias("trade_count"), F.lit(0).alias("source_timestamp_missing_rows"), F.lit(0).alias("sequence_gap_count"), to(8, 1, 0).alias("late_event_count"),
        to(9, 1439, 1440).alias("window_expected_minutes"), F.lit(0).alias("window_empty_trade_minutes"), to(10, "historical_eof_paged", "synthetic_eof").alias("completion_mode"),
        F.lit("synthetic").alias("source_provider"), F.lit("synthetic").alias("source_feed"), F.lit(None).cast("boolean").alias("source_pages_exhausted"), F.lit(True).alias("window_input_eof"),
        to(11, "included", "excluded").alias("nbbo_input_status"), to(12, "", "s1").alias("session_id"), F.sha2(F.lit("policy"), 256).alias("session_policy_sha256"), to(13, "2024-1-5", "2024-01-05").alias("trade_date"),
    )
    return B.broken_rules(full, B.bar_rules()).select("symbol", "bar_start", "rule")


def grid_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Daily bars of each user in one window over all days; some declare another number of empty days."""
    made = _bars(spark, sf, DAY).select("symbol", F.col("bar_start").alias("bar_start_utc"))
    span = made.groupBy("symbol").agg(((F.max("bar_start_utc") - F.min("bar_start_utc")) / DAY + 1).cast("long").alias("expected"), F.count("*").alias("n"))
    k = F.col("symbol")
    full = made.join(span, "symbol").select(
        "symbol", "bar_start_utc", F.col("expected").alias("window_expected_minutes"), (F.col("expected") - F.col("n") + F.when(k % 5 == 1, 1).when((k % 5 == 2) & (F.col("bar_start_utc") / DAY % 2 == 0), 1).otherwise(0)).alias("window_empty_trade_minutes"),
        F.lit("s").alias("session_id"), *[F.lit(0).alias(c) for c in ("session_start_utc", "session_end_exclusive_utc", "window_start_utc", "window_end_exclusive_utc")], F.when((k % 5 == 3) & (F.col("bar_start_utc") / DAY % 2 == 0), 1).otherwise(0).alias("available_at_utc"),
    )
    twice = full.union(full.where(k % 35 == 4))
    return B.grid_violations(twice)


def event_rule_violations(spark: SparkSession, sf: str) -> DataFrame:
    """events as stored events; prices of other kinds, missing sizes and unknown labels break rules."""
    n = F.col("event_id") % 9
    kind = F.when(F.col("kind") == "trade", "stock_trade").when(F.col("kind") == "quote", "stock_quote").otherwise(F.when(n == 0, "news").otherwise("option_quote"))
    trade = F.col("kind") == "trade"
    rows = _events(spark, sf).select(
        "event_id", kind.alias("event_kind"), F.when(n == 1, "maybe").otherwise("authorized").alias("entitlement"), F.when(n == 2, "text").otherwise("decimal_token").alias("numeric_encoding"),
        F.when(trade | (n == 3), F.when(n == 5, "-1.5").otherwise(F.col("price"))).alias("price"), F.when(trade & (n != 4), "1").alias("size"), F.when(~trade, "1.0").alias("bid"), F.when(~trade, "1.5").alias("ask"), F.lit(None).cast("string").alias("bid_size"), F.lit(None).cast("string").alias("ask_size"),
    )
    return B.broken_rules(rows, envelopes.event_rules()).select("event_id", "rule")


def batch_violations(spark: SparkSession, sf: str) -> DataFrame:
    """How many events break each condition of a window: outside it, received too late, of another kind or symbol."""
    t = 1_704_067_200 * time.SECOND
    window = B.BarWindow(start=t + DAY, end=t + 21 * DAY, session_start=t, session_end=t + 31 * DAY, symbols=tuple(range(100)), available_at=t + 22 * DAY)
    rows = _events(spark, sf).select(
        "symbol", F.when(F.col("event_id") % 41 != 0, F.col("source_ns")).alias("source_ns"), (F.col("source_ns") + (F.col("event_id") % 3) * DAY).alias("received_ns"),
        F.when(F.col("event_id") % 43 == 0, "unspecified").otherwise("decimal_token").alias("numeric_encoding"), F.when(F.col("kind") == "trade", B.TRADE).when(F.col("kind") == "quote", B.QUOTE).when(F.col("event_id") % 2 == 0, "control").otherwise("option_trade").alias("event_kind"),
    )
    return B.event_violations(rows, window).groupBy("rule").agg(F.count("*").alias("n"))


def envelope_violations(spark: SparkSession, sf: str) -> DataFrame:
    """JSON lines of envelopes made of events: too long, no object, keys twice, unknown, or event and control together."""
    n, i = F.col("event_id") % 8, F.col("event_id").cast("string")
    event = F.concat(F.lit('"event":{"kind":"stock_trade","price":"1"'), F.when(n == 1, ',"price":"2"').otherwise(""), F.lit("}"))
    line = F.concat(F.lit('{"sequence":"'), i, F.lit('",'), event, F.when(n == 2, ',"control":"x"').when(n == 3, ',"colour":"red"').when(n == 4, ',"sequence":"1"').otherwise(""), F.when(n == 5, F.concat(F.lit(',"source":"'), F.repeat(F.lit("x"), 17_000), F.lit('"'))).otherwise(""), F.when(n == 6, "").otherwise("}"))
    lines = _events(spark, sf).select("event_id", line.alias("line"))
    return envelopes.line_violations(lines).select("event_id", "rule")


def frame_order(spark: SparkSession, sf: str) -> DataFrame:
    rows = _events(spark, sf).select(
        "event_type", "event_id", (F.floor(F.col("event_id") / 3000) + 1 - F.when(F.col("event_id") % 211 == 0, 1).otherwise(0)).cast("long").alias("generation"), (F.col("event_id") - F.when(F.col("event_id") % 97 == 0, 50).otherwise(0)).alias("sequence")
    )
    return sequence.not_increasing(rows, ["event_type"], "event_id").select("event_type", "event_id")


def chunk_adjacency(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    chunks = _t(spark, sf, "orders").groupBy(F.floor(k / 2500).cast("long").alias("capture"), F.floor(k / 500).cast("long").alias("generation"), F.floor(k / 50).cast("long").alias("chunk")).agg(F.min(k).alias("first"), F.max(k).alias("last"))
    bent = chunks.withColumn("last", F.col("last") + F.when(F.col("chunk") % 7 == 0, 1).otherwise(0))
    return sequence.chunk_breaks(bent, ["capture"]).select("capture", "generation", "first", "last")


def capture_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer's orders as chunks of a capture, ten numbers each, four to a generation; some begin one too late."""
    k, i = F.col("o_orderkey"), F.col("i")
    numbered = _t(spark, sf, "orders").select(F.col("o_custkey").alias("capture"), k, (F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey")) - 1).alias("i"))
    chunks = numbered.select(
        "capture", (F.floor(i / 4) + 1).alias("generation"), (i % 4 * 10 + 1 + F.when(k % 97 == 0, 1).otherwise(0)).cast("long").alias("first"), (i % 4 * 10 + 10).cast("long").alias("last"),
        F.lit(10).cast("long").alias("n_frames"), F.sha2(k.cast("string"), 256).alias("digest"),
    )
    return pairs.rollup(chunks, ["capture"], ["n_frames"])


def _segments(spark: SparkSession, sf: str) -> DataFrame:
    """Four stretches for every customer, some not complete, some not adjacent, some crossed by rows."""
    k, i = F.col("session"), F.col("i")
    rows = _t(spark, sf, "customer").select(F.col("c_custkey").alias("session"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("i"))
    return rows.select(
        "session", (i * 100 + F.when((k % 3 == 0) & (i == 1), 5).otherwise(0)).cast("long").alias("start"), (i * 100 + 100).cast("long").alias("end"),
        F.when((k + i) % 5 == 0, "partial").otherwise("complete").alias("status"), F.when((k % 11 == 0) & (i == 2), 1).otherwise(0).alias("n_straddling"),
    )


def session_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.session_bounds(_segments(spark, sf), "session")


def evidence_complete(spark: SparkSession, sf: str) -> DataFrame:
    """Whether evidence covers [50, 250) of each session, after sessions divisible by 13 are taken back to partial."""
    evidence = reconcile.downgraded(_segments(spark, sf), F.col("session") % 13 == 0)
    return reconcile.is_complete(evidence, "session", 50, 250)


def sub_window(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of [20, 180) served from sessions that have it whole."""
    rows = _t(spark, sf, "orders").select(F.col("o_custkey").alias("session"), "o_orderkey", (F.col("o_orderkey") % 230).cast("long").alias("start"), (F.col("o_orderkey") % 230 + 10).cast("long").alias("end"))
    return reconcile.sub_window(rows, _segments(spark, sf).where("end <= 200"), "session", 20, 180)


def research_order(spark: SparkSession, sf: str) -> DataFrame:
    bars = _t(spark, sf, "orders").select(F.col("o_custkey").alias("symbol"), "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd'T'00:00:00'Z'").alias("event_ts_utc"))
    return research.out_of_order(bars, "o_orderkey").select("symbol", "o_orderkey", "event_ts_utc")


def research_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Declared numbers, firsts and lasts of each customer's orders against those found; some are wrong, some lack."""
    bars = _t(spark, sf, "orders").select(F.col("o_custkey").alias("symbol"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("event_ts_utc"))
    k = F.col("symbol")
    declared = bars.groupBy("symbol").agg(F.count("*").alias("n"), F.min("event_ts_utc").alias("first"), F.max("event_ts_utc").alias("last")).where(k % 31 != 0)
    declared = declared.select("symbol", (F.col("n") + F.when(k % 9 == 1, 1).otherwise(0)).alias("n"), F.when(k % 9 == 2, "1990-01-01").otherwise(F.col("first")).alias("first"), F.when(k % 9 == 3, None).otherwise(F.col("last")).alias("last"))
    more = spark.createDataFrame([(-1, 3, "a", "b")], declared.schema)
    return research.coverage_mismatch(bars, declared.union(more)).select("symbol", "n", "declared_n")


def research_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A page of JSON for each part; every ninth breaks one of the page's rules."""
    n = F.col("p_partkey") % 9
    texts = lambda *x: F.array(*[F.lit(v) for v in x]) if x else F.array().cast("array<string>")
    fixed = {"true": True, "false": False}
    last = F.when(n == 4, "2024-13-01T00:00:00Z").when(n == 7, "2044-01-01T00:00:00Z").otherwise("2024-02-01T00:00:00Z")
    given = {
        "status": F.when(n == 3, "partial").otherwise("ready"), "requested_symbols": texts("A", "B"), "returned_symbols": F.when(n == 5, texts("A")).otherwise(texts("A", "B")), "missing_symbols": F.when(n == 8, texts("B")).otherwise(texts()),
        "requested_range": F.struct(F.lit("2024-01-01T00:00:00Z").alias("start"), last.alias("end"), F.lit("start_inclusive_end_exclusive").alias("semantics")),
        "coverage": F.struct(F.when(n == 6, 2).otherwise(1).alias("bar_count")), "bars": F.array(F.struct(F.lit("A").alias("symbol"))), "canonical": n == 2,
    }
    columns = [given.get(k, F.lit(fixed.get(v := research.PAGE_VALUES.get(k, "x"), v))).alias(k) for k in research.PAGE_KEYS]
    page = F.when(n == 1, F.regexp_replace(F.to_json(F.struct(*columns)), '"freshness"', '"stale"')).otherwise(F.to_json(F.struct(*columns)))
    # keys are few bytes, their pages much work: dealt to all cores, however small the file
    parts = _t(spark, sf, "part").select("p_partkey").repartition(4 * spark.sparkContext.defaultParallelism, "p_partkey")
    pages = parts.select("p_partkey", page.alias("page"))
    return B.broken_rules(research.with_parts(pages), research.page_rules()).select("p_partkey", "rule")


def session_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Parts' sizes as sessions: conflicts of each, and whether the batch falls."""
    statuses = reconcile.compared(*_parts(spark, sf), ["p_size", "p_partkey"], {"price": "0.01"}, ["p_brand"])
    return reconcile.session_verdicts(statuses, "p_size")


def shared_stretch(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of odd and even keys as two versions of a customer's bars, compared where both cover the time."""
    at = time.ns_of(F.col("o_orderdate"))
    rows = _t(spark, sf, "orders").select(F.col("o_custkey").alias("session"), at.alias("start"), (at + DAY).alias("end"), F.col("o_orderstatus").alias("state"), "o_orderkey")
    version = lambda odd: rows.where((F.col("o_orderkey") % 2 == odd) | (F.col("o_orderkey") % 3 == 0)).groupBy("session", "start", "end").agg(F.min("state").alias("state"))
    out = reconcile.compared_inside(version(0), version(1), "session", ["session", "start"], {}, ["state"])
    return out.select("session", "start", "status")


def page_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Turns of conversations as pages; some have the token of another page, some the receive time of the one before."""
    c, t = F.col("conv_id"), F.col("turn").cast("long")
    token = F.when(t > 0, F.when((c % 6 == 1) & (t == 2), "x").otherwise(F.concat(F.lit("t"), t)))
    after = F.when((c % 6 == 3) & (t == 1), None).otherwise(F.concat(F.lit("t"), t + 1))
    pages = _t(spark, sf, "conversations").select("conv_id", t.alias("number"), token.alias("token"), after.alias("next_token"), (t * 10 - F.when((c % 6 == 2) & (t == 1), 10).otherwise(0)).alias("received_ns"))
    return reconcile.broken_pages(pages, ["conv_id"]).select("conv_id", "number")


def bag_match(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that two versions of lineitem do not hold equally often; nulls equal nulls."""
    k = F.col("l_orderkey")
    left = _t(spark, sf, "lineitem").select(F.when(k % 4 != 0, F.col("l_partkey") % 50).alias("a"), "l_returnflag", "l_linenumber")
    right = _t(spark, sf, "lineitem").select(F.when(k % 4 != 0, F.col("l_partkey") % 50).alias("a"), F.when((k % 1000 == 5), "Z").otherwise(F.col("l_returnflag")).alias("l_returnflag"), "l_linenumber")
    return reconcile.bag_difference(left, right)


def plan_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of a plan for the second week of January, per source, in every mode."""
    days, instances = _calendar(spark, sf)
    return _plans(spark, days, instances, "groups").select("mode", "provider", "feed", "interval", "start", "end", "n_slices")


def plan_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The same plans' runs of one source, newest first."""
    days, instances = _calendar(spark, sf)
    return _plans(spark, days, instances, "runs").select("mode", "run", "provider", "feed", "oldest_start", "newest_start", "n_slices")


CAPABILITY = "provider string, feed string, phase string, interval string, historical boolean, realtime boolean, priority int"


def _capabilities(spark: SparkSession) -> DataFrame:
    rows = [("alpaca", "sip", p, "1m", p != "after", False, 1) for p in ("pre", "regular", "after")] + [("futu", None, p, "1m", p != "after", p == "after", 1) for p in ("pre", "regular", "after")]
    return spark.createDataFrame(rows, CAPABILITY)


def _plans(spark: SparkSession, days: DataFrame, instances: DataFrame, part: str) -> DataFrame:
    """One part of the plans of three requests that differ in their mode, which is their id."""
    start, end = AS_OF["open"] - 7 * DAY, AS_OF["open"] + DAY
    rows = [(mode, "QQQ", start, end, AS_OF["open"], "1m", "all", mode, "unadjusted", False) for mode in ("auto", "alpaca_only", "futu_only")]
    asked = spark.createDataFrame(rows, "request_id string, symbol string, start long, end long, as_of long, resolution string, scope string, mode string, adjustment string, allow_daily_downgrade boolean")
    return requests.plan_requests(asked, days, instances, _capabilities(spark))[part].withColumn("mode", F.col("request_id"))


def provider_policy(spark: SparkSession, sf: str) -> DataFrame:
    """Which capabilities of provider B its policy permits, by the hour of the request and its mode."""
    days, instances = _calendar(spark, sf)
    given = _capabilities(spark)
    out = None
    for case, at in AS_OF.items():
        for mode in ("auto", "futu_only", "alpaca_only"):
            request = sessions.Request("QQQ", at - 3 * DAY, at + DAY, scope="all", mode=mode)
            made = sessions.attempt_capabilities(request, at, days, instances, given.where("provider = 'alpaca'"), given.where("provider = 'futu'"))
            made = made.select(F.lit(case).alias("case"), F.lit(mode).alias("mode"), "provider", "phase")
            out = made if out is None else out.union(made)
    return out


def null_volume_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly bars of a provider that leaves out some volumes: gaps inside the request, and rows kept, per user."""
    a, b = 1_704_887_000 * time.SECOND, 1_705_500_000 * time.SECOND
    rows = _bars(spark, sf).select("symbol", F.col("bar_start").alias("start"), (F.col("bar_start") + HOUR).alias("end"), F.when(F.col("trade_count") + F.col("symbol") % 3 != 3, F.col("volume")).alias("volume"))
    found = mapping.null_volume_rows(rows, a, b)
    kept = found["rows"].agg(F.count("*").alias("n"))
    return found["gaps"].groupBy("start", "end", "reason").agg(F.count("*").alias("n")).union(kept.select(F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit("rows"), "n"))


def scalar_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Option symbols, canonical dates, bars' ends and widths, priorities and provider names."""
    k = F.col("p_partkey")
    pick = lambda n, *xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (k % n + 1).cast("int"))
    option = F.concat(pick(3, "SPY", "TOOLONGS", ""), F.lit("240119"), pick(4, "C", "P", "X", "C"), F.lpad(k.cast("string"), 8, "0"))
    date = F.concat(F.lit("2024-"), pick(2, "02", "2"), F.lit("-"), F.lpad((k % 32).cast("string"), 2, "0"))
    resolution, reason = pick(6, "1m", "5m", "15m", "1h", "1d", "1w"), pick(8, *market.MAPPING_PRIORITY, "other")
    at = k * MINUTE
    return _t(spark, sf, "part").select(
        "p_partkey", values.is_option_symbol(option).alias("option"), time.is_canonical_date(date).alias("date"), market.width_of(resolution).alias("width"), market.bar_end(at, resolution, at + 20 * MINUTE).alias("bar_end"),
        market.priority_of(reason, market.RESPONSE_PRIORITY).alias("priority"), values.same_provider(pick(3, "Alpaca", "futu", "Mixed"), pick(2, "alpaca", "FUTU")).alias("same"),
        market.in_scope(pick(4, *market.SCOPES["all"]), pick(5, "all", "regular", "extended", "overnight", "none")).alias("scope"),
    )


def overnight_routes(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as capabilities: overnight ones need a route of their provider and feed."""
    k = F.col("s_suppkey")
    pick = lambda n, *xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (k % n + 1).cast("int"))
    rows = _t(spark, sf, "supplier").select("s_suppkey", pick(3, "a", "b", "c").alias("provider"), pick(5, "x", None, "y", "z", "x").alias("feed"), pick(4, *market.SCOPES["all"]).alias("phase"))
    routes = spark.createDataFrame([("a", "x"), ("b", None), ("b", None), ("c", "q")], "provider string, feed string")
    return sessions.overnight_capabilities(rows, routes).select("s_suppkey", "provider", "feed", "phase")


def key_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "customer").select("c_custkey", reconcile.key_fingerprint({"symbol": F.col("c_name"), "limit": F.col("c_nationkey"), "mode": F.lit("auto")}).alias("fingerprint"))


def sources_of_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Facts of each nation's customers as datasets: some mix market segments, none repeats a key."""
    rows = _t(spark, sf, "customer").withColumn("at", F.col("c_custkey").cast("long") * MINUTE)
    out = None
    for case, identity in (("segment", ["c_mktsegment"]), ("none", ["kind"])):
        facts = B.dataset_facts(rows.withColumn("kind", F.lit("one")), identity, "c_nationkey", "at", "at", ["c_custkey"]).withColumn("case", F.lit(case))
        out = facts if out is None else out.union(facts)
    return out


def _purchases(events: DataFrame) -> DataFrame:
    return events.where("event_type = 'purchase'").select("user_id", F.col("ts").cast("timestamp").alias("at"), F.col("event_id").alias("arrival"), F.col("value").cast("decimal(18,4)").alias("price"), F.get_json_object("props", "$.k").cast("decimal(38,18)").alias("size"))


def _streamed(spark: SparkSession, sf: str, rows, made, files: int = 16) -> DataFrame:
    """A stream of the event files, run to its end; rows and made: DataFrame -> DataFrame."""
    schema = T.StructType(spark.read.parquet(f"{sf}/events.parquet").schema.fields)
    return ordered.run_whole(spark, lambda own: rows(ingest.read_events(own, f"{sf}/event[s].parquet", schema, files)), "at", made)


def _seconds(rows: DataFrame) -> int:
    """The time that rows span: no file can be further behind than that."""
    span = rows.agg(F.max("at").alias("b"), F.min("at").alias("a")).first()
    return int((span["b"] - span["a"]).total_seconds()) + 1 if span["b"] else 1


def stream_bars_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly bars of the purchases as a stream of files, an hour behind the latest; later rows correct them."""
    late = 1000 * _seconds(_purchases(_t(spark, sf, "events")))
    log = _streamed(spark, sf, _purchases, lambda rows: ordered.lasting_bars(rows, ["user_id"], "1 hour", HOUR // 1_000_000, late))
    number = lambda c: F.col(c).cast("double").alias(c)
    return ordered.final_bars(log, ["user_id"]).select("user_id", time.ns_of(F.col("bar_start")).alias("bar_start"), number("open"), number("high"), number("low"), number("close"), number("volume"), "trade_count")


def stream_accounts(spark: SparkSession, sf: str) -> DataFrame:
    """Purchases of each user in daily bars that wait a day and are corrected for another, and those that came later
    still: together all, whichever files came last."""
    log = _streamed(spark, sf, _purchases, lambda rows: ordered.lasting_bars(rows, ["user_id"], "1 day", DAY // 1_000_000, DAY // 1_000_000), 1)
    kept, late = ordered.final_bars(log, ["user_id"]).select("user_id", "trade_count"), ordered.late_rows(log, ["user_id"]).select("user_id", F.lit(1).alias("trade_count"))
    return kept.union(late).groupBy("user_id").agg(F.sum("trade_count").alias("n"))


def _messages(events: DataFrame) -> DataFrame:
    """Events as numbered messages: neighbours change places, and every 97th comes 5000 later."""
    k = F.col("event_id")
    at = (k + F.when(k % 97 == 0, 5000).when(k % 2 == 0, 3).otherwise(0)) * 100_000_000 + k
    rows = events.select(F.lit("p").alias("provider"), F.col("event_type").alias("feed"), (F.floor(k / 3000) + 1).cast("long").alias("generation"), k.cast("long").alias("sequence"), at.cast("long").alias("arrival"))
    return rows.withColumn("at", F.timestamp_micros(F.floor(F.col("arrival") / 1000)))


def stream_sequence(spark: SparkSession, sf: str) -> DataFrame:
    """Messages of a stream, held back and classified in order of arrival; counted by decision."""
    delay = f"{_seconds(_messages(_t(spark, sf, 'events')))} seconds"
    decided = _streamed(spark, sf, _messages, lambda rows: ordered.classify_in_order(rows, delay))
    return decided.groupBy("feed", "decision").agg(F.count("*").alias("n"), F.sum("sequence").alias("sequence_sum"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        market_bar_violations, trade_bar_violations, grid_rules, event_rule_violations, batch_violations, envelope_violations, frame_order, chunk_adjacency, capture_rollup, session_bounds, evidence_complete, sub_window,
        research_order, research_coverage, research_pages, session_batch, shared_stretch, page_chain, bag_match, plan_groups, plan_runs, provider_policy, null_volume_gaps, scalar_checks, overnight_routes,
        key_fingerprints, sources_of_bars, stream_bars_to_end, stream_accounts, stream_sequence,
    )
}
