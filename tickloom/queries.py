"""The queries over the test tables, each with the operator that it shows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import market, time, values
from tickloom.operators import bars as B
from tickloom.operators import intervals as I
from tickloom.operators import pairs, paging, reconcile, sequence
from tickloom.plans import choice, mapping, sessions
from tickloom.sources import calendar, research

HOUR, DAY = time.HOUR, time.DAY


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _events(spark: SparkSession, sf: str) -> DataFrame:
    """events as messages: purchases are trades, views are quotes; prices as tokens of four digits."""
    kind = F.when(F.col("event_type") == "purchase", "trade").when(F.col("event_type") == "view", "quote").otherwise("other")
    return _t(spark, sf, "events").select(
        F.col("user_id").alias("symbol"), "event_id", "event_type", kind.alias("kind"), time.ns_of(F.col("ts")).alias("source_ns"), F.col("event_id").alias("sequence"), F.col("event_id").alias("ordinal"),
        F.col("value").cast("decimal(18,4)").cast("string").alias("price"), F.get_json_object("props", "$.k").alias("size"), "props",
    )


def _bars(spark: SparkSession, sf: str, width: int = HOUR) -> DataFrame:
    return B.ohlcv(_events(spark, sf), ["symbol"], 0, width, F.col("kind") == "trade", F.col("kind") == "quote")


def _numbers(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles, for comparison with another engine."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if f.dataType.simpleString().startswith("decimal") else F.col(f.name) for f in df.schema.fields])


def bars_ohlcv(spark: SparkSession, sf: str) -> DataFrame:
    out = _bars(spark, sf).withColumns({"open": values.exact(F.col("open")), "close": values.exact(F.col("close"))})
    return _numbers(out.drop("quote_events_excluded"))


def bars_with_quote_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _bars(spark, sf, DAY).select("symbol", "bar_start", "trade_count", "quote_events_excluded")


def bars_sparse_grid(spark: SparkSession, sf: str) -> DataFrame:
    made = _bars(spark, sf, DAY).select("symbol", "bar_start")
    spans = made.groupBy("symbol").agg(F.min("bar_start").alias("start"), (F.max("bar_start") + DAY).alias("end"))
    return B.missing_minutes(made, ["symbol"], spans, DAY)


def bar_rule_violations(spark: SparkSession, sf: str) -> DataFrame:
    bars = _bars(spark, sf, DAY).withColumn("n", F.pmod(F.col("bar_start") / DAY + F.col("symbol"), F.lit(7)).cast("int"))
    price = lambda c: values.exact(F.col(c))
    bent = bars.withColumn("high", F.when(F.col("n") == 1, F.col("low") - 1).otherwise(F.col("high"))).withColumn("volume", F.when(F.col("n") == 2, 0).otherwise(F.col("volume"))).withColumn("source_end", F.when(F.col("n") == 3, F.col("bar_start") + 2 * DAY).otherwise(F.col("source_end")))
    rules = {
        "high_low": (price("low") <= price("open")) & (price("low") <= price("close")) & (price("open") <= price("high")) & (price("close") <= price("high")),
        "positive_volume": F.col("volume") > 0,
        "source_in_bar": (F.col("source_start") >= F.col("bar_start")) & (F.col("source_end") <= F.col("bar_start") + DAY),
    }
    return B.broken_rules(bent, rules).select("symbol", "bar_start", "rule")


def dataset_facts(spark: SparkSession, sf: str) -> DataFrame:
    rows = _events(spark, sf).withColumn("provider", F.lit("synthetic")).withColumn("end_ns", F.col("source_ns") + 1)
    return B.dataset_facts(rows, ["provider"], "symbol", "source_ns", "end_ns", ["symbol", "source_ns"])


def source_label_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = _events(spark, sf).withColumn("day", F.floor(F.col("source_ns") / DAY).cast("long")).withColumn("provider", F.when(F.col("kind") == "trade", "a").when(F.col("kind") == "quote", "b"))
    return rows.groupBy("symbol", "day").agg(market.summary_label("provider").alias("label"))


def sequence_gaps(spark: SparkSession, sf: str) -> DataFrame:
    rows = _events(spark, sf).select(F.col("event_type").alias("feed"), F.lit(1).cast("long").alias("generation"), "sequence", F.col("event_id").alias("arrival"))
    return sequence.classify(rows, ["feed"], "arrival").where("decision = 'gap'").select("feed", "sequence", "missing_first", "missing_last")


def sequence_classes(spark: SparkSession, sf: str) -> DataFrame:
    rows = _events(spark, sf).select(
        F.col("event_type").alias("feed"), (F.floor(F.col("event_id") / 3000) + 1).cast("long").alias("generation"), "sequence",
        # neighbours change places, and every 97th message comes 5000 later
        (F.col("event_id") + F.when(F.col("event_id") % 97 == 0, 5000).otherwise(F.when(F.col("event_id") % 2 == 0, 3).otherwise(0))).alias("at"), "event_id",
    )
    rows = rows.withColumn("arrival", F.col("at") * 100_000_000 + F.col("event_id"))
    return sequence.classify(rows, ["feed"], "arrival", 10_000_000_000_000).groupBy("feed", "decision").agg(F.count("*").alias("n"), F.sum("sequence").alias("sequence_sum"))


def _dates(spark: SparkSession, sf: str) -> DataFrame:
    """From the first day of events to the day after the last."""
    span = _t(spark, sf, "events").agg(F.min(F.to_date("ts")).alias("a"), F.date_add(F.max(F.to_date("ts")), 1).alias("b"))
    return span.select(F.explode(F.sequence("a", "b")).alias("d"))


def _calendar(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The calendar of the days that events span."""
    days = calendar.civil_days_of(_dates(spark, sf), ("2024-01-01", "2024-01-15"))
    return days, calendar.phase_instances(days)


def phase_assignment(spark: SparkSession, sf: str) -> DataFrame:
    _, instances = _calendar(spark, sf)
    rows = _events(spark, sf).select("event_id", F.col("source_ns").alias("start"), (F.col("source_ns") + 60 * time.SECOND).alias("end"))
    return I.contained_in_one(rows, instances, ["session_instance_id"]).select("event_id", "session_instance_id")


AS_OF = {"open": 1_704_985_200 * time.SECOND, "closed": 1_705_190_400 * time.SECOND}


def session_rank(spark: SparkSession, sf: str) -> DataFrame:
    _, instances = _calendar(spark, sf)
    parts = [sessions.ranked(instances, at).select(F.lit(case).alias("case"), "session_instance_id", "position", "active", "rank") for case, at in AS_OF.items()]
    return parts[0].union(parts[1])


def asof_session(spark: SparkSession, sf: str) -> DataFrame:
    months = spark.range(1).select(F.explode(F.sequence(F.lit("1995-02-01").cast("date"), F.lit("2001-06-01").cast("date"), F.expr("interval 1 month"))).alias("d"))
    instances = months.select(time.ns_of(F.col("d").cast("timestamp")).alias("start"), F.date_format("d", "yyyy-MM").alias("instance"))
    rows = _t(spark, sf, "orders").select("o_orderkey", time.ns_of(F.col("o_orderdate")).alias("at"))
    return I.latest_before(rows, instances, "at", ["instance"]).select("o_orderkey", "instance")


def provider_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of one event type per user; errors cannot be fetched, and break no run."""
    out = sessions.runs(_events(spark, sf), ["symbol"], "event_id", "event_type", F.col("event_type") != "error")
    return out.select("symbol", "run", "event_type", F.col("first").alias("first_id"), F.col("last").alias("last_id"), "n_slices")


def route_choice(spark: SparkSession, sf: str) -> DataFrame:
    _, instances = _calendar(spark, sf)
    old = spark.createDataFrame([("2015-12-31", "regular", "old"), ("2015-12-31", "over", "old"), ("2024-01-11", "over", "new")], "trade_date string, phase string, rank string")
    slices = sessions.ranked(instances, AS_OF["open"]).select("trade_date", "phase", "rank").union(old)
    modes = F.explode(F.array(*[F.lit(m) for m in ("auto", "alpaca_only", "futu_only", "research")])).alias("mode")
    grid = slices.select("*", modes).select("*", F.explode(F.array(F.lit("1m"), F.lit("1d"))).alias("interval"))
    picked = grid.withColumn("c", choice.choice(F.col("mode"), F.col("trade_date"), F.col("interval") == "1d", F.col("phase"), F.col("rank")))
    caps = spark.createDataFrame([("futu", None, "regular", "1m", True, True, 1), ("futu", None, "regular", "1m", False, False, 2), ("alpaca", "sip", "regular", "1m", True, False, 1), ("alpaca", "sip", "pre", "1m", False, True, 1)], "provider string, feed string, phase string, interval string, historical boolean, realtime boolean, priority int")
    flat = picked.select("trade_date", "phase", "mode", "interval", "rank", F.col("c.provider").alias("provider"), F.col("c.feed").alias("feed"), F.col("c.gap").alias("choice_gap")).withColumns({"start": F.lit(0).cast("long"), "end": F.lit(1).cast("long"), "active": F.lit(False), "market_closed": F.lit(False)})
    return choice.with_capability(flat, caps, 5).select("trade_date", "phase", "mode", "interval", "provider", "feed", "gap", "historical")



def _order_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """orders as gaps per customer; the reason and the length follow from the key."""
    reasons = F.array(*[F.lit(r) for r in market.MAPPING_PRIORITY])
    day = time.ns_of(F.col("o_orderdate"))
    return _t(spark, sf, "orders").select(
        F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("id"), day.alias("start"), (day + (F.col("o_orderkey") % 200 + 1) * DAY).alias("end"), F.element_at(reasons, (F.col("o_orderkey") % 7 + 1).cast("int")).alias("reason")
    )


def gap_normalize_map(spark: SparkSession, sf: str) -> DataFrame:
    return I.normalize_gaps(_order_gaps(spark, sf), ["key"], market.MAPPING_PRIORITY)


def gap_normalize_response(spark: SparkSession, sf: str) -> DataFrame:
    return I.normalize_gaps(_order_gaps(spark, sf), ["key"], market.RESPONSE_PRIORITY)


def gap_merge(spark: SparkSession, sf: str) -> DataFrame:
    return I.merge_overlapping(_order_gaps(spark, sf), ["key"])


def _years(spark: SparkSession, sf: str) -> DataFrame:
    """The year 1996 and the year 1999 of every customer."""
    years = F.explode(F.array(F.struct(F.lit(1996).alias("year"), F.lit(820454400).alias("a"), F.lit(852076800).alias("b")), F.struct(F.lit(1999).alias("year"), F.lit(915148800).alias("a"), F.lit(946684800).alias("b"))))
    return _t(spark, sf, "customer").select(F.col("c_custkey").alias("key"), years.alias("y")).select("key", "y.year", (F.col("y.a").cast("long") * time.SECOND).alias("start"), (F.col("y.b").cast("long") * time.SECOND).alias("end"))


def uncovered_windows(spark: SparkSession, sf: str) -> DataFrame:
    return I.uncovered(_years(spark, sf), _order_gaps(spark, sf), ["key"], ["year"])


def segment_minus_gap(spark: SparkSession, sf: str) -> DataFrame:
    segments = _order_gaps(spark, sf).select(F.col("id").alias("key"), "start", "end")
    ship = time.ns_of(F.col("l_shipdate"))
    gaps = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key"), ship.alias("start"), (ship + 3 * DAY).alias("end"))
    return I.uncovered(segments, gaps, ["key"], [])


def coverage_status(spark: SparkSession, sf: str) -> DataFrame:
    return I.coverage_status(_years(spark, sf), _order_gaps(spark, sf), ["key"]).select("key", "year", "bare", "status")


def tiling_complete(spark: SparkSession, sf: str) -> DataFrame:
    """Six-hour bars of each event type and user group against whole days."""
    rows = _events(spark, sf).select((F.col("symbol") % 8).alias("grp"), "event_type", "source_ns")
    made = rows.select("grp", "event_type", time.bucket_start(F.col("source_ns"), 0, 6 * HOUR).alias("start")).distinct()
    made = made.withColumn("end", F.col("start") + 6 * HOUR).withColumn("day", time.bucket_start(F.col("start"), 0, DAY))
    phases = made.select("grp", "event_type", "day").distinct().select("*", F.col("day").alias("phase_start"), (F.col("day") + DAY).alias("phase_end"))
    return I.tiling(made, phases, ["grp", "event_type", "day"], 6 * HOUR).select("grp", "event_type", "day", "n_bars", "complete")


def overlap_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return I.conflicts(_order_gaps(spark, sf), ["key"], "id").select("key", "id")


def bars_outside_gaps(spark: SparkSession, sf: str) -> DataFrame:
    bars = _bars(spark, sf).select(F.col("symbol").alias("key"), F.col("bar_start").alias("start"), (F.col("bar_start") + HOUR).alias("end"))
    gaps = _events(spark, sf).where("event_type = 'error'").select(F.col("symbol").alias("key"), F.col("source_ns").alias("start"), (F.col("source_ns") + 12 * HOUR).alias("end"))
    return I.outside(bars, gaps, ["key"], ["start", "end"])


def gaps_on_slices(spark: SparkSession, sf: str) -> DataFrame:
    return I.clip_to(_order_gaps(spark, sf), _years(spark, sf), ["key"]).select("key", "id", "start", "end", "reason")


def boundary_bars(spark: SparkSession, sf: str) -> DataFrame:
    bars = _bars(spark, sf).select("symbol", F.col("bar_start").alias("start"), (F.col("bar_start") + HOUR).alias("end"))
    return mapping.clipped_rows(bars, 1_704_887_000 * time.SECOND, 1_705_500_000 * time.SECOND)["gaps"]


def _parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    k, price = F.col("p_partkey"), F.col("p_retailprice").cast("decimal(18,4)")
    old = _t(spark, sf, "part").select("p_partkey", price.alias("price"), "p_brand", "p_size")
    moved = F.col("price") + F.when(k % 25 == 0, F.lit("1.0000").cast("decimal(18,4)")).when(k % 10 == 0, F.lit("0.0050").cast("decimal(18,4)")).otherwise(F.lit("0.0000").cast("decimal(18,4)"))
    new = old.where(k % 40 != 7).select("p_partkey", moved.cast("decimal(18,4)").alias("price"), F.when(k % 90 == 0, "Brand#X").otherwise(F.col("p_brand")).alias("p_brand"), "p_size")
    return old, new.union(old.where(k % 50 == 1).select((k + 10_000_000).alias("p_partkey"), "price", "p_brand", "p_size"))


def reconcile_compare(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.compared(*_parts(spark, sf), ["p_partkey"], {"price": "0.01"}, ["p_brand", "p_size"])


def reconcile_verdict(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.verdict(reconcile_compare(spark, sf), most_added=1000, removed_allowed=True, most_changed=100_000)


def dedupe_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    # payloads with nulls, which move from one column to the next
    part = F.when(F.col("l_partkey") % 3 != 0, F.col("l_partkey") % 5)
    supp = F.when(F.col("l_partkey") % 3 == 0, F.col("l_partkey") % 5)
    rows = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", part.alias("a"), supp.alias("b"), "l_returnflag")
    return reconcile.duplicates(rows, ["l_orderkey", "l_linenumber"]).where("n_payloads > 1")


def dedupe_min_encoding(spark: SparkSession, sf: str) -> DataFrame:
    rows = _t(spark, sf, "documents").select(F.sha2("text", 256).alias("identity"), "doc_id", F.concat_ws("|", "source", "lang", F.lpad(F.col("doc_id").cast("string"), 12, "0")).alias("encoding"))
    return reconcile.smallest_encoding(rows, ["identity"], F.col("encoding"), ["doc_id", "encoding"])


def lineage_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """Every seventh line names a parent that is not there."""
    k = F.col("l_orderkey")
    rows = _t(spark, sf, "lineitem").withColumn("l_orderkey", F.when(k % 7 == 0, -k - 1).otherwise(k)).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return reconcile.orphans(rows, _t(spark, sf, "orders").select("o_orderkey"), ["l_orderkey"], ["o_orderkey"])


def pair_completeness(spark: SparkSession, sf: str) -> DataFrame:
    frames = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("frame"), (F.col("o_orderkey") % 6).alias("expected"))
    events = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("frame"), F.col("l_linenumber").alias("ordinal"))
    return pairs.frame_completeness(frames, events, ["frame"], "ordinal", "expected").select("frame", "declared", "n_events", "n_ordinals", "complete")


def turn_contiguity(spark: SparkSession, sf: str) -> DataFrame:
    """Turns of every fifth conversation run with a gap after the third, of every seventh twice through the second."""
    c, t = F.col("conv_id"), F.col("turn")
    turn = F.when((c % 5 == 0) & (t >= 3), t + 1).when((c % 7 == 0) & (t == 3), t - 1).otherwise(t)
    out = sequence.contiguity(_t(spark, sf, "conversations").select("conv_id", turn.cast("long").alias("turn")), ["conv_id"], "turn")
    return out.select("conv_id", F.col("first").alias("first_turn"), F.col("last").alias("last_turn"), "n_rows", "contiguous")


def keyset_page(spark: SparkSession, sf: str) -> DataFrame:
    rows = _t(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderkey", "o_totalprice")
    return paging.page(rows, ["day", "o_orderkey"], ("2000-06-15", 500), 100)


def session_set_digest(spark: SparkSession, sf: str) -> DataFrame:
    rows = _events(spark, sf).withColumn("day", F.floor(F.col("source_ns") / DAY).cast("long"))
    return rows.groupBy("symbol", "day").agg(values.set_digest(F.collect_set("event_type")).alias("digest"))


def json_shape_violations(spark: SparkSession, sf: str) -> DataFrame:
    bent = F.when(F.col("event_id") % 10 == 0, '{"k": 1, "k": 2}').when(F.col("event_id") % 10 == 1, '{"k": 1, "x": 2}').when(F.col("event_id") % 10 == 2, "{}").otherwise(F.col("props"))
    return _events(spark, sf).withColumn("props", bent).where(~values.has_exact_keys(F.col("props"), ["k"])).select("event_id", "props")


def token_checks(spark: SparkSession, sf: str) -> DataFrame:
    p = _t(spark, sf, "part")
    token = F.when(F.col("p_partkey") % 3 == 0, F.upper(F.regexp_replace("p_name", " ", "."))).otherwise(F.col("p_name"))
    p = p.withColumn("token", token).withColumn("number", F.when(F.col("p_partkey") % 4 == 0, "01.5").when(F.col("p_partkey") % 4 == 1, "1.50").when(F.col("p_partkey") % 4 == 2, "0").otherwise("-2"))
    return p.select(
        "p_partkey", values.is_ticker(F.col("token")).alias("ticker"), values.is_label(F.col("token"), 10).alias("label"), values.is_positive(F.col("number")).alias("positive"),
        values.is_non_negative(F.col("number")).alias("non_negative"), values.is_sha256(F.sha2("p_name", 256)).alias("sha"),
    )


def rfc3339_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    rows = _events(spark, sf).select("event_id", (F.col("source_ns") + F.col("event_id") % 1000).alias("ns"))
    text = rows.withColumn("text", time.format_rfc3339(F.col("ns")))
    return text.select("event_id", "text", time.parse_rfc3339(F.col("text")).alias("ns"))


def decimal_normal_form(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "part").select("p_partkey", values.normal_form(F.col("p_retailprice").cast("decimal(18,4)")).alias("price"))


def digests(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "customer").select("c_custkey", values.digest("customer-v1", F.col("c_name"), F.col("c_mktsegment")).alias("digest"))


def month_shards(spark: SparkSession, sf: str) -> DataFrame:
    """Customers' months as sessions, in shards of 64; some shards weigh too much."""
    month = time.month_key(time.ns_of(F.col("o_orderdate")))
    rows = _t(spark, sf, "orders").groupBy(month.alias("month"), F.lpad(F.col("o_custkey").cast("string"), 8, "0").alias("session")).agg(F.count("*").alias("n_orders"))
    return reconcile.month_shards(rows, "month", "session", F.col("n_orders") * 4000).select("month", "session", "n_orders", "shard_id", "rule")


def symbol_partition(spark: SparkSession, sf: str) -> DataFrame:
    """Per customer the nations asked for, given and missing; some customers miss one too many or have one twice."""
    k = F.col("c_custkey")
    asked = F.array((k % 5).cast("string"), (k % 7 + 10).cast("string"), F.lit("20"))
    given = F.when(k % 4 == 0, asked).otherwise(F.slice(asked, 1, 2))
    lost = F.when(k % 6 == 0, F.array(F.lit("20"), F.lit("21"))).when(k % 4 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("20")))
    rows = _t(spark, sf, "customer").select("c_custkey", asked.alias("asked"), given.alias("given"), lost.alias("lost"))
    return rows.select("c_custkey", F.size("given").cast("long").alias("n_returned"), F.size("lost").cast("long").alias("n_missing"), research.partition_holds(F.col("asked"), F.col("given"), F.col("lost")).alias("holds"))


def authority(spark: SparkSession, sf: str) -> DataFrame:
    o = _t(spark, sf, "orders")
    k = F.col("o_orderkey")
    pick = lambda n, *xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (F.floor(k / n) % len(xs) + 1).cast("int"))
    state = reconcile.authority(pick(1, "alpaca", "futu"), pick(2, "sip", "iex", "boats"), k % 5 != 0, k % 11, k % 13 != 0, pick(3, "signed_admission", "observed_query"), pick(4, "authorized", "unknown"), pick(5, "decimal_token", "integer_token"))
    return o.select("o_orderkey", state.alias("authority"))


def coverage_intersection(spark: SparkSession, sf: str) -> DataFrame:
    g = _order_gaps(spark, sf).withColumn("session", F.col("key"))
    return reconcile.coverage_overlap(g.where("id % 2 = 0"), g.where("id % 2 = 1"), "session")


def chunk_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks of a hundred order keys of lineitem with their digests, and the digest of all."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rows = _t(spark, sf, "lineitem").select(F.floor(F.col("l_orderkey") / 100).cast("long").alias("chunk"), *keys)
    made = pairs.chunk_digests(rows, ["chunk"], keys, keys)
    rollup = pairs.rollup_tree(made, "chunk", 64, 5).select(F.col("digest").alias("rollup"), "n_chunks")
    return made.join(F.broadcast(rollup)).select("chunk", "n_rows", "digest", "rollup", "n_chunks")


def calendar_integrity(spark: SparkSession, sf: str) -> DataFrame:
    """The days of events as a calendar, in which the number of a day's events says which days are lost, which are an
    hour too long and which have their first phase twice."""
    days = calendar.civil_days_of(_dates(spark, sf), ("2024-01-01",))
    phases = calendar.phase_instances(days)
    counts = _t(spark, sf, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("trade_date")).agg(F.count("*").alias("n"))
    of = lambda df: df.join(counts, "trade_date", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    bent = of(days).where("n % 7 <> 3").withColumn("end", F.col("end") + F.when(F.col("n") % 7 == 5, HOUR).otherwise(0)).select(*days.columns)
    twice = phases.union(of(phases).where("n % 5 = 1 and phase = 'pre'").select(*phases.columns))
    return calendar.calendar_violations(bent, twice)


def sessions_in_window(spark: SparkSession, sf: str) -> DataFrame:
    days, instances = _calendar(spark, sf)
    kept, met = sessions.sessions_in_window(days, instances, AS_OF["open"] - 20 * HOUR, AS_OF["open"] + 15 * HOUR)
    return kept.select(F.col("trade_date").alias("subject"), F.lit("day").alias("kind")).union(met.select("session_instance_id", F.lit("instance")))


def edge_windows(spark: SparkSession, sf: str) -> DataFrame:
    days, instances = _calendar(spark, sf)
    return sessions.edge_windows(instances, days)


def overnight_bands(spark: SparkSession, sf: str) -> DataFrame:
    days, _ = _calendar(spark, sf)
    return calendar.overnight_instances(days).select("session_instance_id", "start", "end")


def closed_nights(spark: SparkSession, sf: str) -> DataFrame:
    days, _ = _calendar(spark, sf)
    return calendar.closed_night_bands(days)


def coverage_evidence(spark: SparkSession, sf: str) -> DataFrame:
    rows = _bars(spark, sf).select(F.col("symbol").alias("session"), F.col("bar_start").alias("start"), (F.col("bar_start") + HOUR).alias("end"))
    # a hash that other engines have: the first 60 bits of MD5
    of = F.conv(F.substring(F.md5(F.concat_ws("/", "session", "start", "end").cast("binary")), 1, 15), 16, 10)
    return reconcile.coverage_evidence(rows, _evidence_segments(spark, sf, rows), "session", of).select("session", "start", "end", "n_rows", "n_straddling", "digest")


def coverage_evidence_all(spark: SparkSession, sf: str) -> DataFrame:
    """Evidence with digests of all columns for every customer and every user of events, in segments from the first bar to
    the last. coverage_evidence does the same with a digest of the bars' times that SQL has too.
    """
    rows = _bars(spark, sf).select(F.col("symbol").alias("session"), F.col("bar_start").alias("start"), (F.col("bar_start") + HOUR).alias("end"), "open", "high", "low", "close", "volume", "trade_count")
    return reconcile.coverage_evidence(rows, _evidence_segments(spark, sf, rows), "session").select("session", "start", "end", "n_rows", "n_straddling", "digest")


def _evidence_segments(spark: SparkSession, sf: str, rows: DataFrame) -> DataFrame:
    sessions_ = _t(spark, sf, "customer").select(F.col("c_custkey").alias("session")).union(_t(spark, sf, "events").select("user_id")).where("session is not null").distinct()
    base, step = 1_704_067_200 * time.SECOND, 7 * DAY + HOUR // 2
    number = lambda at: F.floor((at - F.lit(base)) / F.lit(step)).cast("long")
    span = rows.agg(number(F.min("start")).alias("a"), number(F.max("end") - 1).alias("b"))
    segments = sessions_.join(F.broadcast(span)).select("session", F.explode(F.sequence("a", "b")).alias("i"))
    first = F.lit(base) + F.col("i") * step
    return segments.select("session", first.alias("start"), (first + 7 * DAY).alias("end"), F.lit("complete").alias("status"))


#: Order keys to a chunk; an order has few lines, so a chunk's rows do not grow with the table.
CHUNK_KEYS = 1000


def chunk_rollup_all(spark: SparkSession, sf: str) -> DataFrame:
    """Each chunk's digest over all rows and columns of lineitem, and the digest of all chunks.

    Rows of equal order are told apart by their payload's hash. chunk_rollup does the same for the keys, with SQL.
    """
    rows = _t(spark, sf, "lineitem").withColumn("l_shipdate", time.ns_of(F.col("l_shipdate")))
    payload = rows.columns
    rows = rows.withColumn("chunk", F.floor(F.col("l_orderkey") / CHUNK_KEYS).cast("long"))
    made = pairs.chunk_digests(rows, ["chunk"], ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], payload)
    rollup = pairs.rollup_tree(made, "chunk").select(F.col("digest").alias("rollup"), "n_chunks")
    return made.join(F.broadcast(rollup)).select("chunk", "n_rows", "digest", "rollup", "n_chunks")


#: Without SQL: digests over whole tables, held against brute force in the tests.
WITHOUT_SQL: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (chunk_rollup_all, coverage_evidence_all)}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        bars_ohlcv, bars_with_quote_counts, bars_sparse_grid, bar_rule_violations, dataset_facts, source_label_summary, sequence_gaps, sequence_classes, phase_assignment, session_rank, asof_session,
        provider_runs, route_choice, gap_normalize_map, gap_normalize_response, gap_merge, uncovered_windows, segment_minus_gap, coverage_status, tiling_complete, overlap_conflicts, bars_outside_gaps,
        gaps_on_slices, boundary_bars, reconcile_compare, reconcile_verdict, dedupe_conflicts, dedupe_min_encoding, lineage_orphans, pair_completeness, turn_contiguity, keyset_page, session_set_digest,
        json_shape_violations, token_checks, rfc3339_round_trip, decimal_normal_form, digests, month_shards, symbol_partition, authority, coverage_intersection, chunk_rollup, calendar_integrity, sessions_in_window, edge_windows, overnight_bands, closed_nights, coverage_evidence,
    )
}
