"""Queries over tables of requests: every order asks for bars, lineitem holds the bars of its pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import time
from tickloom.plans import pages, requests
from tickloom.queries import _t
from tickloom.session import staged
from tickloom.sources import calendar

HOUR, DAY, MINUTE = time.HOUR, time.DAY, time.MINUTE
#: The calendar of the plans: a fixed zone, so that SQL needs no zone rules.
FIRST, LAST, HOLIDAYS, ZONE = "2013-02-01", "2019-07-31", ("2016-01-01", "2018-12-25"), "Etc/GMT+5"
#: Orders are taken this many days later, so that they lie on both sides of the cutoff.
SHIFT = 6574
CAPABILITIES = [
    ("alpaca", "sip", "pre", "1m", True, False, 1), ("alpaca", "sip", "regular", "1m", True, False, 1), ("alpaca", "sip", "after", "1m", True, False, 1), ("alpaca", "boats", "over", "1m", True, False, 1), ("alpaca", "sip", "regular", "1h", True, False, 1),
    ("alpaca", "sip", None, "1d", True, False, 1), ("futu", None, "regular", "1m", True, True, 1), ("futu", None, "pre", "1m", False, True, 1), ("futu", None, None, "1d", True, False, 1), ("yfinance", "daily", None, "1d", True, False, 1),
]


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    k, at = F.col("o_orderkey"), time.ns_of(F.col("o_orderdate")) + SHIFT * DAY
    of = lambda i, *names: F.element_at(F.array(*[F.lit(n) for n in names]), (F.pmod(i, F.lit(len(names))) + 1).cast("int"))
    start = at + F.pmod(k, F.lit(24)) * HOUR + F.pmod(k, F.lit(7)) * MINUTE
    end = start + (F.pmod(k * 7, F.lit(90)) + 1) * HOUR
    low, high = F.lit(1_359_694_800 * time.SECOND), F.lit(1_564_635_600 * time.SECOND - 1)
    as_of = F.greatest(F.least(start + (F.pmod(k, F.lit(11)) * 9 - 20) * HOUR, high), low)
    return _t(spark, sf, "orders").select(
        k.alias("request_id"), F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("symbol"), start.alias("start"), end.alias("end"), as_of.alias("as_of"), of(k, "1m", "1m", "1h", "1d", "1m").alias("resolution"),
        of(k, "all", "regular", "extended", "overnight").alias("scope"), of(F.floor(k / 4), "auto", "auto", "alpaca_only", "futu_only", "research", "auto").alias("mode"), F.lit("unadjusted").alias("adjustment"), (F.pmod(k, F.lit(3)) == 0).alias("allow_daily_downgrade"),
    )


def _calendar(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """Days, and phases with the night before each day divisible by 3; thirteenths have no phase."""
    days = calendar.civil_days(spark, FIRST, LAST, HOLIDAYS, ZONE)
    phases = calendar.phase_instances(days, None, ZONE).where("trade_date not like '%-13'")
    nights = calendar.overnight_instances(days, ZONE).where("cast(right(trade_date, 2) as int) % 3 = 0")
    return days, phases.unionByName(nights)


def _plan(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    capabilities = spark.createDataFrame(CAPABILITIES, "provider string, feed string, phase string, interval string, historical boolean, realtime boolean, priority int")
    return requests.plan_requests(_requests(spark, sf), *_calendar(spark), capabilities)


def request_slices(spark: SparkSession, sf: str) -> DataFrame:
    return _plan(spark, sf)["slices"].select("request_id", "trade_date", "phase", "start", "end", "interval", "rank", "provider", "feed", "gap", "historical", "realtime", "provisional")


def request_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return _plan(spark, sf)["gaps"].select("request_id", "start", "end", "reason")


def request_groups(spark: SparkSession, sf: str) -> DataFrame:
    return _plan(spark, sf)["groups"].select("request_id", "provider", "feed", "interval", "start", "end", "n_slices", F.col("position").cast("long").alias("position"))


def request_runs(spark: SparkSession, sf: str) -> DataFrame:
    return _plan(spark, sf)["runs"].select("request_id", "run", "provider", "feed", "interval", "oldest_start", "newest_start", "n_slices")


def _mapped(spark: SparkSession, sf: str, plan: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Lineitem as one-minute rows of the pages of its orders' first three runs; sources of five kinds a page.

    Lines whose order has no such run are no page's rows: they go before they take on their request's fields.
    """
    plan = plan or _plan(spark, sf)
    slices = staged(requests.in_runs(plan["slices"]).select(*pages.KEYS, "start", "end", "provider", "feed", "interval", "session_instance_id", "provisional"), "run-slices")
    runs = slices.select(*pages.KEYS, "provider", "feed").distinct()
    asked = staged(_requests(spark, sf).join(slices.select("request_id").distinct(), "request_id", "left_semi"), "asked")
    kinds = [("p0", F.col("provider"), "authorized"), ("p1", F.upper("provider"), "delayed"), ("p2", F.lit("unknown"), "authorized"), ("p3", F.lit("other"), "authorized"), ("p4", F.col("provider"), "unauthorized")]
    kind = F.explode(F.array(*[F.struct(F.lit(i).alias("provenance_id"), p.alias("provider"), F.coalesce("feed", F.lit("own")).alias("feed"), F.lit(e).alias("entitlement")) for i, p, e in kinds]))
    provenance = runs.select(*pages.KEYS, kind.alias("k")).select(*pages.KEYS, "k.*")
    part, line = F.col("l_partkey"), F.col("l_linenumber").cast("long")
    width = F.floor((F.col("end") - F.col("start")) / MINUTE)
    start = F.col("start") + F.pmod(part * 37 + line * 11, width) * MINUTE
    lines = _t(spark, sf, "lineitem").withColumns({"request_id": F.col("l_orderkey"), "run": F.pmod(line, F.lit(3)) + 1}).join(runs.select(*pages.KEYS), pages.KEYS, "left_semi")
    rows = lines.join(asked, "request_id").select(
        *pages.KEYS, F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_id"), F.when(part % 17 == 0, "none").otherwise(F.concat(F.lit("p"), F.col("l_suppkey") % 10 % 5)).alias("provenance_id"),
        start.alias("start"), (start + F.when(part % 19 == 0, 90).otherwise(1) * MINUTE).alias("end"), F.when(part % 23 == 0, "OTHER").otherwise(F.col("symbol")).alias("symbol"), F.lit("stock").alias("asset_class"),
        F.when(F.col("allow_daily_downgrade") & (F.col("resolution") != "1d") & ((F.col("mode") == "research") | (F.col("start") < 1_451_624_400 * time.SECOND)), "1d").otherwise(F.col("resolution")).alias("resolution"), "adjustment", F.when(part % 29 == 0, "conflict").when(part % 7 == 0, "provisional").otherwise("validated").alias("row_state"),
    )
    made = runs.select(*pages.KEYS, F.lit("complete").alias("status"), F.lit(False).alias("truncated"), (F.col("request_id") % 10 != 0).alias("calendar_matches"))
    return pages.map_pages(rows, provenance, slices, asked.withColumn("asset_class", F.lit("stock")), made)


def page_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _mapped(spark, sf)["rows"].select("request_id", "run", "row_id", "start", "end", "session_instance_id", "validation_state")


def page_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return _mapped(spark, sf)["gaps"].select("request_id", "run", "start", "end", "reason")


def page_sources(spark: SparkSession, sf: str) -> DataFrame:
    """The sources that rows of a page come from, of those that it names."""
    return _mapped(spark, sf)["provenance"].select("request_id", "run", "provenance_id", "provider", "entitlement")


def _answered(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Answers of all requests; what they read several times is written once."""
    plan = _plan(spark, sf)
    mapped = _mapped(spark, sf, plan)
    mapped |= {name: staged(mapped[name], name) for name in ("rows", "gaps", "provenance")}
    return pages.answers(mapped, staged(plan["gaps"], "plan-gaps"))


def answer_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of all pages that no gap of the plan or of a page touches."""
    return _answered(spark, sf)["rows"].select("request_id", "run", "row_id", "start", "end", "validation_state")


def answer_summaries(spark: SparkSession, sf: str) -> DataFrame:
    """Per request its rows, whether one of them is provisional, and the labels of their sources."""
    return _answered(spark, sf)["contents"].select("request_id", F.col("n_rows").cast("long").alias("n_rows"), "provisional", "source", "entitlement")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (request_slices, request_gaps, request_groups, request_runs, page_rows, page_gaps, page_sources, answer_rows, answer_summaries)}
