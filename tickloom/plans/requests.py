"""Plans for a table of requests: which source serves which slice of each, as joins with one calendar.

requests: request_id, symbol, start, end, as_of (ns), resolution, scope, mode, adjustment, allow_daily_downgrade.
Nothing is collected to the driver; judged requests and slices, of which all else is made, are written once. Requests meet the calendar in stretches of time, so a month that many ask for is many
tasks where Spark splits skewed joins, and all that is kept per request lies in groups of request_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.functions.market import MAPPING_PRIORITY, RESOLUTIONS, SCOPES, in_scope
from tickloom.functions.time import parse_rfc3339
from tickloom.operators.intervals import by_day, latest_before, normalize_gaps, overlapping, uncovered
from tickloom.plans.choice import CUTOFF, MODES, choice, with_capability
from tickloom.session import staged
from tickloom.sources.calendar import closed_night_bands

#: Limits of one plan; a request beyond them fails as a whole.
MOST_GROUPS, MOST_RANGES = 16, 200_000
REQUEST = ["request_id", "symbol", "start", "end", "as_of", "resolution", "scope", "mode", "adjustment", "allow_daily_downgrade"]


def problem_of(as_of_inside: Column) -> Column:
    """The first rule that a request breaks, or null."""
    option = F.col("symbol").rlike(r"^[A-Z]{1,6}\d{6}[CP]\d{8}$")
    whole = F.lit(True)
    for c in REQUEST:
        whole &= F.col(c).isNotNull()
    return (
        F.when(~whole, "missing_value").when(~F.col("symbol").rlike(r"^[A-Z0-9.\-]{1,32}$") | option, "symbol").when(F.col("start") >= F.col("end"), "window")
        .when(~F.col("resolution").isin(*RESOLUTIONS) | ~F.col("scope").isin(*SCOPES) | ~F.col("mode").isin(*MODES), "resolution, scope or mode").when(~as_of_inside, "as_of")
    )


def positioned(instances: DataFrame) -> DataFrame:
    """Instances with their position in time. A calendar is a few rows a day, so it is ordered as one."""
    return instances.withColumn("position", F.row_number().over(W.orderBy("start", "trade_date", "phase")))


def clocks(requests: DataFrame, instances: DataFrame) -> DataFrame:
    """requests with opened, the position of the instance that is active at as_of, and done, that of the last one
    completed by then; null if there is none.

    Both change only where an instance starts or ends, so they are found for those moments, which are written: Spark
    knows how few they are and sends them to the requests, which are neither sorted nor shuffled by their times.
    """
    placed = positioned(instances)
    marks = placed.select(F.explode(F.array("start", "end")).alias("as_of")).distinct()
    at_day = by_day(placed.select(F.col("start").alias("_s"), F.col("end").alias("_e"), F.col("position").alias("_p")), "_s", "_e")
    m = by_day(marks.withColumn("_to", F.col("as_of") + 1), "as_of", "_to").drop("_to")
    active = m.join(at_day, "_day").where((F.col("_s") <= F.col("as_of")) & (F.col("as_of") < F.col("_e"))).groupBy("as_of").agg(F.max("_p").alias("opened"))
    ends = placed.groupBy(F.col("end").alias("start")).agg(F.max("position").alias("p"))
    ends = ends.select("start", F.max("p").over(W.orderBy("start")).alias("done"))
    marks = latest_before(marks, ends, "as_of", ["done"]).join(active, "as_of", "left")
    moments = staged(marks.select(F.col("as_of").alias("start"), "opened", "done"), "moments")
    return latest_before(requests, moments, "as_of", ["opened", "done"])


def rank_of(position: Column) -> Column:
    """new is the active instance, buffer the one before, old the rest; while the market is closed the last completed
    one is buffer."""
    opened, done = F.col("opened"), F.col("done")
    live = F.when(position == opened, "new").when(position == opened - 1, "buffer").when(position < opened - 1, "old")
    return F.when(opened.isNotNull(), live).otherwise(F.when(position == done, "buffer").when(position < done, "old"))


def session_slices(work: DataFrame, days: DataFrame, instances: DataFrame, capabilities: DataFrame) -> DataFrame:
    """Slices of work (request_id, start, end, as_of, interval, mode, more): clipped, with source, rank, gap and flags.

    Intraday: a slice for each phase that the window meets, and one for each part of an open day that no phase
    covers (missing_calendar_phase). Daily: a slice for each open day, ranked by its latest instance that has started.
    """
    at = staged(clocks(work, instances), "clocks")
    window = lambda a, b: (F.greatest(F.col("start"), a).alias("start"), F.least(F.col("end"), b).alias("end"))
    rest = [c for c in at.columns if c not in ("start", "end")]
    none = F.lit(None).cast("string")
    placed = positioned(instances).select(F.col("start").alias("_cs"), F.col("end").alias("_ce"), "trade_date", "session_id", "session_instance_id", "phase", "position")
    met = overlapping(at.where("interval <> '1d'"), placed, [])
    active = (F.col("_cs") <= F.col("as_of")) & (F.col("as_of") < F.col("_ce"))
    intraday = met.select(*rest, *window(F.col("_cs"), F.col("_ce")), "trade_date", "session_id", "session_instance_id", "phase", rank_of(F.col("position")).alias("rank"), active.alias("active"), none.alias("missing"))
    open_days = days.where("status = 'open'")
    bare = uncovered(open_days.select("trade_date", "session_id", "start", "end"), instances.select("start", "end"), [], ["trade_date", "session_id"])
    edges = overlapping(at.where("interval <> '1d'"), bare.withColumnsRenamed({"start": "_cs", "end": "_ce"}), [])
    edges = edges.select(*rest, *window(F.col("_cs"), F.col("_ce")), "trade_date", "session_id", none.alias("session_instance_id"), none.alias("phase"), none.alias("rank"), F.lit(False).alias("active"), F.lit("missing_calendar_phase").alias("missing"))
    # the few instances of a day, in order
    own = positioned(instances).groupBy("session_id").agg(F.sort_array(F.collect_list(F.struct("start", "end", "position", "session_instance_id"))).alias("_own"))
    whole = open_days.select(F.col("start").alias("_cs"), F.col("end").alias("_ce"), "trade_date", "session_id").join(own, "session_id", "left")
    daily = overlapping(at.where("interval = '1d'"), whole, [])
    latest = F.element_at(F.filter("_own", lambda i: i["start"] <= F.col("as_of")), -1)
    daily = daily.withColumn("_i", F.when(F.exists("_own", lambda i: i["start"] <= F.col("as_of")), latest))
    on = F.coalesce((F.col("_i.start") <= F.col("as_of")) & (F.col("as_of") < F.col("_i.end")), F.lit(False))
    daily = daily.select(*rest, *window(F.col("_cs"), F.col("_ce")), "trade_date", "session_id", "_i.session_instance_id", none.alias("phase"), rank_of(F.col("_i.position")).alias("rank"), on.alias("active"), F.when(F.col("_own").isNull(), "missing_calendar_phase").alias("missing"))
    every = intraday.unionByName(edges).unionByName(daily).withColumn("market_closed", F.col("opened").isNull() & (F.col("interval").eqNullSafe("1d") | F.col("phase").isNotNull()))
    picked = every.withColumn("c", choice(F.col("mode"), F.col("trade_date"), F.col("interval") == "1d", F.col("phase"), F.col("rank")))
    for c in ("provider", "feed"):
        picked = picked.withColumn(c, F.when(F.col("missing").isNull(), F.col(f"c.{c}")))
    picked = picked.withColumn("choice_gap", F.coalesce("missing", "c.gap")).drop("c", "missing", "opened", "done")
    return with_capability(picked, capabilities, F.col("as_of"))


def plan_requests(requests: DataFrame, days: DataFrame, instances: DataFrame, capabilities: DataFrame) -> dict[str, DataFrame]:
    """requests (with problem, interval, provisional and counts), slices, gaps, groups and runs of all plans.

    A request with a problem is not planned. Before the cutoff, and for research, intraday requests become daily if
    they allow it; else that part is an unsupported gap. What lies outside the calendar, and the nights of closed days
    in scopes that have nights, are unknown gaps. Gaps are disjoint per request, the strongest reason first. Groups and
    runs are numbered from the newest on. A plan of over MOST_GROUPS groups or MOST_RANGES slices or gaps has problem
    too_large and fails as a whole: `within_limits` takes its parts away.
    """
    first, last = days.select(F.min("start")).scalar(), days.select(F.max("end")).scalar()
    cutoff = parse_rfc3339(F.lit(CUTOFF))
    judged = requests.select(*REQUEST).withColumn("_a", first).withColumn("_b", last)
    judged = staged(judged.withColumn("problem", problem_of((F.col("as_of") >= F.col("_a")) & (F.col("as_of") < F.col("_b")))), "judged")
    intraday, research = F.col("resolution") != "1d", F.col("mode") == "research"
    early = intraday & (research | (F.col("start") < cutoff))
    sound = (
        judged.where("problem is null").drop("problem").withColumn("_down", early & F.col("allow_daily_downgrade")).withColumn("_cut", early & ~F.col("allow_daily_downgrade"))
        .withColumn("interval", F.when(F.col("_down"), "1d").otherwise(F.col("resolution"))).withColumn("_cs", F.greatest("start", "_a")).withColumn("_ce", F.least("end", "_b"))
    )
    unsupported_to = F.when(research, F.col("_ce")).otherwise(F.least("_ce", cutoff))
    work_from = F.when(F.col("_cut"), unsupported_to).otherwise(F.col("_cs"))
    gap = lambda a, b, reason: F.struct(a.alias("start"), b.alias("end"), F.lit(reason).alias("reason"))
    outside = F.array(
        gap(F.col("start"), F.least("end", "_a"), "unknown"), gap(F.greatest("start", "_b"), F.col("end"), "unknown"),
        F.when(F.col("_cut"), gap(F.col("_cs"), unsupported_to, "unsupported_resolution")).otherwise(gap(F.col("start"), F.col("start"), "unknown")),
    )
    gaps = sound.select("request_id", F.explode(outside).alias("g")).select("request_id", "g.*").where("start < end")
    sound = sound.withColumn("_from", work_from)
    work = sound.withColumn("start", F.greatest("_cs", "_from")).withColumn("end", F.col("_ce")).where("start < end").select("request_id", "symbol", "start", "end", "as_of", "interval", "mode", "scope", "adjustment")
    slices = session_slices(work, days, instances, capabilities)
    bounds = instances.groupBy("trade_date").agg(F.min("start").alias("_first"), F.max("end").alias("_last"))
    slices = slices.join(bounds, "trade_date", "left")
    # without a phase: all scopes' slices are kept by "all", those before the first or after the last phase by "overnight"
    edge = F.coalesce((F.col("end") <= F.col("_first")) | (F.col("start") >= F.col("_last")), F.lit(False))
    kept = F.when(F.col("interval") == "1d", F.lit(True)).when(F.col("phase").isNotNull(), in_scope(F.col("phase"), F.col("scope"))).otherwise((F.col("scope") == "all") | ((F.col("scope") == "overnight") & edge))
    slices = slices.where(kept).drop("_first", "_last")
    no_daily = (F.col("interval") == "1d") & F.col("scope").isin("extended", "overnight")
    slices = slices.withColumn("provider", F.when(~no_daily, F.col("provider"))).withColumn("feed", F.when(~no_daily, F.col("feed"))).withColumn("gap", F.when(no_daily, "unsupported_resolution").otherwise(F.col("gap")))
    slices = staged(slices, "slices")
    reason = F.when(F.col("gap") == "missing_provider_capability", "provider_unavailable").when(F.col("gap") == "unsupported_resolution", "unsupported_resolution").otherwise("unknown")
    gaps = gaps.unionByName(slices.where("gap is not null").select("request_id", "start", "end", reason.alias("reason")))
    gaps = gaps.unionByName(_closed_nights(sound, days, instances))
    gaps = normalize_gaps(gaps, ["request_id"], MAPPING_PRIORITY)
    return _whole_plans(judged, sound, slices, gaps)


def _closed_nights(sound: DataFrame, days: DataFrame, instances: DataFrame) -> DataFrame:
    """Unknown gaps: nights of closed days that no trusted night session covers.

    A request has slices of all night sessions from _from on, and of none before. So the sessions are taken from the
    nights in the calendar, and requests meet what is left, or before _from whole nights: no slices are needed here.
    """
    asked = sound.where("interval <> '1d' and scope in ('all', 'overnight')")
    nights = closed_night_bands(days)
    trusted = instances.where("phase = 'over' and session_instance_id is not null").select("start", "end")
    left = staged(uncovered(nights, trusted, [], ["trade_date"]), "nights")

    def met(start: Column, end: Column, bands: DataFrame) -> DataFrame:
        both = overlapping(asked.select("request_id", start.alias("start"), end.alias("end")), bands.select(F.col("start").alias("_cs"), F.col("end").alias("_ce")), [])
        return both.select("request_id", F.greatest("start", "_cs").alias("start"), F.least("end", "_ce").alias("end"), F.lit("unknown").alias("reason"))

    return met(F.col("start"), F.least("end", "_from"), nights).unionByName(met(F.greatest("start", "_from"), F.col("end"), left))


def _whole_plans(judged: DataFrame, sound: DataFrame, slices: DataFrame, gaps: DataFrame) -> dict[str, DataFrame]:
    """The parts of all plans, and the facts about each."""
    served = slices.where("gap is null and provider is not null")
    groups = served.groupBy("request_id", "provider", "feed", "interval", "adjustment").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_slices"))
    order = W.partitionBy("request_id").orderBy(F.col("end").desc(), "provider", F.col("feed").asc_nulls_first())
    groups = groups.withColumn("position", F.row_number().over(order))
    counts = slices.groupBy("request_id").agg(F.count("*").alias("n_slices"), F.bool_or("provisional").alias("_provisional"), F.count_distinct(F.when(F.col("gap").isNull() & F.col("provider").isNotNull(), F.struct("provider", "feed"))).alias("n_groups"))
    n_gaps = gaps.groupBy("request_id").agg(F.count("*").alias("n_gaps"))
    facts = judged.select("request_id", "problem").join(sound.select("request_id", "interval"), "request_id", "left").join(counts, "request_id", "left").join(n_gaps, "request_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    too_large = (zero("n_groups") > MOST_GROUPS) | (zero("n_slices") > MOST_RANGES) | (zero("n_gaps") > MOST_RANGES)
    facts = facts.select("request_id", F.coalesce("problem", F.when(too_large, "too_large")).alias("problem"), "interval", (F.coalesce("_provisional", F.lit(False)) | (zero("n_gaps") > 0)).alias("provisional"), zero("n_slices"), zero("n_groups"), zero("n_gaps"))
    return {"requests": facts, "slices": slices, "gaps": gaps, "groups": groups, "runs": runs_of(slices)}


def within_limits(plan: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """A plan without the parts of requests that have a problem."""
    fine = plan["requests"].where("problem is null").select("request_id")
    return {name: part if name == "requests" else part.join(fine, "request_id", "left_semi") for name, part in plan.items()}


def in_runs(slices: DataFrame) -> DataFrame:
    """Fetchable slices with the number of their run of one source, from the newest on: what a page of that run may
    hold. Slices that cannot be fetched do not break a run. A plan is at most MOST_RANGES slices."""
    along = W.partitionBy("request_id").orderBy(F.col("start").desc(), F.col("end").desc())
    source = F.struct("provider", "feed", "interval")
    new = F.coalesce(F.lag(source).over(along) != source, F.lit(True)).cast("int")
    return slices.where("gap is null and provider is not null").withColumn("_new", new).withColumn("run", F.sum("_new").over(along.rowsBetween(W.unboundedPreceding, 0))).drop("_new")


def runs_of(slices: DataFrame) -> DataFrame:
    """Each request's runs of fetchable slices with one source."""
    return in_runs(slices).groupBy("request_id", "run", "provider", "feed", "interval").agg(F.min("start").alias("oldest_start"), F.max("start").alias("newest_start"), F.count("*").alias("n_slices"))
