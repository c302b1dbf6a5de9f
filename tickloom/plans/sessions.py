"""Planning: which source serves which slice of a request. Plans are small tables of slices."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom import errors
from tickloom.functions.market import RESOLUTIONS, SCOPES, in_scope
from tickloom.operators.intervals import overlaps
from tickloom.operators.sequence import stretch
from tickloom.operators.stretches import with_previous, with_running_sum
from tickloom.plans.choice import MODES
from tickloom.plans.requests import plan_requests, session_slices
from tickloom.sources.calendar import overnight_instances


@dataclass(frozen=True)
class Request:
    """A bar request: half-open window in nanoseconds."""

    symbol: str
    start: int
    end: int
    resolution: str = "1m"
    scope: str = "all"
    mode: str = "auto"
    adjustment: str = "unadjusted"
    allow_daily_downgrade: bool = False


def ranked(instances: DataFrame, as_of: int | Column) -> DataFrame:
    """instances with position, active and rank: new is the active one, buffer the one before, old the rest.

    While the market is closed nothing is new and the last completed instance is buffer; later ones have no
    rank. Positions count over days and phases. A calendar is one small table, so it is ordered as one.
    """
    now = F.lit(as_of) if isinstance(as_of, int) else as_of
    every = W.partitionBy()
    out = instances.withColumn("position", F.row_number().over(W.orderBy("start", "trade_date", "phase")))
    out = out.withColumn("active", (F.col("start") <= now) & (now < F.col("end")))
    a = F.max(F.when(F.col("active"), F.col("position"))).over(every)
    c = F.max(F.when(F.col("end") <= now, F.col("position"))).over(every)
    out = out.withColumn("_a", a).withColumn("_c", c)
    i = F.col("position")
    opened = F.when(i == F.col("_a"), "new").when(i == F.col("_a") - 1, "buffer").when(i < F.col("_a") - 1, "old")
    closed = F.when(i == F.col("_c"), "buffer").when(i < F.col("_c"), "old")
    return out.withColumn("rank", F.when(F.col("_a").isNotNull(), opened).otherwise(closed)).withColumn("market_closed", F.col("_a").isNull()).drop("_a", "_c")


def _as_table(request: Request, as_of: int, spark) -> DataFrame:
    schema = "request_id int, symbol string, start long, end long, as_of long, resolution string, scope string, mode string, adjustment string, allow_daily_downgrade boolean"
    row = (1, request.symbol, request.start, request.end, as_of, request.resolution, request.scope, request.mode, request.adjustment, request.allow_daily_downgrade)
    return spark.createDataFrame([row], schema)


def plan_sessions(request: Request, as_of: int, days: DataFrame, instances: DataFrame, capabilities: DataFrame) -> DataFrame:
    """Slices of a request in its own resolution and in every scope, clipped to it, with source, rank, gap and flags, in
    order (`requests.session_slices` for a table of one)."""
    work = _as_table(request, as_of, days.sparkSession).withColumnRenamed("resolution", "interval")
    return session_slices(work, days, instances, capabilities).orderBy("start", "trade_date", "phase")


def check_request(request: Request) -> None:
    """Fails unless the request is well formed: ticker, window, resolution, scope, mode."""
    if not re.fullmatch(r"[A-Z0-9.\-]{1,32}", request.symbol) or re.fullmatch(r"[A-Z]{1,6}\d{6}[CP]\d{8}", request.symbol):
        raise errors.Contract("symbol")
    if request.start >= request.end:
        raise errors.Contract("window")
    if request.resolution not in RESOLUTIONS or request.scope not in SCOPES or request.mode not in MODES:
        raise errors.Contract("resolution, scope or mode")


def sessions_in_window(days: DataFrame, instances: DataFrame, start: int, end: int) -> tuple[DataFrame, DataFrame]:
    """(days, instances) of a window: instances that meet it; days that meet it or own such an instance."""
    met = instances.where(overlaps(F.col("start"), F.col("end"), F.lit(start), F.lit(end)))
    owners = met.select("trade_date").distinct().withColumn("_owns", F.lit(True))
    kept = days.join(owners, "trade_date", "left").where(F.col("_owns") | overlaps(F.col("start"), F.col("end"), F.lit(start), F.lit(end)))
    return kept.drop("_owns"), met


def overnight_capabilities(capabilities: DataFrame, routes: DataFrame) -> DataFrame:
    """Capabilities whose overnight phase has a signed route (provider, feed); other phases stay."""
    keys = ["provider", "feed"]
    c, r = capabilities.alias("c"), routes.select(*keys).distinct().alias("r")
    on = F.col("c.provider").eqNullSafe(F.col("r.provider")) & F.col("c.feed").eqNullSafe(F.col("r.feed"))
    return capabilities.where("phase <> 'over'").unionByName(c.where("phase = 'over'").join(r, on, "left_semi"))


def edge_windows(instances: DataFrame, days: DataFrame) -> DataFrame:
    """Per trade date what lies between the day's bounds and its first and last instance."""
    per = instances.groupBy("trade_date").agg(F.min("start").alias("first"), F.max("end").alias("last"))
    both = days.select("trade_date", "start", "end").join(per, "trade_date")
    edges = F.array(F.struct(F.lit("before").alias("edge"), F.col("start").alias("a"), F.col("first").alias("b")), F.struct(F.lit("after").alias("edge"), F.col("last").alias("a"), F.col("end").alias("b")))
    return both.select("trade_date", F.explode(edges).alias("e")).select("trade_date", "e.edge", F.col("e.a").alias("start"), F.col("e.b").alias("end")).where("start < end")


def overlay(days: DataFrame, instances: DataFrame, signed: DataFrame, now: int) -> DataFrame:
    """Instances with the signed overnight ones (with issued, lease_end) that are trusted now and lie where the
    calendar's own band lies; others are left out."""
    band = overnight_instances(days).select("trade_date", F.col("start").alias("_bs"), F.col("end").alias("_be"))
    trusted = signed.where((F.col("issued") <= now) & (F.lit(now) < F.col("lease_end"))).join(band, "trade_date").where("start >= _bs and end <= _be")
    return instances.unionByName(trusted.select(*instances.columns))


def runs(slices: DataFrame, keys: list[str], order: str, source: str, fetchable: Column, width: int | None = None) -> DataFrame:
    """Runs of consecutive fetchable slices with one source; slices that cannot be fetched do not break a run.

    A key of any size goes in stretches of width numbers of its order (None: chosen from the numbers)."""
    kept = slices.where(fetchable)
    cut = F.floor(F.col(order) / (width or stretch(kept, order)))
    marked = with_previous(kept, keys, cut, [order], F.struct(F.col(source).alias("source")), "_previous")
    new = F.coalesce(~F.col("_previous.source").eqNullSafe(F.col(source)) | F.col("_previous").isNull(), F.lit(True)).cast("int")
    numbered = with_running_sum(marked, keys, cut, [order], new, "run")
    return numbered.groupBy(*keys, "run", source).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n_slices"))


def attempt_capabilities(request: Request, as_of: int, days: DataFrame, instances: DataFrame, capabilities: DataFrame, candidates: DataFrame) -> DataFrame:
    """capabilities and those candidates of provider B that its policy permits for this request: all slices that a
    candidate would serve have to be permitted, else it is left out."""
    from tickloom.plans.mapping import permitted

    trial = plan_sessions(request, as_of, days, instances, capabilities.where("provider <> 'futu'").unionByName(candidates))
    if request.resolution != "1d":
        trial = trial.where(in_scope(F.col("phase"), F.lit(request.scope)))
    served = trial.where("provider = 'futu'").withColumn("historical", F.col("historical") & ~F.col("realtime") & F.col("gap").isNull())
    allowed = permitted(served)
    c, a = candidates.alias("c"), allowed.alias("a")
    on = F.col("c.phase").eqNullSafe(F.col("a.phase")) & F.col("c.interval").eqNullSafe(F.col("a.interval"))
    return capabilities.where("provider <> 'futu'").unionByName(c.join(a, on, "left_semi"))


def next_run(plan_runs: DataFrame, served: int | None) -> dict | None:
    """The cursor of the run after the one just served (None: of the first), whether that succeeded or failed;
    None after the last. It selects the next planned run and authorizes nothing else."""
    found = plan_runs.where(F.col("run") > (served or 0)).orderBy("run").first()
    return found.asDict() if found else None


def plan_market_bars(request: Request, as_of: int, days: DataFrame, instances: DataFrame, capabilities: DataFrame, candidates: DataFrame | None = None) -> dict[str, DataFrame]:
    """slices (newest first), groups per source, runs and normalised gaps of one request (`requests.plan_requests`).

    candidates: capabilities of provider B, of which only those that its policy permits take part.
    """
    check_request(request)
    span = days.agg(F.min("start").alias("a"), F.max("end").alias("b")).first()
    if span["a"] is None or not span["a"] <= as_of < span["b"]:
        raise errors.Contract("as_of outside the calendar")
    if candidates is not None:
        capabilities = attempt_capabilities(request, as_of, days, instances, capabilities, candidates)
    made = plan_requests(_as_table(request, as_of, days.sparkSession), days, instances, capabilities)
    return {"slices": made["slices"].orderBy(F.col("start").desc()), "groups": made["groups"].orderBy("position"), "runs": made["runs"], "gaps": made["gaps"].orderBy("start")}
