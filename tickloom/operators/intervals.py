"""Half-open intervals [start, end) per key: sweeps, complements, containment.

A sweep goes by key and stretch of time (`stretches`), never by a join of intervals with intervals. Joins of points or
short rows with intervals go by UTC day, so that they are equi-joins with a range condition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.functions.time import DAY, day_number
from tickloom.operators.stretches import HELPERS, carried, earlier, stretched, through
from tickloom.operators.stretches import inside as inside_of
from tickloom.session import spread, staged

#: Stretch of time by which overlap joins are cut.
GRAIN = 32 * DAY


def _window(keys: list[str], *order) -> W:
    return W.partitionBy(*keys).orderBy(*order)


def overlaps(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    return (a_start < b_end) & (b_start < a_end)


def _stretch(at: str) -> Column:
    return F.floor(F.col(at) / GRAIN)


def islands(rows: DataFrame, keys: list[str], touching: bool) -> DataFrame:
    """rows with a number island per key: rows whose union is one interval; touching ones join if asked."""
    along = inside_of("start", "end")
    cut = carried(stretched(rows, keys, _stretch("start")), [F.max("end").alias("_end")], lambda w: [F.max("_end").over(earlier(w)).alias("_reach")])
    reached = F.greatest("_reach", F.max("end").over(earlier(along)))
    apart = F.col("start") > reached if touching else F.col("start") >= reached
    new = cut.withColumn("_new", F.coalesce(apart, F.lit(True)).cast("int")).drop("_reach")
    known = carried(new, [F.sum("_new").alias("_all")], lambda w: [F.coalesce(F.sum("_all").over(earlier(w)), F.lit(0)).alias("_islands")])
    return known.withColumn("island", F.col("_islands") + F.sum("_new").over(through(along))).drop("_new", "_islands", *HELPERS)


def merge_overlapping(gaps: DataFrame, keys: list[str]) -> DataFrame:
    """Overlapping gaps become one with reason unknown; touching ones stay apart."""
    return (
        islands(gaps, keys, touching=False)
        .groupBy(*keys, "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.when(F.count("*") > 1, "unknown").otherwise(F.min("reason")).alias("reason"))
        .drop("island")
    )


def normalize_gaps(gaps: DataFrame, keys: list[str], order: tuple[str, ...]) -> DataFrame:
    """Disjoint gaps: where some overlap the strongest reason holds, and touching equals are one.

    A running count of open gaps per reason is kept along the boundaries, in two levels (`stretches`), so nothing is
    joined with itself and no key is one task. A gap begins where the strongest open reason changes. What earlier
    stretches leave open goes ahead of a stretch's boundaries as rows of its own, so each boundary is sorted once here
    and, if it is a change, once more for where the next one is. Gaps are written and counted first: tasks are as many
    as their number asks for, so none takes more when there are more gaps.
    """
    number = F.coalesce(*[F.when(F.col("reason") == r, F.lit(i)) for i, r in enumerate(order)])
    key = F.struct(*keys) if keys else F.struct(F.lit(0))
    known = staged(gaps.where("start < end").select(key.alias("_key"), number.alias("r"), "start", "end").where("r is not null"), "gaps")
    n = 2 * known.count()
    bound = lambda t, d: F.struct(_stretch(t).alias("_cut"), F.col(t).alias("t"), F.lit(d).cast("long").alias("d"))
    both = F.array(bound("start", 1), bound("end", -1))
    rows = known.select("_key", "r", F.explode(both).alias("e")).select("_key", "e._cut", "e.t", "r", "e.d")
    # a gap that ends in its stretch leaves nothing open: one row says that the stretch is there
    left = known.select("_key", "r", F.explode(F.when(_stretch("start") == _stretch("end"), F.array(bound("start", 0))).otherwise(both)).alias("e"))
    of = lambda i: F.sum(F.when(F.col("r") == i, F.col("d")))
    totals = spread(left.select("_key", "e._cut", "r", "e.d"), n, "_key", "_cut").groupBy("_key", "_cut").agg(*[F.coalesce(of(i), F.lit(0)).alias(f"_{i}") for i in range(len(order))])
    before = earlier(W.partitionBy("_key").orderBy("_cut"))
    still = spread(totals, n, "_key").select("_key", "_cut", F.array(*[F.struct(F.lit(i).alias("r"), F.sum(f"_{i}").over(before).alias("d")) for i in range(len(order))]).alias("e"))
    still = still.select("_key", "_cut", F.explode("e").alias("e")).where("e.d > 0").select("_key", "_cut", F.lit(None).cast("long").alias("t"), "e.r", "e.d")
    along = inside_of("t")
    upto = along.rangeBetween(W.unboundedPreceding, W.currentRow)
    now = spread(rows.union(still), n, "_key", "_cut").select("_key", "_cut", "t", F.coalesce(*[F.when(of(i).over(upto) > 0, F.lit(i)) for i in range(len(order))]).alias("r"))
    # of equal times the first row alone follows another state
    changes = now.withColumn("_was", F.lag("r").over(along)).where("t is not null and not (r <=> _was)").drop("_was")
    # the first and the last change of each stretch of a key are ordered together, the others stay among themselves
    edge = F.lag("t").over(along).isNull() | F.lead("t").over(along).isNull()
    dealt = changes.select("_key", F.when(~edge, F.col("_cut")).alias("_cut"), "t", "r", F.lead("t").over(along).alias("_next"))
    out = spread(dealt, n, "_key", "_cut").withColumn("end", F.coalesce("_next", F.lead("t").over(along))).where("r is not null")
    return out.select(*[F.col(f"_key.{k}").alias(k) for k in keys], F.col("t").alias("start"), "end", F.element_at(F.array(*[F.lit(r) for r in order]), F.col("r") + 1).alias("reason"))


def overlapping(windows: DataFrame, others: DataFrame, keys: list[str], grain: int = GRAIN) -> DataFrame:
    """Pairs of a window and another interval (_cs, _ce) of its keys that overlap.

    An equi-join on keys and on stretches of grain, so that a key with a long history is many small joins;
    a pair that shares several stretches counts in the one where the later of the two begins. With keys both sides are
    shuffled: Spark's estimate of a side does not know how many stretches its rows have, and would broadcast them all.
    Without keys (calendars) the choice is Spark's.
    """
    stretch = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / grain), F.floor((F.col(b) - 1) / grain)))
    w = windows.where("start < end").withColumn("_b", stretch("start", "end"))
    o = others.where("_cs < _ce").withColumn("_b", stretch("_cs", "_ce"))
    both = w.join(o.hint("merge") if keys else o, [*keys, "_b"]).where(overlaps(F.col("start"), F.col("end"), F.col("_cs"), F.col("_ce")))
    return both.where(F.floor(F.greatest("start", "_cs") / grain) == F.col("_b")).drop("_b")


def uncovered(windows: DataFrame, covers: DataFrame, keys: list[str], ids: list[str]) -> DataFrame:
    """The parts of each window (keys, ids, start, end) that no cover of its keys (keys, start, end) touches."""
    c = covers.select(*keys, F.col("start").alias("_cs"), F.col("end").alias("_ce"))
    clipped = overlapping(windows, c, keys).select(
        *keys, *ids, F.col("start").alias("ws"), F.col("end").alias("we"), F.greatest("start", "_cs").alias("s"), F.least("end", "_ce").alias("e")
    )
    tail = windows.select(*keys, *ids, F.col("start").alias("ws"), F.col("end").alias("we"), F.col("end").alias("s"), F.col("end").alias("e"))
    along = inside_of("s", "e")
    cut = carried(stretched(clipped.union(tail), [*keys, *ids, "ws", "we"], _stretch("s")), [F.max("e").alias("_end")], lambda w: [F.max("_end").over(earlier(w)).alias("_reach")])
    before = F.coalesce(F.greatest("_reach", F.max("e").over(earlier(along))), F.col("ws"))
    return cut.withColumn("from", before).where("s > from").select(*keys, *ids, F.col("from").alias("start"), F.col("s").alias("end")).distinct()


def conflicts(rows: DataFrame, keys: list[str], tie: str) -> DataFrame:
    """Rows that overlap another row of their keys; all involved, not all but one."""
    along = inside_of("start", "end", tie)
    totals = [F.max("end").alias("_end"), F.min("start").alias("_begin")]
    cut = carried(stretched(rows, keys, _stretch("start")), totals, lambda w: [F.max("_end").over(earlier(w)).alias("_reach"), F.lead("_begin").over(w).alias("_next")])
    before = F.greatest("_reach", F.max("end").over(earlier(along))) > F.col("start")
    after = F.coalesce(F.lead("start").over(along), F.col("_next")) < F.col("end")
    bad = F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))
    return cut.withColumn("_bad", bad).where("_bad").drop("_bad", "_reach", "_next", *HELPERS)


def by_day(intervals: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One row per UTC day that an interval touches."""
    return intervals.withColumn("_day", F.explode(F.sequence(day_number(F.col(start)), day_number(F.col(end) - 1))))


def contained_in_one(rows: DataFrame, slices: DataFrame, keep: list[str], keys: list[str] | None = None) -> DataFrame:
    """rows (start, end) with the keep columns of the slice of their keys that holds them, null unless exactly one does.

    Slices are gathered per UTC day, and each row looks among those of its day: rows are joined once, by day,
    and never shuffled by themselves where Spark finds the slices small enough to broadcast.
    """
    on = [*(keys or []), "_day"]
    of_day = by_day(slices).groupBy(*on).agg(F.collect_list(F.struct(F.col("start").alias("_ss"), F.col("end").alias("_se"), *keep)).alias("_slices"))
    held = rows.withColumn("_day", day_number(F.col("start"))).join(of_day, on, "left")
    fits = F.filter("_slices", lambda x: (F.col("start") >= x["_ss"]) & (F.col("end") <= x["_se"]))
    one = held.withColumn("_fit", fits).withColumn("_one", F.when(F.size("_fit") == 1, F.col("_fit")[0]))
    return one.select(*rows.columns, *[F.col(f"_one.{k}").alias(k) for k in keep])


def latest_before(rows: DataFrame, instances: DataFrame, at: str, keep: list[str]) -> DataFrame:
    """As-of: rows with the keep columns of the latest instance that starts at or before their time.

    Instances (start, keep) become intervals that end where the next one starts; the last never ends, so it
    is matched by its start alone and not spread over days.
    """
    spans = instances.withColumn("end", F.lead("start").over(W.orderBy("start")))
    last = F.broadcast(spans.where("end is null").limit(1).select(F.col("start").alias("_last"), *[F.col(k).alias(f"_last_{k}") for k in keep]))
    days = by_day(spans.where("end is not null")).select("_day", F.col("start").alias("_ss"), F.col("end").alias("_se"), *keep)
    r = rows.withColumn("_day", day_number(F.col(at)))
    on = (r["_day"] == days["_day"]) & (r[at] >= days["_ss"]) & (r[at] < days["_se"])
    met = r.join(days, on, "left").join(last, F.col(at) >= F.col("_last"), "left")
    return met.select(*[r[c] for c in rows.columns], *[F.coalesce(F.col(k), F.col(f"_last_{k}")).alias(k) for k in keep])


def outside(bars: DataFrame, gaps: DataFrame, keys: list[str], ids: list[str]) -> DataFrame:
    """Bars that no gap of their keys touches. Each bar's neighbourhood is its days."""
    g = by_day(gaps.select(*keys, "start", "end").where("start < end")).select(*keys, "_day", F.col("start").alias("_gs"), F.col("end").alias("_ge"))
    hit = by_day(bars).join(g, [*keys, "_day"]).where(overlaps(F.col("start"), F.col("end"), F.col("_gs"), F.col("_ge"))).select(*keys, *ids).distinct()
    return bars.join(hit, [*keys, *ids], "left_anti")


def clip_to(gaps: DataFrame, slices: DataFrame, keys: list[str]) -> DataFrame:
    """Gaps cut to the slices of their keys that they overlap."""
    both = overlapping(gaps, slices.select(*keys, F.col("start").alias("_cs"), F.col("end").alias("_ce")), keys)
    rest = [c for c in gaps.columns if c not in ("start", "end", *keys)]
    return both.select(*keys, F.greatest("start", "_cs").alias("start"), F.least("end", "_ce").alias("end"), *rest)


def tiling(bars: DataFrame, phases: DataFrame, keys: list[str], step: int) -> DataFrame:
    """Per phase (keys, phase_start, phase_end): whether bars (keys, start, end) tile it exactly.

    Bars follow one another from the phase's start to its end in steps; only the last may be short.
    """
    order = _window([*keys, "phase_start"], "start")
    named = phases.withColumns({"start": F.col("phase_start"), "end": F.col("phase_end")})
    starts = bars.select(*keys, F.col("start").alias("_cs"), (F.col("start") + 1).alias("_ce"), F.col("end").alias("_end"))
    inside = overlapping(named, starts, keys).drop("start", "end", "_ce").withColumnsRenamed({"_cs": "start", "_end": "end"})
    lost = phases.join(inside.select(*keys, "phase_start").distinct(), [*keys, "phase_start"], "left_anti")
    inside = inside.unionByName(lost, allowMissingColumns=True)
    due = F.coalesce(F.lag("end").over(order), F.col("phase_start"))
    fits = (F.col("start") == due) & (F.col("end") == F.least(F.col("start") + F.lit(step), F.col("phase_end")))
    return (
        inside.withColumn("_fits", F.coalesce(fits, F.lit(False)))
        .groupBy(*keys, "phase_start", "phase_end")
        .agg(F.count("start").alias("n_bars"), (F.bool_and("_fits") & (F.max("end") == F.col("phase_end"))).alias("_all"))
        .withColumn("complete", F.coalesce("_all", F.lit(False)))
        .drop("_all")
    )


def coverage_status(slices: DataFrame, segments: DataFrame, keys: list[str]) -> DataFrame:
    """Per slice (keys, start, end): complete, partial or empty, by how much of it the segments of its keys cover.

    A key may have several slices; each is measured by itself.
    """
    marked = slices.select(*keys, "start", "end", F.col("start").alias("_from"), F.col("end").alias("_to")).distinct()
    bare = uncovered(marked, segments, keys, ["_from", "_to"]).groupBy(*keys, "_from", "_to").agg(F.sum(F.col("end") - F.col("start")).alias("bare"))
    bare = bare.select(*keys, F.col("_from").alias("start"), F.col("_to").alias("end"), "bare")
    size = F.col("end") - F.col("start")
    return slices.join(bare, [*keys, "start", "end"], "left").withColumn("bare", F.coalesce("bare", F.lit(0))).withColumn("status", F.when(F.col("bare") == 0, "complete").when(F.col("bare") >= size, "empty").otherwise("partial"))


