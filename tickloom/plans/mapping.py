"""Provider pages onto planned slices: rows, gaps and the answer's status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.market import RESOLUTIONS, RESPONSE_PRIORITY, summary_label
from tickloom.functions.values import same_provider
from tickloom.operators.intervals import by_day, conflicts, contained_in_one, normalize_gaps, outside, overlaps, uncovered
from tickloom.session import staged


def row_reason(expected: dict[str, Column], request_start: Column, request_end: Column) -> Column:
    """Why a row of a page cannot be used, by the first rule broken; null if it can.

    Rows carry p_provider and p_feed of their provenance (null if unknown), row_state, entitlement, start, end.
    """
    known = F.col("p_provider").isNotNull()
    differs = (same_provider(F.col("p_provider"), expected["provider"]) == F.lit(False)) | (same_provider(F.col("p_feed"), expected["feed"]) == F.lit(False))
    other = F.lit(False)
    for name in ("symbol", "asset_class", "resolution", "adjustment"):
        other = other | ~F.col(name).eqNullSafe(expected[name])
    return (
        F.when(~known, "unknown")
        .when(F.coalesce(differs, F.lit(False)), "validation_conflict")
        .when(F.col("entitlement") == "unauthorized", "entitlement_limited")
        .when(F.col("row_state") == "conflict", "validation_conflict")
        .when(other, "validation_conflict")
        .when((F.col("start") < request_start) | (F.col("end") > request_end), "unknown")
    )


def map_page(rows: DataFrame, provenance: DataFrame, slices: DataFrame, expected: dict[str, Column], request_start: int, request_end: int) -> dict[str, DataFrame]:
    """rows of a provider page on the slices of its run, and the gaps that refused rows leave.

    rows: row_id, provenance_id, start, end and the compared columns. Bars are never clipped; of overlapping
    bars none is kept; a session id of the provider gives way to the calendar's.
    """
    source = provenance.select("provenance_id", F.col("provider").alias("p_provider"), F.col("feed").alias("p_feed"), "entitlement")
    joined = rows.join(source, "provenance_id", "left")
    held = contained_in_one(joined.drop("session_instance_id"), slices, ["session_instance_id", "slice_provisional"])
    reason = F.coalesce(row_reason(expected, F.lit(request_start), F.lit(request_end)), F.when(F.col("session_instance_id").isNull(), "unknown"))
    judged = held.withColumn("reason", reason)
    good = judged.where("reason is null").drop("reason")
    keys = ["symbol"]
    clash = conflicts(good, keys, "row_id")
    refused = judged.where("reason is not null").select("start", "end", "reason").unionByName(clash.select("start", "end", F.lit("validation_conflict").alias("reason")))
    days = by_day(slices).select("_day", F.col("start").alias("_ss"), F.col("end").alias("_se"))
    gaps = by_day(refused).join(days, "_day").where(overlaps(F.col("start"), F.col("end"), F.col("_ss"), F.col("_se")))
    gaps = gaps.select(F.greatest("start", "_ss").alias("start"), F.least("end", "_se").alias("end"), "reason").distinct()
    state = F.when(F.col("slice_provisional") | (F.col("entitlement") != "authorized") | (F.col("row_state") == "provisional"), "provisional").otherwise("validated")
    return {"rows": good.join(clash.select("row_id"), "row_id", "left_anti").withColumn("validation_state", state).drop("slice_provisional"), "gaps": gaps}


def answer(rows: DataFrame, gaps: DataFrame, slices: DataFrame, segments: DataFrame, provenance: DataFrame, truncated: bool = False, unsupported: bool = False) -> dict:
    """The response: rows outside all gaps, disjoint gaps, complete segments, used provenance, labels, status.

    A bar that touches a gap is dropped, and its whole interval becomes a conflict.
    """
    keyed = lambda df: df.withColumn("k", F.lit(1))
    # each is used several times below, and is the result of sweeps itself
    rows, gaps = staged(rows, "rows"), staged(gaps, "gaps")
    kept = outside(keyed(rows), keyed(gaps), ["k"], ["row_id", "start", "end"]).drop("k")
    kept = staged(kept, "kept")
    lost = rows.join(kept.select("row_id"), "row_id", "left_anti").select("start", "end", F.lit("validation_conflict").alias("reason"))
    normal = normalize_gaps(keyed(gaps.select("start", "end", "reason").unionByName(lost)), ["k"], RESPONSE_PRIORITY)
    normal = staged(normal, "gaps")
    whole = keyed(segments.where("status = 'complete'"))
    complete = uncovered(whole.select("k", "start", "end"), normal.select("k", "start", "end"), ["k"], []).drop("k")
    bare = uncovered(keyed(slices.select("start", "end")), keyed(complete), ["k"], [])
    used = provenance.join(kept, "provenance_id", "left_semi")
    labels = used.agg(summary_label("provider").alias("source"), summary_label("entitlement").alias("entitlement")).first()
    facts = kept.agg(F.count("*").alias("n"), F.coalesce(F.bool_or(F.col("validation_state") == "provisional"), F.lit(False)).alias("provisional")).first()
    any_gap, any_segment = not normal.isEmpty(), not segments.isEmpty()
    if unsupported:
        status = "unsupported"
    elif any_gap or facts["provisional"] or (truncated and any_segment):
        status = "partial"
    elif truncated:
        status = "unknown"
    elif bare.isEmpty():
        status = "complete" if facts["n"] else "empty"
    else:
        status = "partial" if any_segment else "unknown"
    return {"rows": kept.orderBy("start"), "gaps": normal.drop("k").orderBy("start"), "segments": complete.orderBy("start"), "provenance": used, "source": labels["source"], "entitlement": labels["entitlement"], "status": status}


def failed(slices: DataFrame, gaps: DataFrame, reason: str) -> DataFrame:
    """Gaps of an answer whose page failed: the run's slices with the reason of the failure."""
    every = gaps.select("start", "end", "reason").unionByName(slices.select("start", "end", F.lit(reason).alias("reason")))
    return normalize_gaps(every.withColumn("k", F.lit(1)), ["k"], RESPONSE_PRIORITY).drop("k")


def clipped_rows(rows: DataFrame, start: int, end: int) -> dict[str, DataFrame]:
    """Rows inside a request; a bar across its boundary is dropped and what it has inside becomes an unknown gap."""
    inside = (F.col("start") >= start) & (F.col("end") <= end)
    cut = rows.where(~inside & overlaps(F.col("start"), F.col("end"), F.lit(start), F.lit(end)))
    return {"rows": rows.where(inside), "gaps": cut.select(F.greatest("start", F.lit(start)).alias("start"), F.least("end", F.lit(end)).alias("end"), F.lit("unknown").alias("reason"))}


def null_volume_rows(rows: DataFrame, start: int, end: int) -> dict[str, DataFrame]:
    """A page's rows with a volume, and unknown gaps, clipped to the request, where bars have none."""
    lost = rows.where("volume is null").where(overlaps(F.col("start"), F.col("end"), F.lit(start), F.lit(end)))
    return {"rows": rows.where("volume is not null"), "gaps": lost.select(F.greatest("start", F.lit(start)).alias("start"), F.least("end", F.lit(end)).alias("end"), F.lit("unknown").alias("reason"))}


def permitted(slices: DataFrame) -> DataFrame:
    """(phase, interval) of provider B that all of its slices permit: new or buffer, historical, in an interval that it has."""
    fine = F.col("rank").isin("new", "buffer") & F.col("historical") & F.col("interval").isin(*RESOLUTIONS)
    return slices.groupBy("phase", "interval").agg(F.bool_and(F.coalesce(fine, F.lit(False))).alias("ok")).where("ok").drop("ok")
