"""Provider pages of many requests onto their planned slices, and the answers that follow.

A page belongs to one run of one request; all tables are keyed by request_id and run. Rows meet slices by key and UTC
day, so a request with most of the rows is as many groups as it has days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.market import MAPPING_PRIORITY, RESPONSE_PRIORITY, summary_label
from tickloom.functions.values import same_provider
from tickloom.operators.intervals import clip_to, conflicts, contained_in_one, normalize_gaps, outside, overlapping, uncovered
from tickloom.plans.mapping import row_reason
from tickloom.session import staged

KEYS = ["request_id", "run"]


def _identity() -> tuple[Column, Column]:
    """Whether provenance (p_provider, p_feed) differs from a run's source (provider, feed), and whether it is known.

    Only alpaca's feed is part of its identity; another provider's has to be known.
    """
    provider = same_provider(F.col("p_provider"), F.col("provider"))
    alpaca = F.col("provider") == "alpaca"
    feed = same_provider(F.col("p_feed"), F.when(alpaca, F.col("feed")).otherwise(F.col("p_feed")))
    differs = F.coalesce(provider == F.lit(False), F.lit(False)) | F.coalesce(provider & (feed == F.lit(False)), F.lit(False))
    return differs, F.coalesce(provider & feed, F.lit(False))


def map_pages(rows: DataFrame, provenance: DataFrame, slices: DataFrame, requests: DataFrame, pages: DataFrame, segments: DataFrame | None = None, gaps: DataFrame | None = None) -> dict[str, DataFrame]:
    """rows, gaps, segments, provenance and statuses of all pages on their runs' slices.

    rows: keys, row_id, provenance_id, start, end, symbol, asset_class, resolution, adjustment, row_state.
    provenance: keys, provenance_id, provider, feed, entitlement. slices: `in_runs` with session_instance_id.
    requests: request_id, symbol, asset_class, adjustment, start, end. pages: keys, status, truncated, calendar_matches.
    segments: keys, start, end, status, provenance_id; gaps: keys, start, end, reason: as the provider gives them.

    A row is kept if its source is the run's and allowed, its fields are the request's, and exactly one slice holds it;
    it takes that slice's session. Other rows leave gaps where they touch slices; of overlapping rows none is kept.
    Segments are cut to slices, are unknown without a trusted source, and complete ones lose what gaps touch. Statuses:
    one per page; a page without rows, segments and gaps is unknown. Rows of runs that are not planned are in no slice
    and leave no gap; they come out as unplanned. The rows of planned runs are judged once and written.
    """
    planned = slices.select(*KEYS, "provider", "feed", "interval").distinct()
    wanted = requests.select("request_id", *[F.col(c).alias(f"_{c}") for c in ("symbol", "asset_class", "adjustment", "start", "end")])
    source = provenance.select(*KEYS, "provenance_id", F.col("provider").alias("p_provider"), F.col("feed").alias("p_feed"), "entitlement")
    differs, known = _identity()
    fields = rows.select(*KEYS, "row_id", "provenance_id", "start", "end", "symbol", "asset_class", "resolution", "adjustment", "row_state")
    # rows of planned runs first: no other row is moved again
    asked = fields.join(planned.join(wanted, "request_id"), KEYS)
    held = contained_in_one(asked, slices.withColumn("slice_provisional", F.col("provisional")), ["session_instance_id", "slice_provisional"], KEYS)
    full = held.join(source, [*KEYS, "provenance_id"], "left")
    expected = {"provider": F.col("provider"), "feed": F.when(F.col("provider") == "alpaca", F.col("feed")), "symbol": F.col("_symbol"), "asset_class": F.col("_asset_class"), "resolution": F.col("interval"), "adjustment": F.col("_adjustment")}
    reason = F.coalesce(row_reason(expected, F.col("_start"), F.col("_end")), F.when(F.col("session_instance_id").isNull(), "unknown"))
    unsure = F.col("slice_provisional") | (F.col("entitlement") != "authorized") | ~known | (F.col("row_state") == "provisional")
    judged = staged(full.select(*KEYS, "row_id", "provenance_id", "start", "end", "symbol", "session_instance_id", reason.alias("reason"), unsure.alias("_unsure")), "judged-rows")
    good = judged.where("reason is null")
    clash = conflicts(good.select(*KEYS, "row_id", "start", "end"), KEYS, "row_id")
    refused = judged.where("reason is not null").select(*KEYS, "start", "end", "reason").unionByName(clash.select(*KEYS, "start", "end", F.lit("validation_conflict").alias("reason")))
    if gaps is not None:
        refused = refused.unionByName(gaps.select(*KEYS, "start", "end", "reason"))
    planned_segments, used_segments, bad_segments = _segments(segments, source, planned, slices, differs, known)
    if bad_segments is not None:
        refused = refused.unionByName(bad_segments)
    normal = normalize_gaps(clip_to(refused, slices, KEYS), KEYS, MAPPING_PRIORITY)
    flags = pages.select(*KEYS, F.col("calendar_matches").alias("_matches"))
    kept = good.join(clash.select(*KEYS, "row_id"), [*KEYS, "row_id"], "left_anti").join(flags, KEYS, "left")
    kept = kept.withColumn("validation_state", F.when(F.col("_unsure") | ~F.coalesce("_matches", F.lit(True)), "provisional").otherwise("validated"))
    used = good.select(*KEYS, "provenance_id").union(used_segments.select(*KEYS, "provenance_id")) if used_segments is not None else good.select(*KEYS, "provenance_id")
    used = used.distinct()
    if planned_segments is not None:
        whole = planned_segments.where("status = 'complete'")
        bare = uncovered(whole.select(*KEYS, "provenance_id", "session_instance_id", "start", "end"), normal.select(*KEYS, "start", "end"), KEYS, ["provenance_id", "session_instance_id"])
        planned_segments = planned_segments.where("status <> 'complete'").unionByName(bare.withColumn("status", F.lit("complete")))
    names = [*KEYS, "row_id", "provenance_id", "start", "end", "symbol", "session_instance_id", "validation_state"]
    return {
        "rows": kept.select(*names), "gaps": normal, "segments": planned_segments,
        "unplanned": rows.join(planned, KEYS, "left_anti"),
        "provenance": provenance.join(used, [*KEYS, "provenance_id"], "left_semi"),
        "statuses": page_statuses(pages, slices, kept, normal, planned_segments, used),
    }


def _segments(segments: DataFrame | None, source: DataFrame, planned: DataFrame, slices: DataFrame, differs: Column, known: Column):
    """Segments cut to slices, those whose source counts as used, and the gaps of those that are refused."""
    if segments is None:
        return None, None, None
    full = segments.join(source, [*KEYS, "provenance_id"], "left").join(planned, KEYS)
    wrong = F.col("p_provider").isNotNull() & differs
    denied = F.coalesce(F.col("entitlement") == "unauthorized", F.lit(False))
    full = full.withColumn("_wrong", wrong).withColumn("_denied", denied).withColumn("_known", known)
    bad = full.where("_wrong or _denied").select(*KEYS, "start", "end", F.when(F.col("_wrong"), "validation_conflict").otherwise("entitlement_limited").alias("reason"))
    fine = full.where("not (_wrong or _denied)")
    trusted = F.col("_known") & (F.col("entitlement") == "authorized")
    fine = fine.withColumn("status", F.when(F.coalesce(trusted, F.lit(False)), F.col("status")).otherwise("unknown"))
    on = slices.select(*KEYS, F.col("start").alias("_cs"), F.col("end").alias("_ce"), "session_instance_id")
    cut = overlapping(fine.select(*KEYS, "start", "end", "status", "provenance_id", "entitlement"), on, KEYS)
    cut = cut.select(*KEYS, F.greatest("start", "_cs").alias("start"), F.least("end", "_ce").alias("end"), "status", "provenance_id", "session_instance_id", "entitlement")
    return cut.where("session_instance_id is not null").drop("entitlement"), fine.where("entitlement is not null"), bad.unionByName(cut.where("session_instance_id is null").select(*KEYS, "start", "end", F.lit("unknown").alias("reason")))


def page_statuses(pages: DataFrame, slices: DataFrame, rows: DataFrame, gaps: DataFrame, segments: DataFrame | None, used: DataFrame) -> DataFrame:
    """(keys, status): complete, empty, partial, unknown or unsupported, from what a page covers of its slices.

    Unsupported stays so. With a gap a page is partial; cut short, it is partial with segments, else unknown. Complete
    segments of used sources that cover all slices make it complete (empty, if the provider says so and no row is
    left); those that reach from the start of some slice, or a partial segment, make it partial; else it is unknown.
    """
    count = lambda df, name: df.groupBy(*KEYS).agg(F.count("*").alias(name))
    facts = pages.select(*KEYS, F.col("status").alias("_said"), "truncated").join(count(gaps, "n_gaps"), KEYS, "left").join(count(rows, "n_rows"), KEYS, "left")
    if segments is None:
        facts = facts.withColumns({c: F.lit(0) for c in ("n_segments", "n_partial", "n_bare", "n_begun")})
    else:
        proven = segments.join(used, [*KEYS, "provenance_id"], "left_semi")
        whole = proven.where("status = 'complete'").select(*KEYS, "start", "end")
        plain = slices.select(*KEYS, "start", "end")
        begun = overlapping(plain, whole.withColumnsRenamed({"start": "_cs", "end": "_ce"}), KEYS).where("_cs <= start")
        facts = facts.join(count(segments, "n_segments"), KEYS, "left").join(count(proven.where("status = 'partial'"), "n_partial"), KEYS, "left")
        facts = facts.join(count(uncovered(plain, whole, KEYS, []), "n_bare"), KEYS, "left").join(count(begun, "n_begun"), KEYS, "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0)) > 0
    status = (
        F.when(F.col("_said") == "unsupported", "unsupported").when(n("n_gaps"), "partial").when(F.col("truncated"), F.when(n("n_segments"), "partial").otherwise("unknown"))
        .when(~n("n_bare") & n("n_begun"), F.when((F.col("_said") == "empty") & ~n("n_rows"), "empty").otherwise("complete")).when(n("n_begun") | n("n_partial"), "partial").otherwise("unknown")
    )
    return facts.select(*KEYS, status.alias("status"))


def answers(mapped: dict[str, DataFrame], plan_gaps: DataFrame) -> dict[str, DataFrame]:
    """rows, gaps, contents and summaries of all requests: the gaps of a plan and of its pages as one, rows outside them.

    A row that touches a gap is dropped and its whole interval becomes a conflict. Contents have the number of rows,
    the labels of the sources in use and whether a row is provisional; a summary has the number of gaps too, and the
    page statuses' weakest.
    """
    keys = ["request_id"]
    every = plan_gaps.select(*keys, "start", "end", "reason").unionByName(mapped["gaps"].select(*keys, "start", "end", "reason"))
    rows = mapped["rows"]
    kept = outside(rows, every, keys, [*KEYS[1:], "row_id", "start", "end"])
    lost = rows.join(kept.select(*KEYS, "row_id"), [*KEYS, "row_id"], "left_anti").select(*keys, "start", "end", F.lit("validation_conflict").alias("reason"))
    gaps = normalize_gaps(every.unionByName(lost), keys, RESPONSE_PRIORITY)
    used = mapped["provenance"].join(kept.select(*KEYS, "provenance_id").distinct(), [*KEYS, "provenance_id"], "left_semi")
    labels = used.groupBy(*keys).agg(summary_label("provider").alias("source"), summary_label("entitlement").alias("entitlement"))
    facts = kept.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.bool_or(F.col("validation_state") == "provisional").alias("provisional"))
    order = ("unsupported", "unknown", "partial", "empty", "complete")
    place = F.array_position(F.array(*map(F.lit, order)), F.col("status"))
    worst = mapped["statuses"].groupBy(*keys).agg(F.min(place).alias("_at"))
    n_gaps = gaps.groupBy(*keys).agg(F.count("*").alias("n_gaps"))
    contents = worst.join(facts, keys, "left").join(labels, keys, "left")
    given = [F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("provisional", F.lit(False)).alias("provisional"), F.coalesce("source", F.lit("unknown")).alias("source"), F.coalesce("entitlement", F.lit("unknown")).alias("entitlement")]
    contents = contents.select(*keys, "_at", *given)
    out = contents.join(n_gaps, keys, "left")
    status = F.element_at(F.array(*map(F.lit, order)), F.col("_at").cast("int"))
    some = (F.coalesce("n_gaps", F.lit(0)) > 0) | F.col("provisional")
    status = F.when((status != "unsupported") & some, "partial").otherwise(status)
    summary = out.select(*keys, status.alias("status"), "n_rows", F.coalesce("n_gaps", F.lit(0)).alias("n_gaps"), "provisional", "source", "entitlement")
    return {"rows": kept, "gaps": gaps, "contents": contents.drop("_at"), "summaries": summary}
