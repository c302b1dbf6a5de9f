"""Versions of the same rows: duplicates, lineage, comparison within tolerances, authority."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom import errors
from tickloom.functions.values import row_hash
from tickloom.operators.intervals import overlapping
from tickloom.operators.stretches import with_running_sum


def duplicates(rows: DataFrame, identity: list[str]) -> DataFrame:
    """Per identity: rows and different payloads; more than one payload is a conflict. Nulls are values like others."""
    payload = F.struct(*[c for c in rows.columns if c not in identity])
    return rows.groupBy(*identity).agg(F.count("*").alias("n_rows"), F.count_distinct(payload).alias("n_payloads"))


def deduplicated(rows: DataFrame, identity: list[str]) -> DataFrame:
    """One of each set of equal rows; fails if two rows of an identity differ."""
    if not duplicates(rows, identity).where("n_payloads > 1").isEmpty():
        raise errors.CacheConflict("rows of one identity differ")
    return rows.dropDuplicates()


def smallest_encoding(rows: DataFrame, identity: list[str], encoding: Column, keep: list[str]) -> DataFrame:
    """Of each identity the row with the smallest encoding."""
    return rows.groupBy(*identity).agg(F.min_by(F.struct(*keep), encoding).alias("_row")).select(*identity, *[F.col(f"_row.{k}").alias(k) for k in keep])


def orphans(rows: DataFrame, parents: DataFrame, row_key: list[str], parent_key: list[str]) -> DataFrame:
    """Rows without a parent."""
    on = [rows[a].eqNullSafe(parents[b]) for a, b in zip(row_key, parent_key)]
    return rows.join(parents, on, "left_anti")


def compared(old: DataFrame, new: DataFrame, identity: list[str], decimals: dict[str, str], exact_fields: list[str]) -> DataFrame:
    """Per identity: added, removed, equal, tolerated or conflict.

    decimals maps a field to its tolerance ("0" for none); exact fields must be equal, nulls included.
    """
    fields = [*decimals, *exact_fields]
    o = old.select(*identity, *[F.col(f).alias(f"old_{f}") for f in fields], F.lit(True).alias("_o"))
    n = new.select(*identity, *[F.col(f).alias(f"new_{f}") for f in fields], F.lit(True).alias("_n"))
    both = o.join(n, identity, "full_outer")
    moved = {f: F.abs(F.col(f"new_{f}") - F.col(f"old_{f}")) for f in decimals}
    conflict = F.lit(False)
    changed = F.lit(0)
    for f, tolerance in decimals.items():
        one_null = F.col(f"old_{f}").isNull() != F.col(f"new_{f}").isNull()
        conflict = conflict | one_null | F.coalesce(moved[f] > F.lit(tolerance).cast("decimal(38,18)"), F.lit(False))
        changed = changed + F.coalesce((moved[f] != 0).cast("int"), F.lit(0))
    for f in exact_fields:
        conflict = conflict | ~F.col(f"old_{f}").eqNullSafe(F.col(f"new_{f}"))
    status = F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed").when(conflict, "conflict").when(changed > 0, "tolerated").otherwise("equal")
    return both.select(*identity, status.alias("status"), F.when(F.col("_o") & F.col("_n"), changed).otherwise(0).alias("changed_fields"))


def verdict(statuses: DataFrame, most_added: int = 0, removed_allowed: bool = False, most_changed: int = 0) -> DataFrame:
    """One row of counts and whether the candidate is accepted; by default only an identical one is."""
    n = {s: F.count_if(F.col("status") == s).alias(s) for s in ("added", "removed", "conflict", "tolerated", "equal")}
    row = statuses.agg(*n.values(), F.coalesce(F.sum("changed_fields"), F.lit(0)).alias("changed_fields"))
    ok = (F.col("conflict") == 0) & (F.col("added") <= most_added) & (F.col("tolerated") <= most_changed)
    return row.withColumn("accepted", ok & ((F.col("removed") == 0) | F.lit(removed_allowed)))


def session_verdicts(statuses: DataFrame, session: str) -> DataFrame:
    """Per session its conflicts; one conflicting session rejects the whole batch."""
    per = statuses.groupBy(session).agg(F.count_if(F.col("status").isin("conflict", "removed")).alias("conflicts"), F.count("*").alias("compared"))
    rejected = statuses.agg(F.coalesce(F.bool_or(F.col("status").isin("conflict", "removed")), F.lit(False))).scalar()
    return per.withColumn("batch_rejected", rejected)


def coverage_overlap(old: DataFrame, new: DataFrame, session: str) -> DataFrame:
    """The stretch of each session that both versions cover."""
    o = old.groupBy(session).agg(F.min("start").alias("os"), F.max("end").alias("oe"))
    n = new.groupBy(session).agg(F.min("start").alias("ns"), F.max("end").alias("ne"))
    return o.join(n, session).select(session, F.greatest("os", "ns").alias("start"), F.least("oe", "ne").alias("end")).where("start < end")


def session_bounds(segments: DataFrame, session: str) -> DataFrame:
    """Bounds of each session whose segments are all complete and follow one another."""
    order = W.partitionBy(session).orderBy("start")
    joined = segments.withColumn("_joins", F.coalesce(F.lag("end").over(order) == F.col("start"), F.lit(True)))
    per = joined.groupBy(session).agg(F.min("start").alias("start"), F.max("end").alias("end"), F.bool_and((F.col("status") == "complete") & F.col("_joins")).alias("whole"))
    return per.where("whole").drop("whole")


def authority(provider: Column, feed: Column, complete: Column, n_rows: Column, validated: Column, basis: Column, entitlement: Column, encoding: Column) -> Column:
    """authoritative or provisional."""
    signed = (basis == "signed_admission") & (entitlement == "authorized") & encoding.isin("decimal_token", "integer_token")
    observed = (basis == "observed_query") & (entitlement == "unknown") & (encoding == "decimal_token")
    good = (provider == "alpaca") & feed.isin("sip", "boats") & complete & (n_rows > 0) & validated & (signed | observed)
    return F.when(F.coalesce(good, F.lit(False)), "authoritative").otherwise("provisional")


def downgraded(segments: DataFrame, partial: Column) -> DataFrame:
    """Segments whose complete status becomes partial where asked."""
    return segments.withColumn("status", F.when(partial & (F.col("status") == "complete"), "partial").otherwise(F.col("status")))


def bag_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that two tables do not hold equally often, with how often each does: one shuffle of partial counts."""
    columns = left.columns
    both = left.select(*columns, F.lit(1).alias("_a"), F.lit(0).alias("_b")).union(right.select(*columns, F.lit(0), F.lit(1)))
    return both.groupBy(*columns).agg(F.sum("_a").alias("n_left"), F.sum("_b").alias("n_right")).where("n_left <> n_right")


def same_bag(left: DataFrame, right: DataFrame) -> bool:
    """Whether two tables hold the same rows equally often."""
    return bag_difference(left, right).isEmpty()


def with_verified_at(rows: DataFrame, cached: DataFrame, verified_at: int) -> DataFrame:
    """rows with verified_at, if every row consumes one equal cached row; null otherwise, for all."""
    covered = bag_difference(rows, cached.select(*rows.columns)).where("n_left > n_right").isEmpty()
    return rows.withColumn("verified_at", F.lit(verified_at if covered else None).cast("bigint"))


def compared_inside(old: DataFrame, new: DataFrame, session: str, identity: list[str], decimals: dict[str, str], exact_fields: list[str]) -> DataFrame:
    """compared, of the rows (start, end) that lie in the stretch of their session that both versions cover."""
    shared = coverage_overlap(old, new, session).select(session, F.col("start").alias("_from"), F.col("end").alias("_to"))
    inside = lambda rows: rows.join(shared, session).where("start >= _from and end <= _to").drop("_from", "_to")
    return compared(inside(old), inside(new), identity, decimals, exact_fields)


def sub_window(rows: DataFrame, segments: DataFrame, session: str, start: int, end: int) -> DataFrame:
    """Rows of [start, end) of the sessions whose complete segments cover it; other sessions serve nothing."""
    whole = session_bounds(segments, session).where((F.col("start") <= start) & (F.col("end") >= end)).select(session)
    return rows.join(whole, session, "left_semi").where((F.col("start") >= start) & (F.col("end") <= end))


#: Sessions of a shard, and bytes of one.
SHARD_SESSIONS, SHARD_BYTES = 64, 256 * 1024


def month_shards(sessions: DataFrame, month: str, session: str, size: Column, most: int = SHARD_SESSIONS, most_bytes: int = SHARD_BYTES, prefix: int = 15) -> DataFrame:
    """sessions with shard_id (month and number, in order of session), and rule where a shard has too many bytes.

    A month's sessions are counted in stretches of equal beginnings (prefix characters), so a large month is many tasks.
    """
    counted = with_running_sum(sessions, [month], F.substring(session, 1, prefix), [session], F.lit(1), "_n")
    numbered = counted.withColumn("_n", F.floor((F.col("_n") - 1) / most).cast("int")).withColumn("_size", size)
    total = F.sum("_size").over(W.partitionBy(month, "_n"))
    shard = F.concat(F.col(month), F.lit("-"), F.lpad(F.col("_n").cast("string"), 4, "0"))
    return numbered.withColumn("shard_id", shard).withColumn("rule", F.when(total > most_bytes, "InputLimit")).drop("_n", "_size")


def key_fingerprint(request: dict[str, Column]) -> Column:
    """A cache key's digest: its fields by name, length-prefixed."""
    from tickloom.functions.values import digest

    parts: list[Column] = []
    for name in sorted(request):
        parts += [F.lit(name), F.coalesce(request[name].cast("string"), F.lit("\x00"))]
    return digest("cache-key-v1", *parts)


def broken_pages(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Pages (number, token, next_token, received_ns) whose token is not the one the page before gave, whose
    receive time repeats, or that follow a last page."""
    order = W.partitionBy(*keys).orderBy("number")
    due, before = F.lag("next_token").over(order), F.lag("received_ns").over(order)
    first = F.row_number().over(order) == 1
    ok = F.when(first, F.col("token").isNull()).otherwise(due.isNotNull() & (due == F.col("token")) & (F.col("received_ns") > before))
    return pages.withColumn("_ok", F.coalesce(ok, F.lit(False))).where("not _ok").drop("_ok")


def coverage_evidence(rows: DataFrame, segments: DataFrame, session: str, hashed: Column | None = None) -> DataFrame:
    """Per segment (session, start, end, status): its rows and their digest, and rows that cross its bounds.

    Rows meet segments by session and stretch of time, so a busy session is many small joins. The digest adds up
    hashes of rows (hashed: the hash of one, by default of all its columns), so nothing is sorted or gathered.
    """
    of = row_hash([F.col(c) for c in rows.columns]) if hashed is None else hashed
    others = rows.select(session, F.col("start").alias("_cs"), F.col("end").alias("_ce"), of.alias("_h"))
    s = segments.select(session, "start", "end", "status")
    met = overlapping(s, others, [session]).withColumnsRenamed({"_cs": "_s", "_ce": "_e"})
    inside = (F.col("_s") >= F.col("start")) & (F.col("_e") <= F.col("end"))
    found = met.groupBy(session, "start", "end", "status").agg(
        F.count_if(inside).alias("n_rows"), F.count_if(F.col("_s").isNotNull() & ~inside).alias("n_straddling"), F.coalesce(F.sum(F.when(inside, F.col("_h").cast("decimal(38,0)"))), F.lit(0)).cast("string").alias("digest")
    )
    lost = s.join(found.select(session, "start", "end"), [session, "start", "end"], "left_anti")
    zero = lost.select(session, "start", "end", "status", F.lit(0).cast("long").alias("n_rows"), F.lit(0).cast("long").alias("n_straddling"), F.lit("0").alias("digest"))
    return found.unionByName(zero)


def is_complete(evidence: DataFrame, session: str, start: int, end: int) -> DataFrame:
    """Per session whether its evidence covers [start, end) with complete segments that no row crosses."""
    order = W.partitionBy(session).orderBy("start")
    joined = evidence.where((F.col("end") > start) & (F.col("start") < end)).withColumn("_joins", F.coalesce(F.lag("end").over(order) == F.col("start"), F.lit(True)))
    whole = F.bool_and((F.col("status") == "complete") & (F.col("n_straddling") == 0) & F.col("_joins"))
    return joined.groupBy(session).agg((whole & (F.min("start") <= start) & (F.max("end") >= end)).alias("complete"))
