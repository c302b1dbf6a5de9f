"""Time as whole nanoseconds since 1970 (bigint): Spark's timestamps stop at microseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000_000
MINUTE, HOUR, DAY = 60 * SECOND, 3600 * SECOND, 86_400 * SECOND
RFC3339 = r"^(\d{4}-\d{2}-\d{2})[Tt](\d{2}:\d{2}:\d{2})(?:\.(\d{1,9}))?([Zz]|[+-]\d{2}:\d{2})$"


def ns_of(ts: Column) -> Column:
    """A timestamp as nanoseconds; one without zone counts as UTC."""
    return F.unix_micros(ts.cast("timestamp")) * F.lit(1000)


def parse_rfc3339(text: Column) -> Column:
    """Nanoseconds of an RFC 3339 text; null if it is none. Values beyond bigint fail (ANSI mode)."""
    zone = F.regexp_replace(F.regexp_extract(text, RFC3339, 4), "^[Zz]$", "+00:00")
    whole = F.concat_ws("", F.regexp_extract(text, RFC3339, 1), F.lit("T"), F.regexp_extract(text, RFC3339, 2), zone)
    seconds = F.unix_seconds(F.try_to_timestamp(whole, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")))
    fraction = F.rpad(F.regexp_extract(text, RFC3339, 3), 9, "0").cast("bigint")
    return F.when(text.rlike(RFC3339), seconds * F.lit(SECOND) + fraction)


def format_rfc3339(ns: Column) -> Column:
    """The shortest RFC 3339 text in UTC; negative values round down to their second."""
    rest = F.pmod(ns, F.lit(SECOND))
    head = F.date_format(F.timestamp_seconds((ns - rest).cast("decimal(20,0)") / F.lit(SECOND)), "yyyy-MM-dd'T'HH:mm:ss")
    tail = F.rtrim(F.lpad(rest.cast("string"), 9, "0"), F.lit("0"))
    return F.concat(head, F.when(rest == 0, F.lit("")).otherwise(F.concat(F.lit("."), tail)), F.lit("Z"))


def bucket_start(ns: Column, anchor: int | Column, width: int) -> Column:
    """Start of the bucket of a time, in buckets counted from anchor."""
    anchor = F.lit(anchor) if isinstance(anchor, int) else anchor
    return ns - F.pmod(ns - anchor, F.lit(width))


def is_canonical_date(text: Column) -> Column:
    """Whether a text is a real date written YYYY-MM-DD."""
    return F.coalesce(F.date_format(F.try_to_timestamp(text, F.lit("yyyy-MM-dd")), "yyyy-MM-dd") == text, F.lit(False))


def local_time_ns(date: Column, clock: str | Column, zone: str = "America/New_York") -> Column:
    """Nanoseconds of a civil date and clock time in a zone, with its daylight saving."""
    clock = F.lit(clock) if isinstance(clock, str) else clock
    local = F.to_timestamp(F.concat(date.cast("string"), F.lit(" "), clock))
    return ns_of(F.to_utc_timestamp(local, zone))


def month_key(ns: Column) -> Column:
    """UTC month, YYYY-MM."""
    return F.date_format(F.timestamp_micros(((ns - F.pmod(ns, F.lit(1000))) / 1000).cast("bigint")), "yyyy-MM")


def day_number(ns: Column) -> Column:
    """Whole UTC days since 1970."""
    return ((ns - F.pmod(ns, F.lit(DAY))) / F.lit(DAY)).cast("int")
