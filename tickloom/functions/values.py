"""Decimals kept exact, labels, tokens and digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(38,18)"
DECIMAL_TOKEN = r"^-?(0|[1-9]\d*)(\.\d+)?$"
INTEGER_TOKEN = r"^-?(0|[1-9]\d*)$"
TICKER = r"^[A-Z0-9.\-]{1,32}$"
#: Root, two digits each of year, month and day, call or put, strike in thousandths.
OPTION = r"^[A-Z]{1,6}\d{6}[CP]\d{8}$"
SHA256 = r"^[0-9a-f]{64}$"


def exact(token: Column) -> Column:
    """A decimal token's value; ANSI mode makes overflow an error."""
    return token.cast(EXACT)


def normal_form(number: Column) -> Column:
    """One text for equal decimals: no trailing zeros, no bare point."""
    text = number.cast("string")
    return F.when(text.contains("."), F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))).otherwise(text)


def is_positive(token: Column) -> Column:
    return F.coalesce(token.rlike(DECIMAL_TOKEN) & (token.try_cast(EXACT) > 0), F.lit(False))


def is_non_negative(token: Column) -> Column:
    return F.coalesce(token.rlike(DECIMAL_TOKEN) & (token.try_cast(EXACT) >= 0), F.lit(False))


def is_sha256(text: Column) -> Column:
    return F.coalesce(text.rlike(SHA256), F.lit(False))


def is_label(text: Column, most_bytes: int = 64) -> Column:
    """Non-empty, at most so many bytes, no space around it, no control characters."""
    return F.coalesce((F.octet_length(text) > 0) & (F.octet_length(text) <= most_bytes) & (F.trim(text) == text) & ~text.rlike(r"\p{Cntrl}"), F.lit(False))


def is_ticker(text: Column) -> Column:
    return F.coalesce(text.rlike(TICKER), F.lit(False))


def is_option_symbol(text: Column) -> Column:
    return F.coalesce(text.rlike(OPTION), F.lit(False))


def digest(domain: str, *parts: Column) -> Column:
    """SHA-256 of a domain and parts, each with its length in eight big-endian bytes before it."""
    pieces = []
    for part in (F.lit(domain), *parts):
        body = F.encode(part.cast("string"), "utf-8")
        pieces += [F.unhex(F.lpad(F.hex(F.octet_length(body)), 16, "0")), body]
    return F.sha2(F.concat(*pieces), 256)


def row_hash(columns: list[Column], seed: int = 0) -> Column:
    """A 64-bit hash of a row; a null is told apart from a value that moved to its neighbour."""
    return F.xxhash64(F.lit(seed), *columns, F.array(*[c.isNull() for c in columns]))


def set_digest(items: Column) -> Column:
    """One id for a set of labels: itself if it has one member, else a hash of the sorted members."""
    ordered = F.array_sort(F.array_distinct(items))
    return F.when(F.size(ordered) == 1, ordered[0]).otherwise(F.sha2(F.array_join(ordered, "\n"), 256))


def same_provider(a: Column, b: Column) -> Column:
    """Equal without regard to case; null if either is not known."""
    unknown = [F.lower(F.trim(x)).isin("unknown", "mixed", "") | x.isNull() for x in (a, b)]
    return F.when(unknown[0] | unknown[1], F.lit(None)).otherwise(F.lower(a) == F.lower(b))


def has_exact_keys(text: Column, keys: list[str]) -> Column:
    """Whether a JSON text is an object with exactly these keys, none of them twice."""
    found = F.json_object_keys(text)
    return F.coalesce((F.size(found) == len(keys)) & (F.array_sort(found) == F.array(*[F.lit(k) for k in sorted(keys)])), F.lit(False))
