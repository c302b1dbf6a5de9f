"""Resolutions, gap reasons and their priorities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.functions.time import DAY, HOUR, MINUTE

RESOLUTIONS = {"1m": MINUTE, "5m": 5 * MINUTE, "15m": 15 * MINUTE, "1h": HOUR, "1d": DAY}
#: Reasons from the strongest to the weakest; the page mapping and the response order two of them differently.
MAPPING_PRIORITY = ("entitlement_limited", "validation_conflict", "unsupported_resolution", "provider_unavailable", "source_gap", "excluded", "unknown")
RESPONSE_PRIORITY = ("validation_conflict", "entitlement_limited", "unsupported_resolution", "provider_unavailable", "source_gap", "excluded", "unknown")
SCOPES = {"all": ("pre", "regular", "after", "over"), "regular": ("regular",), "extended": ("pre", "after"), "overnight": ("over",)}


def width_of(resolution: Column) -> Column:
    out = F.lit(None).cast("bigint")
    for name, width in RESOLUTIONS.items():
        out = F.when(resolution == name, F.lit(width)).otherwise(out)
    return out


def bar_end(start: Column, resolution: Column, phase_end: Column) -> Column:
    """End of a bar: a step later, or the phase's end for its last bar and for daily bars."""
    return F.when(resolution == "1d", phase_end).otherwise(F.least(start + width_of(resolution), phase_end))


def in_scope(phase: Column, scope: Column) -> Column:
    out = F.lit(False)
    for name, phases in SCOPES.items():
        out = F.when(scope == name, phase.isin(*phases)).otherwise(out)
    return out


def priority_of(reason: Column, order: tuple[str, ...]) -> Column:
    """Larger for stronger reasons; null for others."""
    out = F.lit(None).cast("int")
    for i, name in enumerate(reversed(order)):
        out = F.when(reason == name, F.lit(i)).otherwise(out)
    return out


def failure_reason(error: Column) -> Column:
    """The gap that a failed page leaves."""
    return (
        F.when(error.isin("unauthorized", "forbidden"), "entitlement_limited")
        .when(error.isin("malformed_page", "invalid_page"), "validation_conflict")
        .when(error.isin("adjustment", "size_limit", "page_limit"), "unknown")
        .otherwise("provider_unavailable")
    )


def summary_label(values: str) -> Column:
    """Aggregate: the one value of a group, "mixed" for several, "unknown" for none."""
    n = F.count_distinct(F.col(values))
    return F.when(n == 0, "unknown").when(n == 1, F.min(values)).otherwise("mixed")
