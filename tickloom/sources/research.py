"""Research observations: a provider's own daily JSON, checked but never canonical."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.time import DAY, parse_rfc3339
from tickloom.functions.values import DECIMAL_TOKEN, has_exact_keys, is_non_negative, is_positive
from tickloom.operators.sequence import stretch
from tickloom.operators.stretches import with_previous

SYMBOLS, DAYS, ROWS = 8, 3650, 24_000
#: A page's keys, and what some of them must hold.
PAGE_KEYS = (
    "schema_version", "status", "provider", "source", "asset_class", "classification_source", "resolution", "effective_resolution", "adjustment", "provider_adjustment_semantics",
    "adjustment_confirmed_raw", "provider_repair_enabled", "numeric_encoding", "volume_encoding", "canonical", "point_in_time", "executable", "display_only", "requested_range", "requested_symbols",
    "returned_symbols", "missing_symbols", "available_at", "fetched_at", "source_observed_at", "request_started_at", "cache_status", "freshness", "coverage", "action_coverage", "actions", "bars", "provenance",
)
PAGE_VALUES = {
    "schema_version": "yfinance-history-bridge-v1", "provider": "yfinance", "source": "Yahoo Finance", "classification_source": "caller_declared", "resolution": "1d", "effective_resolution": "1d",
    "provider_adjustment_semantics": "unknown_or_provider_native", "adjustment_confirmed_raw": "false", "provider_repair_enabled": "false", "numeric_encoding": "binary_float_projection",
    "volume_encoding": "integer_exact_or_safe_integer_float", "canonical": "false", "point_in_time": "false", "executable": "false", "display_only": "true",
}
BAR = "symbol string, asset_class string, event_ts_utc string, resolution string, adjustment string, open string, high string, low string, close string, adj_close string, volume string, dividends string, stock_splits string"


def parse_bars(pages: DataFrame, column: str = "page") -> DataFrame:
    """The bars of JSON pages ({"bars": [...]}), one row each."""
    parsed = F.from_json(column, f"struct<bars:array<struct<{BAR.replace(' string', ':string')}>>>", {"mode": "FAILFAST"})
    return pages.select(F.explode(parsed["bars"]).alias("b")).select("b.*")


def bar_rules() -> dict[str, Column]:
    c = F.col
    price = lambda n: c(n).try_cast("decimal(38,18)")
    return {
        "resolution": c("resolution") == "1d",
        "positive": is_positive(c("open")) & is_positive(c("high")) & is_positive(c("low")) & is_positive(c("close")),
        "high_low": (price("low") <= F.least(price("open"), price("close"))) & (F.greatest(price("open"), price("close")) <= price("high")),
        "volume": is_non_negative(c("volume")),
        "tokens": c("dividends").rlike(DECIMAL_TOKEN) & c("stock_splits").rlike(DECIMAL_TOKEN),
    }


def out_of_order(bars: DataFrame, ordinal: str, width: int | None = None) -> DataFrame:
    """Bars that do not come after the one before of their symbol, by their place (ordinal) on the page."""
    cut = F.floor(F.col(ordinal) / (width or stretch(bars, ordinal)))
    return with_previous(bars, ["symbol"], cut, [ordinal], F.col("event_ts_utc"), "_previous").where(F.col("_previous") >= F.col("event_ts_utc")).drop("_previous")


def coverage_mismatch(bars: DataFrame, declared: DataFrame) -> DataFrame:
    """Symbols whose count, first or last bar is not what the page declares (symbol, n, first, last)."""
    found = bars.groupBy("symbol").agg(F.count("*").alias("n"), F.min("event_ts_utc").alias("first"), F.max("event_ts_utc").alias("last"))
    f, d = found.alias("f"), declared.alias("d")
    same = F.col("f.n").eqNullSafe(F.col("d.n")) & F.col("f.first").eqNullSafe(F.col("d.first")) & F.col("f.last").eqNullSafe(F.col("d.last"))
    return f.join(d, "symbol", "full_outer").where(~same).select("symbol", F.col("f.n").alias("n"), F.col("d.n").alias("declared_n"))


#: The parts of a page that its rules look at.
PAGE_PARTS = (*PAGE_VALUES, "status", "requested_range.start", "requested_range.end", "requested_range.semantics", "requested_symbols", "returned_symbols", "missing_symbols", "coverage.bar_count", "bars")


def with_parts(pages: DataFrame, page: str = "page", name: str = "parts") -> DataFrame:
    """pages with a struct of the texts, numbers and times that `page_rules` judges; each is read from its page once."""
    flat = lambda path: path.replace(".", "_")
    found = pages.withColumn(name, F.struct(*[F.get_json_object(page, f"$.{p}").alias(flat(p)) for p in PAGE_PARTS]))
    part = lambda path: F.col(f"{name}.{flat(path)}")
    symbols = {f"{c}_symbols": F.from_json(part(f"{c}_symbols"), "array<string>") for c in ("requested", "returned", "missing")}
    made = {"first": parse_rfc3339(part("requested_range.start")), "last": parse_rfc3339(part("requested_range.end")), "n_bars": F.json_array_length(part("bars"))}
    rest = [part(p).alias(flat(p)) for p in PAGE_PARTS if p not in (*symbols, "bars", "requested_range.start", "requested_range.end")]
    return found.withColumn(name, F.struct(*rest, *[c.alias(k) for k, c in {**symbols, **made}.items()]))


def page_rules(page: str = "page", name: str = "parts") -> dict[str, Column]:
    """What a page (JSON text) of a research window fulfils as a whole, by name; its bars have rules of their own. The
    table has its parts (`with_parts`)."""
    at = lambda part: F.col(f"{name}.{part}")
    fixed = F.lit(True)
    for key, value in PAGE_VALUES.items():
        fixed = fixed & at(key).eqNullSafe(F.lit(value))
    return {
        "keys": has_exact_keys(F.col(page), list(PAGE_KEYS)),
        "fixed": fixed,
        "status": F.coalesce(at("status").isin("ready", "partial") & ((at("status") == "partial") == (F.size(at("missing_symbols")) > 0)), F.lit(False)),
        "range": F.coalesce((at("first") < at("last")) & (at("last") - at("first") <= DAYS * DAY) & (at("requested_range_semantics") == "start_inclusive_end_exclusive"), F.lit(False)),
        "symbols": F.coalesce(F.size(at("requested_symbols")).between(1, SYMBOLS) & partition_holds(at("requested_symbols"), at("returned_symbols"), at("missing_symbols")), F.lit(False)),
        "bar_count": F.coalesce((at("n_bars") > 0) & (at("n_bars") <= ROWS) & (at("coverage_bar_count").cast("long") == at("n_bars")), F.lit(False)),
    }


def partition_holds(requested: Column, returned: Column, missing: Column) -> Column:
    """returned and missing are disjoint and together are what was requested."""
    return (F.size(F.array_intersect(returned, missing)) == 0) & (F.array_sort(F.array_union(returned, missing)) == F.array_sort(F.array_distinct(requested)))
