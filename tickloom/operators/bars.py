"""Trades to bars, bars' rules, the expected grid, and facts of a dataset."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import errors
from tickloom.functions.market import RESOLUTIONS
from tickloom.functions.time import MINUTE, bucket_start, is_canonical_date
from tickloom.functions.values import exact, is_label, is_sha256, normal_form

TRADE, QUOTE = "stock_trade", "stock_quote"


@dataclass(frozen=True)
class BarWindow:
    """The window that bars are made for, and the evidence that it is complete."""

    start: int
    end: int
    session_start: int
    session_end: int
    symbols: tuple[str, ...]
    available_at: int
    mode: str = "synthetic"
    input_eof: bool = True
    source_is_paged: bool = False
    source_pages_exhausted: bool | None = None
    trade_date: str = ""
    session_id: str = ""
    timezone: str = "America/New_York"
    policy_id: str = ""
    policy_sha256: str = ""
    limits: dict = field(default_factory=lambda: {"symbols": 500, "minutes": 390, "rows": 100_000})

    @property
    def minutes(self) -> int:
        return (self.end - self.start) // MINUTE

    def check(self) -> None:
        """Conditions on the request itself."""
        if not self.input_eof or self.source_pages_exhausted is False:
            raise errors.IncompleteWindow("input has not ended")
        if self.source_is_paged != (self.source_pages_exhausted is not None):
            raise errors.IncompleteWindow("paging evidence does not fit")
        if not self.session_start <= self.start < self.end <= self.session_end:
            raise errors.Contract("window outside its session")
        if any((b - a) % MINUTE for a, b in ((self.session_start, self.start), (self.start, self.end), (self.session_start, self.session_end))):
            raise errors.Contract("not whole minutes")
        if self.available_at < self.end:
            raise errors.IncompleteWindow("available before its end")
        if len(set(self.symbols)) != len(self.symbols) or not 1 <= len(self.symbols) <= self.limits["symbols"]:
            raise errors.InputLimit("symbols")
        if not 1 <= self.minutes <= self.limits["minutes"] or self.minutes * len(self.symbols) > self.limits["rows"]:
            raise errors.InputLimit("minutes")

    def completion(self, provider: str) -> str:
        """The label of how completeness is known."""
        if self.mode == "synthetic" and provider == "synthetic" and not self.source_is_paged:
            return "synthetic_eof"
        if self.mode == "historical" and provider != "synthetic":
            return "historical_eof_paged" if self.source_is_paged else "historical_eof_nonpaged"
        raise errors.IncompleteWindow("mode does not fit the provider")


def event_violations(events: DataFrame, window: BarWindow) -> DataFrame:
    """Events that make a batch unusable, with the rule each breaks; control rows never do."""
    rules = [
        ("IncompleteWindow", F.col("source_ns").isNull()),
        ("IncompleteWindow", (F.col("source_ns") < window.start) | (F.col("source_ns") >= window.end)),
        ("IncompleteWindow", F.col("received_ns") > window.available_at),
        ("Contract", F.col("numeric_encoding") == "unspecified"),
        ("UnsupportedEvent", ~F.col("event_kind").isin(TRADE, QUOTE)),
        ("UnexpectedSymbol", ~F.col("symbol").isin(*window.symbols)),
    ]
    first = F.coalesce(*[F.when(bad, F.lit(name)) for name, bad in rules])
    return events.where("event_kind <> 'control'").withColumn("rule", first).where("rule is not null")


def require(violations: DataFrame) -> None:
    """Raise the error named by the first rule broken, in order of names; nothing if there is none."""
    found = violations.groupBy("rule").count().orderBy("rule").first()
    if found:
        raise getattr(errors, found["rule"], errors.Contract)(f"{found['count']} rows: {found['rule']}")


def ohlcv(events: DataFrame, keys: list[str], anchor: int | Column, width: int, trade: Column, quote: Column) -> DataFrame:
    """Bars of trades per keys and bucket; buckets with quotes only make no bar.

    events: source_ns, sequence, ordinal (arrival), price and size as tokens. Open and close keep their
    tokens; ties in time fall by sequence, then by arrival. One shuffle, with map-side partial aggregates.
    """
    order = F.struct("source_ns", "sequence", "ordinal")
    price, size = exact(F.col("price")), exact(F.col("size"))
    of = lambda c: F.when(trade, c)
    return (
        events.where(trade | quote)
        .groupBy(*keys, bucket_start(F.col("source_ns"), anchor, width).alias("bar_start"))
        .agg(
            F.min_by(F.col("price"), of(order)).alias("open"),
            F.max(of(price)).alias("high"),
            F.min(of(price)).alias("low"),
            F.max_by(F.col("price"), of(order)).alias("close"),
            F.sum(of(size)).alias("volume"),
            F.count_if(trade).alias("trade_count"),
            F.count_if(quote).alias("quote_events_excluded"),
            F.min(of(F.col("source_ns"))).alias("source_start"),
            (F.max(of(F.col("source_ns"))) + 1).alias("source_end"),
        )
        .where("trade_count > 0")
    )


def trade_bars(events: DataFrame, window: BarWindow) -> DataFrame:
    """One-minute bars of a window with their lineage; the whole batch fails if any condition does.

    events: flattened event columns (see sources.schemas) with source_ns, received_ns and ordinal.
    """
    window.check()
    require(event_violations(events, window))
    market = events.where("event_kind <> 'control'")
    identity = market.select("provider", "feed", "entitlement", "numeric_encoding").distinct().limit(2).collect()
    if len(identity) != 1:
        raise errors.MixedProvenance(f"{len(identity)} sources")
    mode = window.completion(identity[0]["provider"])
    bars = ohlcv(market, ["symbol"], window.start, MINUTE, F.col("event_kind") == TRADE, F.col("event_kind") == QUOTE)
    observed = bars.groupBy("symbol").agg(F.count("*").alias("n"))
    if observed.count() != len(window.symbols):
        raise errors.IncompleteWindow("a symbol without trades")
    constants = {
        "schema_version": 1, "source_timestamp_missing_rows": 0, "sequence_gap_count": 0, "late_event_count": 0, "window_expected_minutes": window.minutes,
        "window_input_eof": True, "source_pages_exhausted": window.source_pages_exhausted, "completion_mode": mode, "nbbo_input_status": "excluded",
        "available_at_utc": window.available_at, "trade_date": window.trade_date, "session_id": window.session_id, "session_timezone": window.timezone,
        "session_policy_id": window.policy_id, "session_policy_sha256": window.policy_sha256, "session_start_utc": window.session_start,
        "session_end_exclusive_utc": window.session_end, "window_start_utc": window.start, "window_end_exclusive_utc": window.end,
        **{f"source_{k}": v for k, v in identity[0].asDict().items()},
    }
    from tickloom.sources.schemas import TRADE_BAR

    full = (
        bars.join(observed, "symbol")
        .withColumns({k: F.lit(v) for k, v in constants.items()})
        .withColumn("bar_end_exclusive_utc", F.col("bar_start") + MINUTE)
        .withColumn("window_empty_trade_minutes", F.lit(window.minutes) - F.col("n"))
        .withColumns({c: normal_form(F.col(c)) for c in ("high", "low", "volume")})
        .withColumnsRenamed({"bar_start": "bar_start_utc", "source_start": "source_start_utc", "source_end": "source_end_exclusive_utc"})
    )
    return full.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TRADE_BAR.fields]).orderBy("symbol", "bar_start_utc")


def missing_minutes(bars: DataFrame, keys: list[str], spans: DataFrame, width: int) -> DataFrame:
    """The buckets of each key's span (keys, start, end) that have no bar (keys, bar_start)."""
    grid = spans.where("start < end").select(*keys, F.explode(F.sequence("start", F.col("end") - 1, F.lit(width))).alias("bar_start"))
    return grid.join(bars.select(*keys, "bar_start"), [*keys, "bar_start"], "left_anti")


def bar_rules() -> dict[str, Column]:
    """What every bar must fulfil, by name."""
    c, number = F.col, lambda n: exact(F.col(n))
    mode = (
        ((c("completion_mode") == "synthetic_eof") & (c("source_provider") == "synthetic") & c("source_pages_exhausted").isNull())
        | ((c("completion_mode") == "historical_eof_paged") & (c("source_provider") != "synthetic") & c("source_pages_exhausted").eqNullSafe(True))
        | ((c("completion_mode") == "historical_eof_nonpaged") & (c("source_provider") != "synthetic") & c("source_pages_exhausted").isNull())
    )
    return {
        "schema_version": c("schema_version") == 1,
        "window_in_session": (c("session_start_utc") <= c("window_start_utc")) & (c("window_start_utc") < c("window_end_exclusive_utc")) & (c("window_end_exclusive_utc") <= c("session_end_exclusive_utc")),
        "minute_alignment": F.pmod(c("bar_start_utc"), F.lit(MINUTE)) == 0,
        "bar_length": c("bar_end_exclusive_utc") == c("bar_start_utc") + MINUTE,
        "bar_in_window": (c("bar_start_utc") >= c("window_start_utc")) & (c("bar_end_exclusive_utc") <= c("window_end_exclusive_utc")),
        "available_after_window": c("available_at_utc") >= c("window_end_exclusive_utc"),
        "source_in_bar": (c("source_start_utc") >= c("bar_start_utc")) & (c("source_start_utc") < c("source_end_exclusive_utc")) & (c("source_end_exclusive_utc") <= c("bar_end_exclusive_utc")),
        "high_low": (number("low") <= number("open")) & (number("low") <= number("close")) & (number("open") <= number("high")) & (number("close") <= number("high")),
        "positive_price": number("low") > 0,
        "positive_volume": number("volume") > 0,
        "trades": c("trade_count") > 0,
        "counters": (c("source_timestamp_missing_rows") == 0) & (c("sequence_gap_count") == 0) & (c("late_event_count") == 0),
        "minutes": (c("window_expected_minutes") * MINUTE == c("window_end_exclusive_utc") - c("window_start_utc")) & (c("window_empty_trade_minutes") >= 0) & (c("window_empty_trade_minutes") < c("window_expected_minutes")),
        "completion": mode & c("window_input_eof"),
        "trade_date": (c("trade_date") == "") | is_canonical_date(c("trade_date")),
        "quotes_excluded": c("nbbo_input_status") == "excluded",
        "labels": is_label(c("source_provider")) & is_label(c("source_feed")) & is_label(c("session_id"), 128) & is_sha256(c("session_policy_sha256")),
    }


def market_bar_rules() -> dict[str, Column]:
    """What every bar of a provider must fulfil, by name: unlike a trade bar it may have no volume."""
    c, number = F.col, lambda n: exact(F.col(n))
    return {
        "schema_version": c("schema_version") == 1,
        "positive_price": F.least(number("open"), number("high"), number("low"), number("close")) > 0,
        "volume": number("volume") >= 0,
        "high_low": (number("low") <= F.least(number("open"), number("close"))) & (F.greatest(number("open"), number("close"), number("low")) <= number("high")),
        "start_before_end": c("bar_start_utc") < c("bar_end_exclusive_utc"),
        "ids": (F.trim("provenance_id") != "") & (F.trim("session_instance_id") != ""),
        "resolution": c("resolution").isin(*RESOLUTIONS),
    }


def broken_rules(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per row and rule it breaks, in a column rule; a rule that is null is broken."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]))
    return rows.withColumn("rule", F.explode(broken))


def null_counts(rows: DataFrame, required: list[str]) -> DataFrame:
    """One row: how many nulls each required column has."""
    return rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])


def dataset_facts(rows: DataFrame, identity: list[str], symbol: str, start: str, end: str, unique: list[str]) -> DataFrame:
    """One row of facts: sources, symbols, time range, missing times, and whether the key is unique.

    One aggregate over partial aggregates per key; no set of symbols is gathered, only counted.
    """
    per_key = rows.groupBy(*unique).agg(
        F.count("*").alias("n"), F.min(start).alias("s"), F.max(end).alias("e"), F.count_if(F.col(start).isNull()).alias("m"),
        F.min(F.struct(*identity)).alias("i0"), F.max(F.struct(*identity)).alias("i1"), F.min(symbol).alias("sym"),
    )
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count_distinct("sym").alias("n_symbols"),
        F.min("s").alias("source_start"),
        F.max("e").alias("source_end"),
        F.coalesce(F.sum("m"), F.lit(0)).alias("missing_times"),
        F.coalesce(F.bool_and(F.col("n") == 1), F.lit(True)).alias("unique_key"),
        F.coalesce(F.min("i0") == F.max("i1"), F.lit(True)).alias("single_source"),
    )


def grid_violations(bars: DataFrame) -> DataFrame:
    """Symbols whose bars are not one per minute, disagree in declared empties, or do not add up to their window."""
    per = bars.groupBy("symbol").agg(
        F.count("*").alias("n"), F.count_distinct("bar_start_utc").alias("starts"), F.min("window_expected_minutes").alias("expected"),
        F.min("window_empty_trade_minutes").alias("empty"), F.max("window_empty_trade_minutes").alias("empty_most"),
        F.count_distinct(F.struct("session_id", "session_start_utc", "session_end_exclusive_utc", "window_start_utc", "window_end_exclusive_utc", "available_at_utc")).alias("windows"),
    )
    rule = (
        F.when(F.col("n") != F.col("starts"), "duplicate_bar")
        .when(F.col("empty") != F.col("empty_most"), "inconsistent_empty_minutes")
        .when(F.col("n") + F.col("empty") != F.col("expected"), "undeclared_gap")
        .when(F.col("windows") > 1, "several_windows")
    )
    return per.withColumn("rule", rule).where("rule is not null").select("symbol", "rule")
