"""The source of a slice, and what its capability allows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CUTOFF_DATE, CUTOFF = "2016-01-01", "2016-01-01T05:00:00Z"
RESEARCH = ("yfinance", "daily")
MODES = ("auto", "alpaca_only", "futu_only", "research")


def choice(mode: Column, trade_date: Column, daily: Column, phase: Column, rank: Column) -> Column:
    """struct(provider, feed, gap): the first rule that holds decides."""

    def of(provider: str | None, feed: Column | str | None, gap: str | None) -> Column:
        feed = F.lit(feed) if not isinstance(feed, Column) else feed
        return F.struct(F.lit(provider).cast("string").alias("provider"), feed.cast("string").alias("feed"), F.lit(gap).cast("string").alias("gap"))

    sip = F.when(phase == "over", "boats").otherwise("sip")
    early = (trade_date < CUTOFF_DATE) & daily
    return (
        F.when(rank.isNull(), of(None, None, "future_session"))
        .when(early & mode.isin("auto", "research"), of(*RESEARCH, None))
        .when(early, of(None, None, "source_mode_excludes_required_provider"))
        .when(mode == "research", of(*RESEARCH, None))
        .when((mode == "auto") & rank.isin("new", "buffer"), of("futu", None, None))
        .when(mode == "auto", of("alpaca", sip, None))
        .when(mode == "futu_only", of("futu", None, None))
        .when(mode == "alpaca_only", of("alpaca", sip, None))
    )


def with_capability(slices: DataFrame, capabilities: DataFrame, as_of: int | Column) -> DataFrame:
    """Slices with their capability (first by priority) and the flags that follow from it.

    capabilities: provider, feed, phase, interval, historical, realtime, priority; nulls equal nulls.
    """
    now = F.lit(as_of) if isinstance(as_of, int) else as_of
    keys = ["provider", "feed", "phase", "interval"]
    first = capabilities.groupBy(*keys).agg(F.min_by(F.struct("historical", "realtime"), "priority").alias("cap"))
    s, c = slices.alias("s"), first.alias("c")
    on = F.col("s.provider").eqNullSafe(F.col("c.provider"))
    for k in keys[1:]:
        on = on & F.col(f"s.{k}").eqNullSafe(F.col(f"c.{k}"))
    out = s.join(c, on, "left").select("s.*", F.coalesce("c.cap.historical", F.lit(False)).alias("_h"), F.coalesce("c.cap.realtime", F.lit(False)).alias("_r"))
    live = F.col("active") & (F.col("start") <= now) & (now < F.col("end"))
    access = F.col("_h") | (live & F.col("_r"))
    gap = F.coalesce(F.col("choice_gap"), F.when(~access, "missing_provider_capability"))
    futu = F.coalesce(F.col("provider") == "futu", F.lit(False))
    return (
        out.withColumn("gap", gap).withColumn("historical", F.col("_h")).withColumn("realtime", F.col("provider").isNotNull() & gap.isNull() & live & F.col("_r"))
        .withColumn("provisional", F.coalesce((F.col("market_closed") & (F.col("rank") == "buffer") & futu) | ((F.col("interval") == "1d") & (F.col("rank") == "new") & futu & F.col("active")), F.lit(False)))
        .drop("_h", "_r", "choice_gap")
    )
