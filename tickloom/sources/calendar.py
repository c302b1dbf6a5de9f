"""Trading calendars: days with their UTC bounds, phases of sessions, and their integrity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.functions.time import HOUR, local_time_ns

PHASES = (("pre", "04:00:00", "09:30:00"), ("regular", "09:30:00", "16:00:00"), ("after", "16:00:00", "20:00:00"))


def civil_days(spark: SparkSession, first: str, last: str, holidays: tuple[str, ...] = (), zone: str = "America/New_York") -> DataFrame:
    """trade_date, start, end (UTC, so 23 to 25 hours), status and session_id of each civil day."""
    return civil_days_of(spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)))).alias("d")), holidays, zone)


def civil_days_of(days: DataFrame, holidays: tuple[str, ...] = (), zone: str = "America/New_York") -> DataFrame:
    """civil_days of a table of dates d."""
    closed = F.dayofweek("d").isin(1, 7) | F.date_format("d", "yyyy-MM-dd").isin(*holidays)
    name = F.date_format("d", "yyyy-MM-dd")
    return days.select(
        name.alias("trade_date"), local_time_ns(F.col("d"), "00:00:00", zone).alias("start"), local_time_ns(F.date_add("d", 1), "00:00:00", zone).alias("end"),
        F.when(closed, "closed").otherwise("open").alias("status"), F.when(~closed, F.concat(F.lit("XNYS:"), name)).alias("session_id"),
    )


def phase_instances(days: DataFrame, early_closes: dict[str, str] | None = None, zone: str = "America/New_York") -> DataFrame:
    """Three phases of each open day; on an early close the regular phase ends then, and so does the day's after phase four hours later."""
    early = F.lit(None).cast("string")
    for date, clock in (early_closes or {}).items():
        early = F.when(F.col("trade_date") == date, clock).otherwise(early)
    parts = F.array(*[F.struct(F.lit(p).alias("phase"), F.lit(a).alias("a"), F.lit(b).alias("b")) for p, a, b in PHASES])
    out = days.where("status = 'open'").withColumn("early", early).select("trade_date", "session_id", "early", F.explode(parts).alias("p"))
    opens = F.when((F.col("p.phase") == "after") & F.col("early").isNotNull(), F.col("early")).otherwise(F.col("p.a"))
    closes = F.when((F.col("p.phase") == "regular") & F.col("early").isNotNull(), F.col("early")).otherwise(F.col("p.b"))
    start, end = local_time_ns(F.col("trade_date"), opens, zone), local_time_ns(F.col("trade_date"), closes, zone)
    end = F.when((F.col("p.phase") == "after") & F.col("early").isNotNull(), start + 4 * HOUR).otherwise(end)
    return out.select(F.concat("session_id", F.lit(":"), F.col("p.phase")).alias("session_instance_id"), "session_id", "trade_date", F.col("p.phase").alias("phase"), start.alias("start"), end.alias("end"))


def overnight_instances(days: DataFrame, zone: str = "America/New_York") -> DataFrame:
    """The band from 20:00 of the evening before an open day to its pre phase at 04:00."""
    before = F.date_add(F.to_date("trade_date"), -1)
    return days.where("status = 'open'").select(
        F.concat("session_id", F.lit(":over")).alias("session_instance_id"), "session_id", "trade_date", F.lit("over").alias("phase"),
        local_time_ns(before, "20:00:00", zone).alias("start"), local_time_ns(F.to_date("trade_date"), "04:00:00", zone).alias("end"),
    )


def closed_night_bands(days: DataFrame) -> DataFrame:
    """00-04 and 20-24 local time of closed days. The early band is what the day has beyond 20 hours, so it
    follows daylight saving."""
    length = F.col("end") - F.col("start")
    early = F.struct(F.col("start").alias("start"), (F.col("start") + length - 20 * HOUR).alias("end"))
    late = F.struct((F.col("end") - 4 * HOUR).alias("start"), F.col("end").alias("end"))
    return days.where("status = 'closed'").select("trade_date", F.explode(F.array(early, late)).alias("b")).select("trade_date", "b.start", "b.end")


def calendar_violations(days: DataFrame, instances: DataFrame) -> DataFrame:
    """(subject, rule) of everything that makes a calendar unusable. Calendars are small: one window orders them."""
    w = W.orderBy("trade_date")
    length = (F.col("end") - F.col("start")) / HOUR
    day_rule = (
        F.when(~length.isin(23, 24, 25), "day_length")
        .when(F.datediff(F.lead("trade_date").over(w), F.col("trade_date")) != 1, "dates_not_contiguous")
        .when(F.lead("start").over(w) != F.col("end"), "days_not_adjacent")
        .when((F.col("status") == "open") & F.dayofweek("trade_date").isin(1, 7), "open_weekend")
        .when((F.col("status") == "open") != F.col("session_id").isNotNull(), "session_id")
    )
    a = days.withColumn("rule", day_rule).select(F.col("trade_date").alias("subject"), "rule")
    order = W.orderBy("start", "end")
    b = instances.withColumn("rule", F.when(F.col("start") >= F.col("end"), "empty_instance").when(F.lag("end").over(order) > F.col("start"), "instances_overlap")).select(F.col("session_instance_id").alias("subject"), "rule")
    per = instances.groupBy("session_id").agg(F.array_sort(F.collect_list("phase")).alias("phases"))
    without_night = F.array_remove(F.col("phases"), "over")
    c = per.withColumn("rule", F.when(without_night != F.array(F.lit("after"), F.lit("pre"), F.lit("regular")), "phases")).select(F.col("session_id").alias("subject"), "rule")
    d = instances.groupBy(F.col("session_instance_id").alias("subject")).count().where("count > 1").select("subject", F.lit("id_not_unique").alias("rule"))
    e = days.where("status = 'open'").join(instances, "session_id", "left_anti").select(F.col("session_id").alias("subject"), F.lit("no_phases").alias("rule"))
    return a.union(b).union(c).union(d).union(e).where("rule is not null")


def read_snapshot(spark: SparkSession, path: str, sha256: str) -> tuple[DataFrame, DataFrame]:
    """(days, instances) of a JSON snapshot with that digest, checked."""
    from tickloom import errors
    from tickloom.functions.time import parse_rfc3339

    raw = spark.read.format("binaryFile").load(path).select(F.sha2("content", 256).alias("h"), F.col("content").cast("string").alias("t")).first()
    if raw is None or raw["h"] != sha256:
        raise errors.Contract("calendar digest")
    window = "struct<start:string,end_exclusive:string>"
    shape = f"days array<struct<trade_date:string,day_window:{window},state:struct<status:string,session_id:string,reason:string>,verification_status:string>>, instances array<struct<session_id:string,session_instance_id:string,trade_date:string,phase:string,window:{window}>>"
    doc = spark.createDataFrame([(raw["t"],)], "t string").select(F.from_json("t", shape, {"mode": "FAILFAST"}).alias("d"))
    d = doc.select(F.explode("d.days").alias("x"))
    days = d.select("x.trade_date", parse_rfc3339(F.col("x.day_window.start")).alias("start"), parse_rfc3339(F.col("x.day_window.end_exclusive")).alias("end"), "x.state.status", "x.state.session_id", "x.verification_status")
    i = doc.select(F.explode("d.instances").alias("x"))
    instances = i.select("x.session_instance_id", "x.session_id", "x.trade_date", "x.phase", parse_rfc3339(F.col("x.window.start")).alias("start"), parse_rfc3339(F.col("x.window.end_exclusive")).alias("end"))
    bad = calendar_violations(days, instances).orderBy("subject", "rule").first()
    if bad:
        raise errors.Contract(f"calendar: {bad['subject']} {bad['rule']}")
    return days, instances
