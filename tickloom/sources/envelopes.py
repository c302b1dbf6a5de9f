"""JSON lines of event envelopes: bounded, strict, flattened to the event columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import errors
from tickloom.functions.time import parse_rfc3339
from tickloom.functions.values import is_positive
from tickloom.sources.schemas import ENCODINGS, ENTITLEMENTS, EVENT_KINDS, EVENT_V1

LINE_BYTES, TOTAL_BYTES, RECORDS = 16 * 1024, 64 * 1024 * 1024, 100_000
METADATA = {"schema_version", "source", "generation", "sequence", "raw_frame_sha256", "source_timestamp", "received_timestamp"}
SHAPE = (
    "schema_version int, source struct<provider:string,feed:string,entitlement:string,numeric_encoding:string,source_record_id:string>, generation string, sequence string, "
    "raw_frame_sha256 string, source_timestamp string, received_timestamp string, event struct<kind:string,symbol:string,price:string,size:string,bid:string,ask:string,bid_size:string,ask_size:string>, control string"
)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """line, file and position of each non-blank line. Order inside a file follows the rows Spark reads."""
    lines = spark.read.text(path).select(F.rtrim(F.col("value"), F.lit("\r")).alias("line"), F.input_file_name().alias("file"))
    return lines.withColumn("ordinal", F.monotonically_increasing_id()).where(F.trim("line") != "")


def line_violations(lines: DataFrame) -> DataFrame:
    """Lines that are too long, are no object, or do not have exactly one of event and control and no other key."""
    keys = F.json_object_keys("line")
    known = F.array(*[F.lit(k) for k in sorted({*METADATA, "event", "control"})])
    nested = lambda name: F.json_object_keys(F.get_json_object("line", f"$.{name}"))
    twice = lambda ks: F.coalesce(F.size(ks) != F.size(F.array_distinct(ks)), F.lit(False))
    rule = (
        F.when(F.octet_length("line") > LINE_BYTES, "InputLimit")
        .when(keys.isNull(), "Contract")
        .when(F.size(F.array_except(keys, known)) > 0, "Contract")
        .when(twice(keys) | twice(nested("event")) | twice(nested("source")), "Contract")
        .when(F.array_contains(keys, "event") == F.array_contains(keys, "control"), "Contract")
    )
    return lines.withColumn("rule", rule).where("rule is not null")


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Flattened envelopes of a file or folder; a bad row or a broken limit fails the whole scan."""
    from tickloom.operators.bars import require

    lines = read_lines(spark, path)
    total = lines.agg(F.coalesce(F.sum(F.octet_length("line") + 1), F.lit(0)), F.count("*")).first()
    if total[0] > TOTAL_BYTES or total[1] > RECORDS:
        raise errors.InputLimit(f"{total[1]} records of {total[0]} bytes")
    require(line_violations(lines))
    return flatten(lines.withColumn("e", F.from_json("line", SHAPE, {"mode": "FAILFAST"})))


def flatten(parsed: DataFrame) -> DataFrame:
    """The event columns of parsed envelopes (struct e), with source_ns, received_ns and ordinal."""
    e = lambda name: F.col(f"e.{name}")
    out = parsed.select(
        e("schema_version").cast("bigint").alias("schema_version"),
        *[e(f"source.{c}").alias(c) for c in ("provider", "feed", "entitlement", "numeric_encoding", "source_record_id")],
        e("raw_frame_sha256").alias("raw_frame_sha256"),
        e("generation").cast("decimal(20,0)").alias("generation"),
        e("sequence").cast("decimal(20,0)").alias("sequence"),
        parse_rfc3339(e("source_timestamp")).alias("source_timestamp"),
        parse_rfc3339(e("received_timestamp")).alias("received_timestamp"),
        F.when(e("control").isNotNull(), "control").otherwise(e("event.kind")).alias("event_kind"),
        *[e(f"event.{c}").alias(c) for c in ("symbol", "price", "size", "bid", "ask", "bid_size", "ask_size")],
        "ordinal",
    )
    return out.withColumn("source_ns", F.col("source_timestamp")).withColumn("received_ns", F.col("received_timestamp"))


def event_rules() -> dict[str, Column]:
    """What a stored event fulfils, by name: enumerations, and which values each kind has."""
    c, null = F.col, lambda *n: F.coalesce(*[F.col(x) for x in n]).isNull()
    trade = c("event_kind").isin("stock_trade", "option_trade")
    return {
        "kind": c("event_kind").isin(*EVENT_KINDS),
        "entitlement": c("entitlement").isin(*ENTITLEMENTS),
        "encoding": c("numeric_encoding").isin(*ENCODINGS),
        "variant": F.when(trade, c("price").isNotNull() & c("size").isNotNull() & null("bid", "ask", "bid_size", "ask_size")).otherwise(null("price", "size") & c("bid").isNotNull() & c("ask").isNotNull()),
        "positive": F.when(trade, is_positive(c("price")) & is_positive(c("size"))).otherwise(F.lit(True)),
    }


def as_event_v1(events: DataFrame) -> DataFrame:
    return events.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in EVENT_V1.fields])


def synthetic_events(spark: SparkSession, n: int, start_ns: int, step_ns: int = 1_000_000) -> DataFrame:
    """n trades of one symbol in the event columns, by formula."""
    i = F.col("id") + 1
    price = F.concat((F.lit(600) + i % 700).cast("string"), F.lit("."), F.lpad(((i * 7919) % 10000).cast("string"), 4, "0"))
    ts = F.lit(start_ns) + F.col("id") * step_ns
    values = {
        "schema_version": F.lit(1), "provider": F.lit("synthetic"), "feed": F.lit("synthetic"), "entitlement": F.lit("unknown"), "numeric_encoding": F.lit("decimal_token"),
        "generation": F.lit(1), "sequence": i, "source_timestamp": ts, "received_timestamp": ts, "event_kind": F.lit("stock_trade"), "symbol": F.lit("QQQ"), "price": price,
        "size": (F.lit(1) + i % 1000).cast("string"),
    }
    columns = [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT_V1.fields]
    return spark.range(n).select(*columns, (i - 1).alias("ordinal"), ts.alias("source_ns"), ts.alias("received_ns"))
