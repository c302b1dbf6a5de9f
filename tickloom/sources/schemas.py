"""Closed schemas: column order, names, types and nullability are part of the contract."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tickloom import errors

S, U32, U64, NS, B, BIN = T.StringType(), T.LongType(), T.DecimalType(20, 0), T.LongType(), T.BooleanType(), T.BinaryType()


def _schema(*columns: tuple[str, T.DataType] | tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(c[0], c[1], len(c) > 2) for c in columns])


SOURCE = (("provider", S), ("feed", S), ("entitlement", S), ("numeric_encoding", S), ("source_record_id", S, True))
EVENT_V1 = _schema(
    ("schema_version", U32), *SOURCE, ("raw_frame_sha256", S, True), ("generation", U64), ("sequence", U64), ("source_timestamp", NS, True), ("received_timestamp", NS),
    ("event_kind", S), ("symbol", S), ("price", S, True), ("size", S, True), ("bid", S, True), ("ask", S, True), ("bid_size", S, True), ("ask_size", S, True),
)
V2_REFERENCE = (("raw_frame_generation", U64, True), ("raw_frame_sequence", U64, True), ("raw_frame_event_ordinal", U32, True), ("raw_frame_event_count", U32, True))
V3_REFERENCE = (*V2_REFERENCE, ("raw_frame_capture_instance_id", S, True), ("raw_frame_source_generation", U64, True))
EVENT_V2 = T.StructType([*EVENT_V1.fields, *_schema(*V2_REFERENCE).fields])
EVENT_V3 = T.StructType([*EVENT_V1.fields, *_schema(*V3_REFERENCE).fields])
TRADE_BAR = _schema(
    ("schema_version", U32), ("source_provider", S), ("source_feed", S), ("source_entitlement", S), ("source_numeric_encoding", S), ("symbol", S), ("bar_start_utc", NS),
    ("bar_end_exclusive_utc", NS), ("available_at_utc", NS), ("trade_date", S), ("session_id", S), ("session_timezone", S), ("session_policy_id", S), ("session_policy_sha256", S),
    ("session_start_utc", NS), ("session_end_exclusive_utc", NS), ("window_start_utc", NS), ("window_end_exclusive_utc", NS), ("open", S), ("high", S), ("low", S), ("close", S),
    ("volume", S), ("trade_count", U64), ("quote_events_excluded", U64), ("source_timestamp_missing_rows", U64), ("sequence_gap_count", U64), ("late_event_count", U64),
    ("window_expected_minutes", U32), ("window_empty_trade_minutes", U32), ("source_start_utc", NS), ("source_end_exclusive_utc", NS), ("window_input_eof", B),
    ("source_pages_exhausted", B, True), ("completion_mode", S), ("nbbo_input_status", S),
)
MARKET_BAR = _schema(
    ("schema_version", U32), ("symbol", S), ("asset_class", S), ("resolution", S), ("adjustment", S), ("bar_start_utc", NS), ("bar_end_exclusive_utc", NS), ("received_at_utc", NS),
    ("available_at_utc", NS), ("open", S), ("high", S), ("low", S), ("close", S), ("volume", S), ("provenance_id", S), ("session_instance_id", S), ("validation_state", S),
)
RAW_FRAME_V1 = _schema(
    ("schema_version", U32), ("provider", S), ("feed", S), ("entitlement", S), ("source_numeric_encoding", S, True), ("generation", U64), ("frame_sequence", U64),
    ("received_timestamp_utc", NS), ("frame_sha256", S), ("frame_bytes", BIN), ("event_count", U32), ("disposition", S), ("symbols_json", S),
)
RAW_FRAME_V2 = _schema(
    ("schema_version", U32), ("provider", S), ("feed", S), ("entitlement", S), ("source_numeric_encoding", S, True), ("capture_instance_id", S), ("source_generation", U64),
    ("source_frame_sequence", U64), ("canonical_generation", U64), ("received_timestamp_utc", NS), ("frame_sha256", S), ("frame_bytes", BIN), ("event_count", U32), ("disposition", S), ("symbols_json", S),
)
SCHEMAS = {"event_v1": EVENT_V1, "event_v2": EVENT_V2, "event_v3": EVENT_V3, "trade_bar": TRADE_BAR, "market_bar": MARKET_BAR, "raw_frame_v1": RAW_FRAME_V1, "raw_frame_v2": RAW_FRAME_V2}

EVENT_KINDS = ("stock_quote", "stock_trade", "option_quote", "option_trade")
ENTITLEMENTS = ("unknown", "authorized", "unauthorized")
ENCODINGS = ("decimal_token", "integer_token", "binary_float64_shortest_decimal", "binary_float32_shortest_decimal")
DISPOSITIONS = ("market_data", "control", "unknown_message", "malformed_message", "provider_error")


def descriptor(name: str) -> str:
    """A schema as canonical JSON."""
    return json.dumps({"id": name, "fields": [[f.name, f.dataType.simpleString(), f.nullable] for f in SCHEMAS[name].fields]}, separators=(",", ":"))


def fingerprint(name: str) -> str:
    return hashlib.sha256(descriptor(name).encode()).hexdigest()


def check_schema(df: DataFrame, name: str) -> None:
    """Names, order and types must be the schema's. Nullability of files says nothing: see null_counts."""
    want, got = [(f.name, f.dataType) for f in SCHEMAS[name].fields], [(f.name, f.dataType) for f in df.schema.fields]
    if want != got:
        raise errors.Contract(f"{name}: columns differ from the schema")


def required(name: str) -> list[str]:
    return [f.name for f in SCHEMAS[name].fields if not f.nullable]
