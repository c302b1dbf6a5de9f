"""Parquet datasets: strict reads, create-only writes, manifests and verification."""

from __future__ import annotations

import json
import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import errors
from tickloom.functions.values import row_hash
from tickloom.operators.bars import bar_rules, grid_violations, market_bar_rules, require
from tickloom.sources.envelopes import event_rules
from tickloom.sources.schemas import DISPOSITIONS, ENTITLEMENTS, SCHEMAS, V2_REFERENCE, V3_REFERENCE, check_schema, fingerprint, required

NANOS_AS_LONG = "spark.sql.legacy.parquet.nanosAsLong"
#: Rows of a row group at most.
GROUP_ROWS = 10_000
WRITER = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1", "parquet.page.size": str(1 << 20), "parquet.block.row.count.limit": str(GROUP_ROWS)}


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


#: Rows of one object of provider bars.
MARKET_BAR_ROWS = 1000


def _digest_columns(rows: DataFrame) -> list[Column]:
    columns = [F.col(c) for c in rows.columns]
    sums = [row_hash(columns), row_hash(columns, 1)]
    return [F.count("*").alias("_rows"), *[F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("string").alias(f"_{i}") for i, h in enumerate(sums)]]


def content_digest(rows: DataFrame, name: str | None = None, rules: dict[str, Column] | None = None) -> dict:
    """Row count and an order-independent digest of all rows: sums of two 64-bit hashes, one pass, no sort.

    Spark's files differ from run to run, so datasets are compared by content, not by bytes. With a schema's
    name the same pass counts nulls, and fails if a required column has one; with rules it fails if a row breaks one.
    """
    needed = required(name) if name else []
    broken = [F.count_if(~F.coalesce(ok, F.lit(False))).alias(f"rule {n}") for n, ok in (rules or {}).items()]
    found = rows.agg(*_digest_columns(rows), *[F.count_if(F.col(c).isNull()).alias(c) for c in needed], *broken).first()
    bad = [c for c in needed if found[c]]
    if bad:
        raise errors.Contract(f"{name}: null in {', '.join(bad)}")
    for rule in sorted(rules or {}):
        if found[f"rule {rule}"]:
            raise errors.Contract(f"{found[f'rule {rule}']} rows break {rule}")
    return {"rows": found["_rows"], "digest": f"{found['_0']}/{found['_1']}"}


def rules_of(name: str) -> dict[str, Column]:
    """What every row of a schema's datasets fulfils, by name."""
    if name == "trade_bar":
        return bar_rules()
    if name == "market_bar":
        return market_bar_rules()
    if name.startswith("event"):
        reference = {"event_v2": V2_REFERENCE, "event_v3": V3_REFERENCE}.get(name, ())
        given = sum((F.col(c[0]).isNotNull().cast("int") for c in reference), F.lit(0))
        return event_rules() | ({"reference": given.isin(0, len(reference))} if reference else {})
    return {"frame_hash": F.col("frame_sha256").eqNullSafe(F.sha2("frame_bytes", 256)), "disposition": F.col("disposition").isin(*DISPOSITIONS), "entitlement": F.col("entitlement").isin(*ENTITLEMENTS)}


def check_whole(rows: DataFrame, name: str) -> None:
    """What a dataset fulfils as a whole: bars tile their window, frames are in order, provider bars are a page of one source."""
    if name == "trade_bar":
        require(grid_violations(rows))
    if name.startswith("raw_frame"):
        keys, order = (["provider", "feed"], ["generation", "frame_sequence"]) if name == "raw_frame_v1" else (["provider", "feed", "capture_instance_id"], ["source_generation", "source_frame_sequence"])
        if not rows.groupBy(*keys, *order).count().where("count > 1").isEmpty():
            raise errors.Contract("a frame twice")
    if name == "market_bar":
        found = rows.agg(F.count("*").alias("n"), F.count_distinct(F.struct("symbol", "asset_class", "resolution", "adjustment")).alias("identities")).first()
        if not 1 <= found["n"] <= MARKET_BAR_ROWS:
            raise errors.InputLimit(f"{found['n']} rows")
        if found["identities"] > 1:
            raise errors.MixedProvenance("bars of several requests")


def check_rules(rows: DataFrame, rules: dict[str, Column]) -> None:
    """Fails, naming the rule, if any row breaks one; one pass counts all."""
    found = rows.agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()]).first()
    for name in sorted(rules):
        if found[name]:
            raise errors.Contract(f"{found[name]} rows break {name}")


def _put(spark: SparkSession, path: str, text: str) -> None:
    """A small new file."""
    target, fs = _hadoop(spark, path)
    out = fs.create(target, False)
    out.write(bytearray(text.encode()))
    out.close()


def write(rows: DataFrame, path: str, name: str, codec: str = "zstd", source: dict | None = None) -> dict:
    """Write a dataset that must not exist yet, read it back whole, and return its manifest.

    One pass over what was written checks rules, nulls and content; where it fails, the files are deleted. The
    manifest, a JSON line beside them, comes last, so a dataset without one is unfinished. source (provider, feed, ..) of provider bars is kept in the manifest.
    """
    ordered = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[name].fields])
    if name == "market_bar":  # small by contract, so it is checked before anything is written
        check_whole(ordered, name)
    ordered.write.mode("errorifexists").options(**{**WRITER, "compression": codec}).parquet(path)
    back = rows.sparkSession.read.schema(SCHEMAS[name]).parquet(path)
    try:
        manifest = {"schema": name, "fingerprint": fingerprint(name), **content_digest(back, name, rules_of(name)), "published_at": int(time.time()), **({"source": source} if source else {})}
        if not manifest["rows"]:
            raise errors.Contract("empty dataset")
        check_whole(back, name)
    except errors.TickloomError:
        folder, fs = _hadoop(rows.sparkSession, path)
        fs.delete(folder, True)
        raise
    _put(rows.sparkSession, f"{path}.manifest", json.dumps(manifest))
    return manifest


def read(spark: SparkSession, path: str, name: str, foreign_nanos: bool = False) -> DataFrame:
    """A dataset by its closed schema; files whose columns differ fail."""
    reader = spark.read.option("mergeSchema", "false")
    before = spark.conf.get(NANOS_AS_LONG, None)
    if foreign_nanos:
        # Spark has this as a session's setting only; it is needed while the files' schema is read
        spark.conf.set(NANOS_AS_LONG, "true")
    try:
        found = reader.parquet(path)
    finally:
        if foreign_nanos:
            spark.conf.unset(NANOS_AS_LONG) if before is None else spark.conf.set(NANOS_AS_LONG, before)
    check_schema(found, name)
    return found


def read_checked(spark: SparkSession, path: str, name: str) -> DataFrame:
    """read, after every row and the whole are found to fulfil the schema's rules; one more pass."""
    found = read(spark, path, name)
    check_rules(found, rules_of(name))
    check_whole(found, name)
    return found


def row_groups(spark: SparkSession, path: str, most_files: int = 1024) -> list[dict]:
    """file, rows, uncompressed (bytes that the group declares) and columns (what its columns add up to) of each row
    group of a dataset, from the files' footers; nothing is decoded. More files than most_files fail."""
    folder, fs = _hadoop(spark, path)
    parts = sorted(s.getPath().toString() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".parquet"))
    if len(parts) > most_files:
        raise errors.InputLimit(f"{len(parts)} files")
    hadoop, out = spark._jvm.org.apache.parquet.hadoop, []
    for name in parts:
        reader = hadoop.ParquetFileReader.open(hadoop.util.HadoopInputFile.fromPath(spark._jvm.org.apache.hadoop.fs.Path(name), spark._jsc.hadoopConfiguration()))
        try:
            for block in reader.getFooter().getBlocks():
                out.append({"file": name, "rows": block.getRowCount(), "uncompressed": block.getTotalByteSize(), "columns": sum(c.getTotalUncompressedSize() for c in block.getColumns())})
        finally:
            reader.close()
    return out


def check_budget(spark: SparkSession, path: str, most_files: int = 1024, most_bytes: int = 512 << 20, most_groups: int = 1024, most_group_bytes: int = 32 << 20) -> None:
    """Fails before a dataset is decoded if it has more files, row groups or bytes than allowed.

    Bytes are what decoding will take, not what compressed files have: the sum of all row groups, and each by itself. A
    group that declares other bytes than its columns breaks the contract.
    """
    groups = row_groups(spark, path, most_files)
    total = sum(g["uncompressed"] for g in groups)
    if not 1 <= len(groups) <= most_groups or total > most_bytes:
        raise errors.InputLimit(f"{len(groups)} row groups of {total} bytes")
    for g in groups:
        if not 1 <= g["uncompressed"] <= most_group_bytes:
            raise errors.InputLimit(f"a row group of {g['uncompressed']} bytes")
        if g["columns"] != g["uncompressed"]:
            raise errors.Contract("bytes of a row group")


def manifest_of(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}.manifest").first()["value"])


def verify(spark: SparkSession, path: str, name: str) -> dict:
    """Manifest and files agree in schema, fingerprint, rows and content; fails otherwise."""
    manifest, rows = manifest_of(spark, path), read(spark, path, name)
    if (manifest["schema"], manifest["fingerprint"]) != (name, fingerprint(name)):
        raise errors.Contract("fingerprint")
    found = content_digest(rows, name)
    if {k: manifest[k] for k in found} != found:
        raise errors.Contract("content differs from the manifest")
    return manifest


def query_bars(spark: SparkSession, path: str, symbol: str | None = None, most: int = 100_000) -> DataFrame:
    """Bars of one symbol or all. The filter reaches the scan; the whole dataset is validated apart from it, rules and grid."""
    from tickloom.operators.paging import require_at_most

    bars = read_checked(spark, path, "trade_bar")
    return require_at_most(bars.where(F.col("symbol") == symbol) if symbol else bars, most).orderBy("symbol", "bar_start_utc")


def export_jsonl(rows: DataFrame, path: str) -> None:
    """JSON lines in a new folder; 64-bit unsigned numbers as texts."""
    wide = [F.col(f.name).cast("string").alias(f.name) if f.dataType.simpleString() == "decimal(20,0)" else F.col(f.name) for f in rows.schema.fields]
    rows.select(F.to_json(F.struct(*wide)).alias("value")).write.mode("errorifexists").text(path)


def publish_pair(frames: DataFrame, events: DataFrame, path: str, version: int) -> dict:
    """Write a chunk of raw frames and the events decoded from them, after every frame is found to have its events,
    and return the receipt, which is written last: without it the chunk is unfinished."""
    from tickloom.operators.pairs import V1_KEY, V2_KEY, frame_completeness

    spark = frames.sparkSession
    f = frames.withColumnsRenamed({"source_frame_sequence": "frame_sequence", "canonical_generation": "generation"}) if version == 2 else frames
    renamed = {f"raw_frame_{k}": k for k in ("capture_instance_id", "source_generation", "generation", "event_ordinal")} | {"raw_frame_sequence": "frame_sequence"}
    e = events.drop("generation", "sequence").withColumnsRenamed(renamed)
    bad = frame_completeness(f, e, V1_KEY if version == 1 else V2_KEY, "event_ordinal", "event_count").where("not complete and declared > 0 or n_frames = 0")
    if not bad.isEmpty():
        raise errors.Contract("frames and events do not belong together")
    made = {"frames": write(frames, f"{path}/frames", f"raw_frame_v{version}"), "events": write(events, f"{path}/events", f"event_v{version + 1}")}
    receipt = {"version": version, **{k: {n: m[n] for n in ("rows", "digest", "fingerprint")} for k, m in made.items()}}
    _put(spark, f"{path}/receipt", json.dumps(receipt))
    return receipt


# --- versions of a dataset --------------------------------------------------------------------------


def publish_version(rows: DataFrame, root: str, key: str, version: str, expires: int, authoritative: bool) -> None:
    """Write an immutable version and make it current by creating the next pointer.

    A version that is not authoritative does not replace one that is.
    """
    spark = rows.sparkSession
    rows.write.mode("errorifexists").options(**WRITER).parquet(f"{root}/{key}/versions/{version}")
    seen, now = _newest(spark, root, key)
    if now and now["authoritative"] and not authoritative:
        return
    _put(spark, f"{root}/{key}/versions/{version}.authority", json.dumps(authoritative))
    _point(spark, root, key, {"version": version, "expires": expires, "authoritative": authoritative}, seen)


def _point(spark: SparkSession, root: str, key: str, pointer: dict, seen: int) -> None:
    """Make pointer number seen + 1 current. Pointers are never overwritten, and a number is created once: of two
    publishers that saw the same pointer one fails, and has to look again."""
    try:
        _put(spark, f"{root}/{key}/pointer-{seen + 1:012d}.json", json.dumps(pointer))
    except Py4JJavaError as e:
        raise errors.CacheConflict("another version was published meanwhile") from e


def _newest(spark: SparkSession, root: str, key: str) -> tuple[int, dict | None]:
    """The number of the current pointer (0: none) and what it says."""
    folder, fs = _hadoop(spark, f"{root}/{key}")
    if not fs.exists(folder):
        return 0, None
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().startswith("pointer-"))
    if not names:
        return 0, None
    return int(names[-1][len("pointer-") : -len(".json")]), json.loads(spark.read.text(f"{root}/{key}/{names[-1]}").first()["value"])


def current_pointer(spark: SparkSession, root: str, key: str) -> dict | None:
    return _newest(spark, root, key)[1]


def load_current(spark: SparkSession, root: str, key: str, now: int) -> DataFrame | None:
    """The current version, unless it has expired."""
    pointer = current_pointer(spark, root, key)
    return spark.read.parquet(f"{root}/{key}/versions/{pointer['version']}") if pointer and now < pointer["expires"] else None


def list_versions(spark: SparkSession, root: str, key: str) -> list[str]:
    folder, fs = _hadoop(spark, f"{root}/{key}/versions")
    return sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()) if fs.exists(folder) else []


def rollback(spark: SparkSession, root: str, key: str, version: str, expires: int) -> None:
    """Make an earlier version current again, with the authority that it was published with."""
    if version not in list_versions(spark, root, key):
        raise errors.Contract(f"no version {version}")
    authority, fs = _hadoop(spark, f"{root}/{key}/versions/{version}.authority")
    authoritative = fs.exists(authority) and json.loads(spark.read.text(authority.toString()).first()["value"])
    _point(spark, root, key, {"version": version, "expires": expires, "authoritative": authoritative}, _newest(spark, root, key)[0])
