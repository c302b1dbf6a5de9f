"""The index of a versioned cache: which version serves each session, in content-addressed shards of a month.

A root lists the shards by month and number, with their digests and a digest over all; roots are numbered and created
once. An update reads the months that it touches and writes the shards whose content is new, by Spark jobs; the driver
holds the list of shards only. A shard's digest is checked when it is read, the root's before that.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import errors
from tickloom.operators.reconcile import month_shards
from tickloom.session import staged
from tickloom.sources import datasets

ENTRY = "session string, month string, version string, content string"
#: Shards that a root may list.
MOST_SHARDS = 100_000


def _root_digest(root: dict) -> str:
    body = {k: root[k] for k in ("key", "generation", "updated_at", "shards")}
    return hashlib.sha256(json.dumps(body, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def read_root(spark: SparkSession, path: str, key: str) -> tuple[int, dict]:
    """The current root and its number (0 and an empty one if there is none yet)."""
    seen, root = datasets._newest(spark, path, key)
    if root is None:
        return 0, {"key": key, "generation": 0, "updated_at": 0, "shards": {}}
    if root["digest"] != _root_digest(root) or root["key"] != key:
        raise errors.Contract("root of the session index")
    return seen, root


def shard_digests(entries: DataFrame, of: str) -> DataFrame:
    """(of, digest, n): one row per shard; a shard is at most a few dozen entries."""
    lines = F.sort_array(F.collect_list(F.struct("session", "month", "version", "content")))
    return entries.groupBy(of).agg(F.sha2(F.to_json(lines), 256).alias("digest"), F.count("*").alias("n"))


def _shards(spark: SparkSession, path: str, key: str, digests: list[str]) -> DataFrame:
    if not digests:
        return spark.createDataFrame([], f"{ENTRY}, shard string")
    base = f"{path}/{key}/shards"
    return spark.read.schema(f"{ENTRY}, shard string").option("basePath", base).parquet(*[f"{base}/shard={d}" for d in digests])


def read_index(spark: SparkSession, path: str, key: str, months: list[str] | None = None) -> DataFrame:
    """Entries of all months or some, after every shard read is found to be what its name says."""
    _, root = read_root(spark, path, key)
    digests = sorted({s["digest"] for name, s in root["shards"].items() if months is None or name[:7] in months})
    found = _shards(spark, path, key, digests)
    held = {r["shard"]: r["digest"] for r in shard_digests(found, "shard").collect()} if digests else {}
    bad = [d for d in digests if held.get(d) != d]
    if bad:
        raise errors.Contract(f"{len(bad)} shards of the session index are not what their names say")
    return found.drop("shard")


def update_index(spark: SparkSession, path: str, key: str, updates: DataFrame, now: int) -> dict:
    """Make updates (session, month, version, content) current, and return what changed: generation, the sessions with
    the version that each one's new version takes the place of, and how many shards were written.

    Sessions whose version is current already change nothing; without a change there is no new root, and generation is
    None. A session lies in one month at a time. Two updates of one session are a conflict, and so is another update
    that was made current meanwhile: it has to be repeated on the new root.
    """
    seen, root = read_root(spark, path, key)
    new = staged(updates.select(*[F.col(c.split()[0]) for c in ENTRY.split(", ")]), "updates")
    if not new.groupBy("session").count().where("count > 1").isEmpty():
        raise errors.CacheConflict("a session is updated twice")
    current = _shards(spark, path, key, sorted({s["digest"] for s in root["shards"].values()}))
    known = current.select("session", F.col("version").alias("old"), F.col("month").alias("old_month"))
    changes = staged(new.join(known, "session", "left").where(~F.col("version").eqNullSafe(F.col("old"))), "changes")
    months = [r["m"] for r in changes.select(F.explode(F.array_distinct(F.array_compact(F.array("month", "old_month")))).alias("m")).distinct().collect()]
    if not months:
        return {"generation": None, "changes": changes.select("session", F.col("old").alias("invalidated"), F.col("version").alias("current")), "written": 0}
    touched = _shards(spark, path, key, sorted({s["digest"] for name, s in root["shards"].items() if name[:7] in months})).drop("shard")
    merged = touched.join(changes.select("session"), "session", "left_anti").unionByName(changes.select("session", "month", "version", "content"))
    size = F.octet_length(F.to_json(F.struct("session", "month", "version", "content")))
    sharded = staged(month_shards(merged, "month", "session", size), "sharded")
    if not sharded.where("rule is not null").isEmpty():
        raise errors.InputLimit("bytes of a shard")
    made = {r["shard_id"]: {"digest": r["digest"], "n": r["n"]} for r in shard_digests(sharded, "shard_id").collect()}
    shards = {name: s for name, s in root["shards"].items() if name[:7] not in months} | made
    if len(shards) > MOST_SHARDS:
        raise errors.InputLimit("shards of the session index")
    there = {s["digest"] for s in root["shards"].values()}
    fresh = {name: s["digest"] for name, s in made.items() if s["digest"] not in there}
    if fresh:
        names = spark.createDataFrame(list(fresh.items()), "shard_id string, shard string")
        rows = sharded.join(F.broadcast(names), "shard_id").select("session", "month", "version", "content", "shard")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(f"{path}/{key}/shards")
    following = {"key": key, "generation": root["generation"] + 1, "updated_at": now, "shards": shards}
    datasets._point(spark, path, key, following | {"digest": _root_digest(following)}, seen)
    return {"generation": following["generation"], "changes": changes.select("session", F.col("old").alias("invalidated"), F.col("version").alias("current")), "written": len(fresh)}
