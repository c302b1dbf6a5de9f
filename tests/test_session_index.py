"""The session index: shards by content, roots by number, updates that touch little."""

import os

import pytest
from pyspark.sql import functions as F

from tickloom import errors
from tickloom.sources import session_index as X


def entries(spark, n=200, version="v1", month=None):
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 60).cast("int")), "yyyy-MM-dd")
    rows = spark.range(n).select(F.concat(F.lit("S:"), day, F.lit(":"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("session"), (F.lit(month) if month else day.substr(1, 7)).alias("month"))
    return rows.select("session", "month", F.lit(version).alias("version"), F.sha2(F.concat("session", F.lit(version)), 256).alias("content"))


def held(df):
    return {r.session: (r.month, r.version) for r in df.collect()}


def shard_files(path):
    return {d for d in os.listdir(f"{path}/k/shards") if d.startswith("shard=")}


def test_an_update_of_one_session_writes_one_shard(spark, tmp_path):
    root, all_of = f"file://{tmp_path}", entries(spark)
    assert X.read_index(spark, root, "k").count() == 0
    first = X.update_index(spark, root, "k", all_of, 10)
    assert first["generation"] == 1 and first["written"] == len(shard_files(tmp_path)) == 4
    assert all(r.invalidated is None for r in first["changes"].collect()) and first["changes"].count() == 200
    assert held(X.read_index(spark, root, "k")) == held(all_of)
    before = shard_files(tmp_path)
    one = entries(spark, version="v2").where("session like 'S:2024-02-03%'").limit(1)
    second = X.update_index(spark, root, "k", one, 11)
    assert (second["generation"], second["written"]) == (2, 1) and len(shard_files(tmp_path) - before) == 1
    assert [(r.invalidated, r.current) for r in second["changes"].collect()] == [("v1", "v2")]
    want = held(all_of) | held(one)
    assert held(X.read_index(spark, root, "k")) == want
    assert held(X.read_index(spark, root, "k", ["2024-02"])) == {s: e for s, e in want.items() if e[0] == "2024-02"}
    same = X.update_index(spark, root, "k", one, 12)
    assert same["generation"] is None and X.read_root(spark, root, "k")[1]["generation"] == 2
    moved = X.update_index(spark, root, "k", entries(spark, version="v3", month="2024-05").limit(1), 13)
    assert moved["generation"] == 3
    now = held(X.read_index(spark, root, "k"))
    assert len(now) == 200 and sum(e == ("2024-05", "v3") for e in now.values()) == 1


def test_what_was_changed_is_found_out(spark, tmp_path):
    root = f"file://{tmp_path}"
    X.update_index(spark, root, "k", entries(spark, 20), 10)
    twice = entries(spark, 3).union(entries(spark, 1, "v9"))
    with pytest.raises(errors.CacheConflict):
        X.update_index(spark, root, "k", twice, 11)
    seen, state = X.read_root(spark, root, "k")
    shard = next(iter(state["shards"].values()))["digest"]
    spark.createDataFrame([("S:x", "2024-01", "v1", "c")], X.ENTRY).write.mode("append").parquet(f"{root}/k/shards/shard={shard}")
    with pytest.raises(errors.Contract):
        X.read_index(spark, root, "k")
    name = next(f for f in os.listdir(f"{tmp_path}/k") if f.startswith("pointer-"))
    text = (tmp_path / "k" / name).read_text()
    (tmp_path / "k" / f".{name}.crc").unlink(missing_ok=True)
    (tmp_path / "k" / name).write_text(text.replace('"updated_at": 10', '"updated_at": 99'))
    with pytest.raises(errors.Contract):
        X.read_root(spark, root, "k")
