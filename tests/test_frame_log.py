"""The framed log: batch and stream read the same frames, torn tails are left out, damage is refused."""

import hashlib
from pathlib import Path

import pytest

from tickloom import errors
from tickloom.sources import frame_log as L
from tickloom.streaming.ingest import run_to_end


def frame(n, generation=1, payload=None):
    return L.encoded(generation, n, "alpaca", "sip", 10**18 + n, payload or f"payload {n}".encode(), n % 4, L.OUTCOMES[n % 3])


def log(folder, name, frames, tail=b""):
    Path(folder).mkdir(exist_ok=True)
    (Path(folder) / name).write_bytes(L.MAGIC + b"".join(frames) + tail)
    return str(folder)


def test_frames_of_several_files_and_a_torn_tail(spark, tmp_path):
    spark.dataSource.register(L.FrameLog)
    folder = log(tmp_path / "log", "a.frames", [frame(n) for n in range(1, 41)] + [frame(1, 3), frame(2, 3)], frame(3, 3)[:-5])
    log(tmp_path / "log", "b.frames", [frame(1, 1, b"\x00\xff" * 5000)], L.record(b"\x01" + b"0" * 80))
    log(tmp_path / "log", "c.frames", [])
    (Path(folder) / "d.frames").write_bytes(L.MAGIC[:3])
    (Path(folder) / "other.txt").write_bytes(b"no log")
    df = spark.read.format("frame_log").option("split", 700).load(folder)
    rows = sorted(df.collect(), key=lambda r: (r.file, r.at))
    assert [(r.generation, r.sequence) for r in rows] == [(1, n) for n in range(1, 41)] + [(3, 1), (3, 2), (1, 1)]
    assert all(r.frame_sha256 == hashlib.sha256(r.payload).hexdigest() and r.provider == "alpaca" and r.feed == "sip" for r in rows)
    assert [(r.received_ns, r.event_count, r.outcome) for r in rows[:3]] == [(10**18 + n, n % 4, L.OUTCOMES[n % 3]) for n in (1, 2, 3)]
    assert df.rdd.getNumPartitions() > 8
    assert spark.read.format("frame_log").load(f"file://{folder}").count() == len(rows)


def test_a_stream_goes_on_where_a_torn_tail_began(spark, tmp_path):
    spark.dataSource.register(L.FrameLog)
    folder, parts = tmp_path / "log", [frame(n) for n in range(1, 13)]
    stream = lambda: spark.readStream.format("frame_log").option("split", 900).load(str(folder)).drop("file")
    run = lambda: run_to_end(stream(), f"file://{tmp_path}/out", f"file://{tmp_path}/check")
    log(folder, "a.frames", parts[:4], parts[4][:20])
    run()
    assert sorted(r.sequence for r in spark.read.parquet(f"file://{tmp_path}/out").collect()) == [1, 2, 3, 4]
    log(folder, "a.frames", parts[:9], parts[9][: len(parts[9]) // 2])
    log(folder, "b.frames", [frame(1, 7)])
    run()
    log(folder, "a.frames", parts)
    run()
    run()
    got = sorted((r.generation, r.sequence, bytes(r.payload)) for r in spark.read.parquet(f"file://{tmp_path}/out").collect())
    batch = spark.read.format("frame_log").load(str(folder)).collect()
    assert got == sorted((r.generation, r.sequence, bytes(r.payload)) for r in batch) and len(got) == 13


@pytest.mark.parametrize("damage", ["check", "payload", "number", "outcome", "magic", "length", "first"])
def test_damage_is_refused(tmp_path, damage):
    frames = [frame(n) for n in range(1, 4)]
    raw = bytearray(L.MAGIC + b"".join(frames))
    if damage == "check":
        raw[len(L.MAGIC) + 60] ^= 1
    elif damage == "payload":
        bad = frame(2)
        body = bytearray(bad[4 : 4 + int.from_bytes(bad[:4], "big") - 32])
        body[-1] ^= 1
        raw = bytearray(L.MAGIC + frames[0] + L.record(bytes(body)) + bad[len(L.record(bytes(body))) :])
    elif damage == "number":
        raw = bytearray(L.MAGIC + frames[0] + frames[2])
    elif damage == "outcome":
        raw = bytearray(L.MAGIC + frames[0] + frames[1][: len(frames[1]) // 2])
        first = 4 + int.from_bytes(frames[1][:4], "big")
        raw = bytearray(L.MAGIC + frames[0] + frames[1][:first] + frames[2][4 + int.from_bytes(frames[2][:4], "big") :])
    elif damage == "magic":
        raw[0] ^= 1
    elif damage == "length":
        raw[len(L.MAGIC) : len(L.MAGIC) + 4] = b"\xff\xff\xff\xff"
    else:
        raw = bytearray(L.MAGIC + frames[1])
    path = str(tmp_path / "x.frames")
    Path(path).write_bytes(bytes(raw))
    with pytest.raises((errors.Contract, errors.InputLimit)):
        for a, b in L.ranges(path, 0, len(raw)):
            list(L.frames_of(path, a, b))
