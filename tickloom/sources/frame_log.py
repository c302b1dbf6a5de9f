"""A framed log of raw frames as a Spark source, for batch and stream.

A file begins with MAGIC. A record is its length (4 bytes, big-endian, of what follows), a body and the SHA-256 of
DOMAIN, length and body. A frame is two records: the bytes as they came, and how they were decoded; a frame whose
second record is missing, or a record that the file's end cuts off, is not there yet.

`spark.dataSource.register(FrameLog)`, then `spark.read.format("frame_log").load(folder)` or `readStream`. A partition is
a range of one file that ends between frames, so a long file is many tasks; to find the ranges only the lengths of
records are read ahead. Any file system that Arrow opens will do (`file://`, `hdfs://`, `s3://`, a plain path).
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tickloom import errors

MAGIC, DOMAIN = b"TLFRAME1", b"tickloom.frame-log.v1\0"
FRAME, OUTCOME = 1, 2
CHECK, HEAD = 32, 4
#: Longest payload and text, and bytes of a partition.
MOST_PAYLOAD, MOST_TEXT, SPLIT = 16 << 20, 1024, 64 << 20
MOST_RECORD = MOST_PAYLOAD + 8 * MOST_TEXT + 4096
OUTCOMES = ("decoded", "ignored", "refused")
SCHEMA = "file string, at long, generation long, sequence long, provider string, feed string, received_ns long, payload binary, frame_sha256 string, event_count int, outcome string"


def _text(value: str) -> bytes:
    raw = value.encode()
    if len(raw) > MOST_TEXT:
        raise errors.InputLimit("text of a frame")
    return struct.pack(">H", len(raw)) + raw


def record(body: bytes) -> bytes:
    head = struct.pack(">I", len(body) + CHECK)
    return head + body + hashlib.sha256(DOMAIN + head + body).digest()


def encoded(generation: int, sequence: int, provider: str, feed: str, received_ns: int, payload: bytes, event_count: int, outcome: str) -> bytes:
    """Both records of a frame."""
    if not 0 < len(payload) <= MOST_PAYLOAD:
        raise errors.InputLimit("payload of a frame")
    key = struct.pack(">QQ", generation, sequence) + hashlib.sha256(payload).digest()
    came = bytes([FRAME]) + key + _text(provider) + _text(feed) + struct.pack(">qI", received_ns, len(payload)) + payload
    return record(came) + record(bytes([OUTCOME]) + key + struct.pack(">IB", event_count, OUTCOMES.index(outcome)))


def _open(path: str):
    system, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return system.open_input_file(inner)


def _files(folder: str) -> dict[str, int]:
    """The logs of a folder and their sizes."""
    system, inner = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
    prefix = folder[: len(folder) - len(inner.rstrip("/"))] if "://" in folder else ""
    found = system.get_file_info(fs.FileSelector(inner, allow_not_found=True))
    return {prefix + i.path: i.size for i in found if i.is_file and i.path.endswith(".frames")}


def _length(file, at: int, size: int) -> int | None:
    """Bytes of the record at a place, head included; None if the file ends before it does."""
    if at + HEAD > size:
        return None
    n = struct.unpack(">I", file.read_at(HEAD, at))[0]
    if not CHECK + 2 <= n <= MOST_RECORD:
        raise errors.InputLimit("length of a record")
    return n + HEAD if at + HEAD + n <= size else None


def ranges(path: str, start: int, size: int, split: int = SPLIT) -> list[tuple[int, int]]:
    """Ranges of whole frames of a file from start on, each of about split bytes; what is cut off is in none."""
    with _open(path) as file:
        if start == 0:
            if size < len(MAGIC):
                return []
            if file.read_at(len(MAGIC), 0) != MAGIC:
                raise errors.Contract("not a frame log")
            start = len(MAGIC)
        out, at = [], start
        while (one := _length(file, at, size)) and (two := _length(file, at + one, size)):
            at += one + two
            if at - start >= split:
                out.append((start, at))
                start = at
        return [*out, (start, at)] if at > start else out


def _body(file, at: int, end: int) -> tuple[bytes, int]:
    n = _length(file, at, end)
    if n is None:
        raise errors.Contract("range of a frame log")
    raw = file.read_at(n, at)
    if hashlib.sha256(DOMAIN + raw[:-CHECK]).digest() != raw[-CHECK:]:
        raise errors.Contract(f"check sum of a record at {at}")
    return raw[HEAD:-CHECK], at + n


def frames_of(path: str, start: int, end: int) -> Iterator[tuple]:
    """The frames of a range, one at a time. Numbers go up by one in a generation and begin at 1 in a later one."""
    last = None
    with _open(path) as file:
        at = start
        while at < end:
            began = at
            body, at = _body(file, at, end)
            if body[0] != FRAME:
                raise errors.Contract(f"kind of the record at {began}")
            generation, sequence = struct.unpack_from(">QQ", body, 1)
            sha, place, texts = body[17:49], 49, []
            for _ in range(2):
                n = struct.unpack_from(">H", body, place)[0]
                texts.append(body[place + 2 : place + 2 + n].decode())
                place += 2 + n
            received, n = struct.unpack_from(">qI", body, place)
            payload = body[place + 12 :]
            if len(payload) != n or hashlib.sha256(payload).digest() != sha:
                raise errors.Contract(f"payload of the frame at {began}")
            outcome, at = _body(file, at, end)
            if outcome[0] != OUTCOME or outcome[1:49] != body[1:49]:
                raise errors.Contract(f"outcome of the frame at {began}")
            count, how = struct.unpack_from(">IB", outcome, 49)
            first = last is None and (start > len(MAGIC) or sequence == 1)
            follows = last is not None and ((generation == last[0] and sequence == last[1] + 1) or (generation > last[0] and sequence == 1))
            if not (first or follows):
                raise errors.Contract(f"number of the frame at {began}")
            last = (generation, sequence)
            yield path, began, generation, sequence, *texts, received, payload, sha.hex(), count, OUTCOMES[how]


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int


class _Batch(DataSourceReader):
    def __init__(self, folder: str, split: int):
        self.folder, self.split = folder, split

    def partitions(self) -> list[Range]:
        return [Range(path, a, b) for path, size in sorted(_files(self.folder).items()) for a, b in ranges(path, 0, size, self.split)]

    def read(self, partition: Range) -> Iterator[tuple]:
        return frames_of(partition.path, partition.start, partition.end)


class _Stream(DataSourceStreamReader):
    """Offsets are the ends of whole frames, file by file: a batch goes on where the last one stopped."""

    def __init__(self, folder: str, split: int):
        self.folder, self.split, self.reached = folder, split, {}

    def initialOffset(self) -> dict:
        return {"ends": "{}"}

    def latestOffset(self) -> dict:
        for path, size in _files(self.folder).items():
            new = ranges(path, self.reached.get(path, 0), size, self.split)
            if new:
                self.reached[path] = new[-1][1]
        return {"ends": json.dumps(self.reached, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        before, after = json.loads(start["ends"]), json.loads(end["ends"])
        # after a restart, look on from where the stream stopped
        self.reached = {p: max(self.reached.get(p, 0), b) for p, b in after.items()}
        return [Range(path, a, b) for path, stop in sorted(after.items()) if stop > before.get(path, 0) for a, b in ranges(path, before.get(path, 0), stop, self.split)]

    def read(self, partition: Range) -> Iterator[tuple]:
        return frames_of(partition.path, partition.start, partition.end)

    def commit(self, end: dict) -> None:
        pass


class FrameLog(DataSource):
    """Format frame_log: the frames of all *.frames files of a folder. Option split: bytes of a partition."""

    @classmethod
    def name(cls) -> str:
        return "frame_log"

    def schema(self) -> str:
        return SCHEMA

    def _how(self) -> tuple[str, int]:
        if "path" not in self.options:
            raise errors.Contract("path of a frame log")
        return self.options["path"], int(self.options.get("split", SPLIT))

    def reader(self, schema) -> _Batch:
        return _Batch(*self._how())

    def streamReader(self, schema) -> _Stream:
        return _Stream(*self._how())
