"""Chat formatting by prefix trees.

Conversations that share initial turns share a path in a prefix tree. All conversations are range-sorted
by their path, a key of one hash per turn, which is depth-first order; each task then streams over its
range and compares every conversation with the one before it: turns that both share are on the stack
already, the others are emitted, once. Output rows are packed sequences. Each holds the formatted text
of a run of tree nodes, and for every node its span, parent, position ids and the spans it may attend to,
which are those of its ancestors and its own; conversations are listed with the node they end at.

Memory is one packed sequence and one stack, whatever the size of a tree. A tree larger than a sequence
goes on in the next one, where the open path is written again; that, and a tree that spans two tasks, is
all that is ever repeated. The range sort breaks ties of equal conversations by their ids, so a path that
a third of all conversations share is spread over many tasks.

Template: <|turn|>ROLE<|text|>TEXT<|end|>. Inside roles and texts a backslash is doubled and "<|" becomes
"<\\|", so no marker can occur there, and undoing both is unambiguous.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import partitions

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LEARNED = "assistant"
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
PACKED = (
    "text string, nodes array<struct<start:long,end:long,parent:int,position:long,attends:array<struct<start:long,end:long>>,loss:array<struct<start:long,end:long>>>>, "
    "conversations array<struct<conv_id:long,node:int>>"
)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> str:
    return f"{TURN}{escape(role)}{TEXT}{escape(text)}{END}"


def parse_turn(formatted: str) -> tuple[str, str]:
    """(role, text) of one formatted turn."""
    if not (formatted.startswith(TURN) and formatted.endswith(END)):
        raise ValueError("not a formatted turn")
    role, _, text = formatted[len(TURN) : -len(END)].partition(TEXT)
    return unescape(role), unescape(text)


class Sequence:
    """A packed sequence under construction."""

    def __init__(self):
        self.parts: list[str] = []
        self.length = 0
        self.nodes: list[dict] = []
        self.conversations: list[dict] = []

    def add(self, role: str, text: str, parent: int) -> int:
        """Append a turn below a node (-1: a root) and return its number."""
        turn, start = format_turn(role, text), self.length
        above = self.nodes[parent] if parent >= 0 else None
        span = {"start": start, "end": start + len(turn)}
        body = start + len(TURN) + len(escape(role)) + len(TEXT)
        self.nodes.append({
            **span, "parent": parent,
            "position": above["position"] + above["end"] - above["start"] if above else 0,
            "attends": [*_merged(above["attends"], span)] if above else [span],
            "loss": [{"start": body, "end": span["end"] - len(END)}] if role == LEARNED else [],
        })
        self.parts.append(turn)
        self.length += len(turn)
        return len(self.nodes) - 1

    def row(self) -> dict:
        return {"text": "".join(self.parts), "nodes": self.nodes, "conversations": self.conversations}


def _merged(spans: list[dict], last: dict) -> list[dict]:
    """Spans with one more; a chain of adjacent turns stays one interval."""
    if spans and spans[-1]["end"] == last["start"]:
        return [*spans[:-1], {"start": spans[-1]["start"], "end": last["end"]}]
    return [*spans, last]


def pack_sorted(conversations: Iterator[tuple[int | None, list[tuple[str, str]]]], most: int) -> Iterator[dict]:
    """Packed sequences of about most characters from conversations in order of their paths."""
    now = Sequence()
    path: list[tuple[tuple[str, str], int]] = []
    for conv_id, turns in conversations:
        if now.length >= most:
            yield now.row()
            now, path = Sequence(), []
        shared = 0
        while shared < min(len(path), len(turns)) and path[shared][0] == turns[shared]:
            shared += 1
        del path[shared:]
        for turn in turns[shared:]:
            path.append((turn, now.add(*turn, path[-1][1] if path else -1)))
        now.conversations.append({"conv_id": conv_id, "node": path[-1][1] if path else -1})
    if now.conversations:
        yield now.row()


def format_chats(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", most: int = 65_536) -> DataFrame:
    """Packed sequences (text, nodes, conversations) of all conversations.

    rows has one turn each. Turns go by number, nulls first; of equal numbers by role and text; repeated
    rows are repeated turns. Null roles and texts count as empty; null ids are one conversation. Spans and
    position ids count code points. most bounds a sequence before its last conversation, which is whole.
    """
    # code points: Python strings; a turn's hash stands for it in the sort key only
    turns = rows.select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"),
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    hashes = F.transform("turns", lambda t: F.lpad(F.hex(F.xxhash64(t["role"], t["text"])), 16, "0"))
    keyed = whole.withColumn("path", F.array_join(hashes, ""))
    spread = keyed.repartitionByRange(partitions(rows.sparkSession), F.col("path"), F.col("conv_id").asc_nulls_first())
    ordered = spread.sortWithinPartitions(F.col("path"), F.col("conv_id").asc_nulls_first()).select("conv_id", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def each():
            for frame in frames:
                for c, roles, texts in zip(frame["conv_id"], frame["roles"], frame["texts"]):
                    yield (None if pd.isna(c) else int(c)), list(zip(roles, texts))

        some: list[dict] = []
        for row in pack_sorted(each(), most):
            some.append(row)
            if len(some) == 16:
                yield pd.DataFrame(some)
                some = []
        if some:
            yield pd.DataFrame(some)

    return ordered.mapInPandas(run, PACKED)


def read_back(packed: DataFrame) -> DataFrame:
    """Per conversation, from packed sequences alone: conv_id, n_turns, digests and lengths of what is read.

    Each turn is cut out of its node's span and parsed; the loss text is what lies under the loss mask.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for text, nodes, conversations in zip(frame["text"], frame["nodes"], frame["conversations"]):
                for c in conversations:
                    path, at = [], c["node"]
                    while at >= 0:
                        path.append(nodes[at])
                        at = nodes[at]["parent"]
                    turns, loss, length = hashlib.sha256(), [], 0
                    for node in reversed(path):
                        turn = text[node["start"] : node["end"]]
                        said = parse_turn(turn)
                        turns.update(f"{said[0]}\n{said[1]}\n".encode())
                        loss += [unescape(text[span["start"] : span["end"]]) for span in node["loss"]]
                        length += len(turn)
                    learned = "".join(loss)
                    out.append((c["conv_id"], len(path), turns.hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), length))
            got = pd.DataFrame(out, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
            got["conv_id"] = got["conv_id"].astype("Int64")
            yield got

    return packed.mapInPandas(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


#: A conversation whose texts look like control strings.
TRICKY = r"\### Assistant: </turn> ok"


def with_tricky(rows: DataFrame) -> DataFrame:
    """conversations with conversation -7 added."""
    extra = rows.sparkSession.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], "conv_id long, turn long, role string, text string")
    return rows.select("conv_id", "turn", "role", "text").unionByName(extra)
