"""Chat formatting: exact round trip, sharing, positions and attention."""

import hashlib
import random

from tickloom.llm.chat import TRICKY, escape, format_chats, format_turn, pack_sorted, parse_turn, read_back, unescape, with_tricky

STRINGS = ["", "\\", "<|", "<|end|>", "\\<|", "<\\|", "<", "|end|>", "<|turn|>user<|text|>", TRICKY, "a\nb\n", "é\U0001f600", "x" * 70_000]


def test_escaping_is_reversible():
    rng = random.Random(1)
    for _ in range(500):
        role, text = ("".join(rng.choice(["\\", "<", "|", "end", "|>", "a", "\n"]) for _ in range(rng.randint(0, 12))) for _ in range(2))
        assert unescape(escape(text)) == text and "<|" not in escape(text)
        assert parse_turn(format_turn(role, text)) == (role, text)


def test_round_trip(spark):
    rng, rows = random.Random(2), []
    for c in range(120):
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, rng.choice(["user", "assistant", None, "system"]) if t else "user", rng.choice([*STRINGS, None]) if t else "shared first turn"))
    rows += [(None, 0, "user", "no id"), (500, None, "assistant", "late"), (500, 0, "user", "b"), (500, 0, "user", "a"), (500, 0, "user", "a")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in read_back(format_chats(with_tricky(frame), most=20_000)).collect()}
    want = {}
    rows += [(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)]
    for c, t, r, x in sorted(rows, key=lambda v: (v[0] is None, v[0] or 0, v[1] is not None, v[1] or 0, v[2] or "", v[3] or "")):
        want.setdefault(c, []).append((r or "", x or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        said = "".join(x for r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert got[c].formatted_chars == sum(len(format_turn(r, x)) for r, x in turns)


def test_shared_turns_are_emitted_once_with_positions_and_ancestors():
    chats = [(1, [("user", "q"), ("assistant", "a")]), (2, [("user", "q"), ("assistant", "a"), ("user", "r")]), (3, [("user", "q"), ("assistant", "b")]), (4, [("user", "z")])]
    (row,) = pack_sorted(iter(chats), 10_000)
    nodes = row["nodes"]
    assert len(nodes) == 5 and row["text"].count("q") == 1
    assert [n["parent"] for n in nodes] == [-1, 0, 1, 0, -1]
    assert nodes[3]["position"] == nodes[1]["position"] == nodes[0]["end"]
    # the second answer attends to the question and itself, not to the first answer
    assert nodes[3]["attends"] == [{"start": 0, "end": nodes[0]["end"]}, {"start": nodes[3]["start"], "end": nodes[3]["end"]}]
    assert nodes[4]["position"] == 0 and nodes[4]["attends"] == [{"start": nodes[4]["start"], "end": nodes[4]["end"]}]
    assert nodes[2]["attends"] == [{"start": 0, "end": nodes[2]["end"]}]


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert read_back(format_chats(empty)).collect() == []
