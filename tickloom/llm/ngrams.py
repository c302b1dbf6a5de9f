"""A trigram model in Elias-Fano tries, and the scoring of texts with it (after Pibiri and Venturini, 2019).

Model: interpolated absolute discounting over training tokens,
    p(w | u v) = a3 + b3 * (a2 + b2 * p1(w)),   p1(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)),
where a is a discounted relative frequency and b the mass that discounting leaves. Its parts are stored
quantised, on a logarithmic scale of 16 bits.

Data flow. Texts are read once into blocks of some million tokens, each with a dictionary of its own. A
block sends its distinct words with counts to word shards, which answer with totals and numbers; then its
distinct trigrams with counts to trie shards, which build their trie and answer the same trigrams with two
quantised numbers each. So both exchanges carry a distinct item once per block, however often it occurs.

A trie shard holds whole hinges: a hinge is the middle word v of a trigram, with the class of u if v is
frequent (one class per 1/HOT of all tokens; its second level then is conditioned on that class), so that
no shard has to hold all that follows a frequent word. Below a hinge are its successors w, and its
contexts u with their successors, kept as ranks among the hinge's. Every level is one monotone sequence,
Elias-Fano coded in one memory map per shard; pointers are monotone sequences too. Queries come in sorted
batches and are answered on the coded levels, none of which is decoded: pointers give the range in which a
context's successors lie, the high bits (by a directory of their ones) the bucket of the wanted word in it, and
the low bits of the few positions that are probed tell its place.
"""

from __future__ import annotations

import math
import mmap
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import partitions, remainder, stage, unstage
from tickloom.llm.features import word_hashes
from tickloom.llm.tokens import in_slices, words_of

DISCOUNT, PRIOR = 0.75, 0.1
BLOCK_TOKENS, SHARD_TOKENS = 1_500_000, 1_000_000
#: Entries (a block's distinct words) of a word shard.
SHARD_WORDS = 1_000_000
HOT = 1024
#: Stands for the end of a text among words; no word holds a space.
END = " "
#: Steps of the logarithmic scale per factor of two; code ZERO is probability 0.
STEP, ZERO = 1024, 65535


# --- bytes ---------------------------------------------------------------------------------------------


def packed(values: np.ndarray) -> bytes:
    """Whole numbers >= 0 as bytes: narrow, transposed, compressed."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    top = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))
    raw = np.ascontiguousarray(values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes()
    return width.to_bytes(1, "little") + len(values).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    width, n = data[0], int.from_bytes(data[1:9], "little")
    raw = pa.decompress(data[9:], decompressed_size=width * n, codec="zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(width, n).T).view(f"<u{width}").ravel().astype(np.int64)


def packed_steps(values: np.ndarray) -> bytes:
    """Values that mostly grow: their differences, alternately signed."""
    d = np.diff(values, prepend=0)
    return packed((d << 1) ^ (d >> 63))


def unpacked_steps(data: bytes) -> np.ndarray:
    z = unpacked(data)
    return np.cumsum((z >> 1) ^ -(z & 1))


def mixed(values: np.ndarray) -> np.ndarray:
    """A hash of whole numbers."""
    x = values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    return ((x * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(20)).astype(np.int64)


def quantised(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.where(p > 0, np.clip(np.rint(-np.log2(np.maximum(p, 1e-300)) * STEP), 0, ZERO - 1), ZERO).astype(np.uint16)


def probability(code: np.ndarray) -> np.ndarray:
    return np.where(code == ZERO, 0.0, np.exp2(code.astype(np.float64) / -STEP))


# --- the trie ------------------------------------------------------------------------------------------


def _merged(words: np.ndarray, bits: np.ndarray, size: int) -> np.ndarray:
    """size 64-bit words, with bits set in the words numbered (in ascending order)."""
    out = np.zeros(size, dtype=np.uint64)
    if len(words):
        firsts = _starts(words)
        out[words[firsts]] = np.bitwise_or.reduceat(bits, firsts)
    return out


def _nth_one(word: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The place of the n-th (from 0) one in each 64-bit word."""
    place = np.zeros(len(word), dtype=np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        below = np.bitwise_count(word & np.uint64((1 << width) - 1)).astype(np.int64)
        beyond = n >= below
        n = n - below * beyond
        word = np.where(beyond, word >> np.uint64(width), word)
        place += width * beyond
    return place


class EliasFano:
    """A monotone sequence: low bits side by side, high bits in unary with a directory of the ones before each word."""

    def __init__(self, values: np.ndarray):
        self.n = n = len(values)
        self.low_bits = low = max(0, int(math.log2((int(values[-1]) + 1) / n))) if n else 0
        at = np.arange(n) * low
        rest = (values & ((1 << low) - 1)).astype(np.uint64)
        shift = (at & 63).astype(np.uint64)
        size = (n * low >> 6) + 2
        # a value's bits begin in one word and may end in the next
        self.low = _merged(at >> 6, rest << shift, size) | _merged((at >> 6) + 1, (rest >> np.uint64(1)) >> (np.uint64(63) - shift), size)
        place = (values >> low) + np.arange(n)
        self.top = int(values[-1] >> low) if n else -1
        self.high = _merged(place >> 6, np.uint64(1) << (place & 63).astype(np.uint64), (self.top + n + 1 >> 6) + 1)
        self.ones = np.concatenate([[0], np.cumsum(np.bitwise_count(self.high).astype(np.int64))[:-1]]).astype(np.int64)

    def _low(self, at: np.ndarray) -> np.ndarray:
        bit = at * self.low_bits
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        found = (self.low[word] >> shift) | ((self.low[word + 1] << np.uint64(1)) << (np.uint64(63) - shift))
        return (found & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def _zero(self, n: np.ndarray) -> np.ndarray:
        """The place of the n-th (from 0) zero among the high bits."""
        before = np.arange(len(self.ones)) * 64 - self.ones
        word = np.searchsorted(before, n, side="right") - 1
        return word * 64 + _nth_one(~self.high[word], n - before[word])

    def access(self, at: np.ndarray) -> np.ndarray:
        """The values at some positions."""
        word = np.searchsorted(self.ones, at, side="right") - 1
        high = word * 64 + _nth_one(self.high[word], at - self.ones[word]) - at
        return (high << self.low_bits) | self._low(at)

    def values(self) -> np.ndarray:
        return self.access(np.arange(self.n))

    def successor(self, wanted: np.ndarray, begin: np.ndarray | int, end: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        """In [begin, end) the position of the first value not below each wanted one (end: none), and whether it is equal."""
        begin, end = np.broadcast_to(begin, wanted.shape), np.broadcast_to(end, wanted.shape)
        if not self.n or not len(wanted):
            return begin.astype(np.int64), np.zeros(len(wanted), dtype=bool)
        bucket, rest = wanted >> self.low_bits, wanted & ((1 << self.low_bits) - 1)
        inside = np.minimum(bucket, self.top)
        # ones before a bucket's closing zero are the values up to it; a run of wanted values in one bucket asks once
        runs = _starts(inside)
        asked = inside[runs]
        often = np.diff(np.append(runs, len(inside)))
        last = np.repeat(self._zero(asked) - asked, often)
        first = np.repeat(np.where(asked > 0, self._zero(np.maximum(asked - 1, 0)) - (asked - 1), 0), often)
        first = np.where(bucket > self.top, self.n, first)
        at = np.clip(first, begin, end)
        limit = np.maximum(at, np.clip(last, begin, end))
        # only what is still open goes on to the next step of the search
        open_ = np.flatnonzero(at < limit)
        low, high, sought = at[open_], limit[open_], rest[open_]
        while len(open_):
            middle = (low + high) >> 1
            less = self._low(middle) < sought
            low, high = np.where(less, middle + 1, low), np.where(less, high, middle)
            done = low == high
            at[open_[done]] = low[done]
            go = ~done
            open_, low, high, sought = open_[go], low[go], high[go], sought[go]
        equal = at < limit
        equal[equal] = self._low(at[equal]) == rest[equal]
        return at, equal


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    n = len(keys[0])
    new = np.ones(n, dtype=bool)
    if n:
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


class Trie:
    """Four levels for trigrams sorted by (hinge, u, w), each with a count above 0, in one memory map."""

    def __init__(self, hinge: np.ndarray, u: np.ndarray, w: np.ndarray, count: np.ndarray):
        count = count.astype(np.float64)
        tops = _starts(hinge)
        at_hinge = np.repeat(np.arange(len(tops)), np.diff(np.append(tops, len(hinge))))
        self.words = int(max(u.max(initial=0), w.max(initial=0))) + 1
        # second level: distinct successors of each hinge
        below = np.lexsort((w, at_hinge))
        hs, ws = at_hinge[below], w[below]
        firsts = _starts(hs, ws)
        pair_count = np.add.reduceat(count[below], firsts) if len(firsts) else np.zeros(0)
        pair_hinge, pair_word = hs[firsts], ws[firsts]
        hinge_total = np.bincount(pair_hinge, pair_count, minlength=len(tops))
        hinge_kinds = np.bincount(pair_hinge, minlength=len(tops))
        # third and fourth: contexts, and their successors
        contexts = _starts(hinge, u)
        at_context = np.repeat(np.arange(len(contexts)), np.diff(np.append(contexts, len(hinge))))
        context_total = np.bincount(at_context, count, minlength=len(contexts))
        context_kinds = np.bincount(at_context, minlength=len(contexts))
        pointer = np.concatenate([[0], np.cumsum(hinge_kinds)])
        pair_key = pair_hinge * self.words + pair_word
        rank = np.searchsorted(pair_key, at_hinge * self.words + w) - pointer[at_hinge]
        self.ranks = int(hinge_kinds.max(initial=0)) + 1
        self.hinges, self.pairs = EliasFano(hinge[tops]), EliasFano(pair_key)
        self.contexts = EliasFano(at_hinge[contexts] * self.words + u[contexts])
        self.triples = EliasFano(at_context * self.ranks + rank)
        ends = lambda of, n: EliasFano(np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))]).astype(np.int64))
        self.pair_ends, self.context_ends, self.triple_ends = EliasFano(pointer), ends(at_hinge[contexts], len(tops)), ends(at_context, len(contexts))
        self.codes = {
            "pair": quantised((pair_count - DISCOUNT) / hinge_total[pair_hinge]), "hinge": quantised(DISCOUNT * hinge_kinds / np.maximum(hinge_total, 1)),
            "triple": quantised((count - DISCOUNT) / context_total[at_context]), "context": quantised(DISCOUNT * context_kinds / np.maximum(context_total, 1)),
        }
        self._map()

    def _map(self) -> None:
        """Move all bits and codes into one memory map, which the system may page; nothing is left in a folder."""
        levels = (self.hinges, self.pairs, self.contexts, self.triples, self.pair_ends, self.context_ends, self.triple_ends)
        arrays = [(x, name, getattr(x, name)) for x in levels for name in ("low", "high", "ones")]
        places = np.cumsum([0] + [a.nbytes for *_, a in arrays] + [c.nbytes for c in self.codes.values()])
        self.memory = mmap.mmap(-1, max(int(places[-1]), 1))

        def moved(a: np.ndarray, at: int) -> np.ndarray:
            view = np.frombuffer(self.memory, dtype=a.dtype, count=len(a), offset=at)
            view[:] = a
            return view

        for (x, name, a), at in zip(arrays, places.tolist()):
            setattr(x, name, moved(a, at))
        self.codes = {name: moved(c, at) for (name, c), at in zip(self.codes.items(), places[len(arrays) :].tolist())}

    def _of(self, name: str, at: np.ndarray, found: np.ndarray, otherwise: float) -> np.ndarray:
        out = np.full(len(at), otherwise)
        if found.any():
            out[found] = probability(self.codes[name][at[found]])
        return out

    def query(self, hinge: np.ndarray, u: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of trigrams sorted by (hinge, u, w), the share known above the words themselves, and the mass left to those."""
        runs = lambda starts: np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(hinge))))
        tops, contexts = _starts(hinge), _starts(hinge, u)
        top, of = runs(tops), runs(contexts)
        # each hinge once, then each of its contexts once, then every successor
        h, known = self.hinges.successor(hinge[tops], 0, self.hinges.n)
        h = np.where(known, h, 0)
        far = np.where(known, h + 1, h)
        reach = lambda ends, a, b: (ends.access(a), ends.access(b))
        pairs_from, pairs_to = reach(self.pair_ends, h, far)
        contexts_from, contexts_to = reach(self.context_ends, h, far)
        key, at = np.unique(top * self.words + np.minimum(w, self.words - 1), return_inverse=True)
        t = key // self.words
        pair, seen = self.pairs.successor(h[t] * self.words + key % self.words, pairs_from[t], pairs_to[t])
        pair, seen = pair[at], seen[at] & (w < self.words)
        above = top[contexts]
        own = np.minimum(u[contexts], self.words - 1)
        context, met = self.contexts.successor(h[above] * self.words + own, contexts_from[above], contexts_to[above])
        met &= u[contexts] < self.words
        context = np.where(met, context, 0)
        triples_from, triples_to = reach(self.triple_ends, context, np.where(met, context + 1, context))
        # a successor of a context is a successor of its hinge: it is found by its rank there
        rank = pair - pairs_from[top]
        both = np.flatnonzero(seen & met[of])
        c = of[both]
        triple, exact = self.triples.successor(context[c] * self.ranks + rank[both], triples_from[c], triples_to[c])
        a3 = np.zeros(len(hinge))
        a3[both] = self._of("triple", triple, exact, 0.0)
        a2, b2 = self._of("pair", pair, seen, 0.0), self._of("hinge", h, known, 1.0)[top]
        b3 = self._of("context", context, met, 1.0)[of]
        return a3 + b3 * a2, b3 * b2


# --- blocks --------------------------------------------------------------------------------------------

BLOCK = "block string, ids array<long>, learned array<boolean>, lengths binary, codes binary, words binary, n_words long"


def _blocks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, number = TaskContext.get(), 0
        kept: list[tuple] = []
        tokens = 0

        def block() -> pa.RecordBatch:
            words = pa.chunked_array([k[2] for k in kept], pa.large_string()).combine_chunks().dictionary_encode()
            lengths = np.concatenate([k[3] for k in kept]) + 1
            ends = np.cumsum(lengths) - 1
            codes = np.zeros(int(lengths.sum()), dtype=np.int64)
            inside = np.ones(len(codes), dtype=bool)
            inside[ends] = False
            codes[inside] = words.indices.to_numpy() if len(words) else 0
            codes[ends] = last = len(words.dictionary)
            often = np.argsort(-np.bincount(codes, minlength=last + 1), kind="stable")
            place = np.empty_like(often)
            place[often] = np.arange(last + 1)
            names = pa.concat_arrays([words.dictionary.cast(pa.large_string()), pa.array([END], pa.large_string())]).take(pa.array(often))
            text = "\n".join(names.to_pylist()).encode()
            row = [
                f"{context.partitionId()}-{number}", [i for k in kept for i in k[0]], [bool(t) for k in kept for t in k[1]], packed(lengths), packed(place[codes]),
                len(text).to_bytes(8, "little") + pa.compress(text, codec="zstd", asbytes=True), len(names),
            ]
            kinds = [pa.string(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names=["block", "ids", "learned", "lengths", "codes", "words", "n_words"])

        for batch in in_slices(batches, 1024):
            words, counts = words_of(batch.column(2))
            kept.append((batch.column(0).to_pylist(), batch.column(1).to_pylist(), words.cast(pa.large_string()) if words.type != pa.large_string() else words, counts))
            tokens += int(counts.sum()) + len(counts)
            if tokens >= size:
                yield block()
                kept, tokens, number = [], 0, number + 1
        if kept:
            yield block()

    return run


def _names(words: bytes) -> pa.Array:
    size = int.from_bytes(words[:8], "little")
    return pa.array(pa.decompress(words[8:], decompressed_size=size, codec="zstd", asbytes=True).decode().split("\n"), pa.large_string())


def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, positions in ascending order) of each shard that occurs."""
    order = np.argsort(shard, kind="stable")
    starts = _starts(shard[order])
    for a, b in zip(starts, np.append(starts[1:], len(order))):
        yield int(shard[order[a]]), order[a:b]


def hash_of(names: pa.Array) -> np.ndarray:
    """Words' own hashes, by which they are dealt out: to shards, and as preceding words to classes."""
    return word_hashes(names, 40)


def _word_parts(shards: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for block, learned, lengths, codes, words in zip(frame["block"], frame["learned"], frame["lengths"], frame["codes"], frame["words"]):
                names, codes = _names(words), unpacked(codes)
                train = np.repeat(np.asarray(learned, dtype=bool), unpacked(lengths))
                counts = np.bincount(codes[train], minlength=len(names))
                rows = []
                for shard, at in _by_shard(hash_of(names) % shards):
                    text = "\n".join(names.take(pa.array(at)).to_pylist()).encode()
                    rows.append((shard, block, len(text).to_bytes(8, "little") + pa.compress(text, codec="zstd", asbytes=True), packed(counts[at])))
                yield pd.DataFrame(rows, columns=["shard", "block", "words", "counts"])

    return run


def _number_words(shards: int):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block")
        parts = [_names(w) for w in frame["words"]]
        coded = pa.chunked_array(parts, pa.large_string()).combine_chunks().dictionary_encode()
        codes, counts = coded.indices.to_numpy().astype(np.int64), np.concatenate([unpacked(c) for c in frame["counts"]])
        total = np.bincount(codes, counts, minlength=len(coded.dictionary)).astype(np.int64)
        # numbers fall with frequency; they interleave with other shards', and 0 is left for the beginning
        order = pc.sort_indices(pa.table({"n": -total, "w": coded.dictionary}), sort_keys=[("n", "ascending"), ("w", "ascending")]).to_numpy()
        number = np.empty(len(total), dtype=np.int64)
        number[order] = np.arange(len(total)) * shards + int(key[0]) + 1
        ends = np.cumsum([len(p) for p in parts])
        out = [(b, int(key[0]), packed(number[codes[e - len(p) : e]]), packed(total[codes[e - len(p) : e]]), 0, 0, 0) for b, p, e in zip(frame["block"], parts, ends)]
        # the end of a text is one word: its count is the number of learned texts
        is_end = pc.index(coded.dictionary, pa.scalar(END, pa.large_string())).as_py()
        out.append((None, int(key[0]), b"", b"", int(total.sum()), int((total > 0).sum()), int(total[is_end]) if is_end >= 0 else 0))
        return pd.DataFrame(out, columns=["block", "shard", "numbers", "totals", "tokens", "known", "texts"])

    return run


def classes_of(total: np.ndarray, tokens: int, hot: int) -> np.ndarray:
    """Into how many classes the words before a middle word fall, by how often that occurs."""
    return np.maximum(1, total * hot // max(tokens, 1))


def class_of(hashes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    return mixed(hashes + 1) % classes


class Block:
    """A block with its words' numbers and totals: its tokens, and its distinct trigrams in order."""

    def __init__(self, row, answers: pd.DataFrame, stats: dict, shards: int, trie_shards: int):
        names, local = _names(row["words"]), unpacked(row["codes"])
        self.lengths = unpacked(row["lengths"])
        self.ids, self.learned = list(row["ids"]), np.asarray(row["learned"], dtype=bool)
        number, total = np.zeros(len(names), dtype=np.int64), np.zeros(len(names), dtype=np.int64)
        mine = {s: (n, t) for s, n, t in zip(answers["shard"], answers["numbers"], answers["totals"])}
        hashes = hash_of(names)
        for shard, at in _by_shard(hashes % shards):
            number[at], total[at] = unpacked(mine[shard][0]), unpacked(mine[shard][1])
        del names
        self.count = total[local]
        order = np.argsort(number)
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(1, len(order) + 1)
        # first stands the beginning of a text
        self.numbers, self.totals = np.concatenate([[0], number[order]]), np.concatenate([[stats["texts"]], total[order]])
        self.hashes = np.concatenate([[0], hashes[order]])
        w = rank[local]
        begins = np.cumsum(self.lengths) - self.lengths
        v = np.concatenate([[0], w[:-1]])
        v[begins] = 0
        u = np.concatenate([[0], v[:-1]])
        u[begins] = 0
        size = len(self.numbers)
        if size**3 < 1 << 62:
            key, self.back = np.unique((v * size + u) * size + w, return_inverse=True)
            pair, self.w = np.divmod(key, size)
        else:  # a block whose dictionary is too large for one number: pairs are numbered first
            pairs, at = np.unique(v * size + u, return_inverse=True)
            key, self.back = np.unique(at * size + w, return_inverse=True)
            pair, self.w = np.divmod(key, size)
            pair = pairs[pair]
        self.v, self.u = np.divmod(pair, size)
        self.kinds = stats["hot"] + 1
        self.kind = class_of(self.hashes[self.u], classes_of(self.totals[self.v], stats["tokens"], stats["hot"]))
        self.shard = mixed(self.hinge(slice(None))) % trie_shards

    def hinge(self, at: np.ndarray | slice) -> np.ndarray:
        return self.numbers[self.v[at]] * self.kinds + self.kind[at]


def _grouped(block_row: pd.DataFrame) -> tuple[pd.Series, pd.DataFrame, pd.DataFrame]:
    """The three kinds of rows that meet for one block."""
    kinds = block_row["kind"]
    return block_row[kinds == 0].iloc[0], block_row[kinds == 1], block_row[kinds == 2]


def _trigram_parts(stats: dict, shards: int, trie_shards: int):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        row, answers, _ = _grouped(frame)
        block = Block(row, answers, stats, shards, trie_shards)
        train = np.repeat(block.learned, block.lengths)
        counts = np.bincount(block.back[train], minlength=len(block.w))
        rows = []
        for shard, at in _by_shard(block.shard):
            u, w = block.numbers[block.u[at]], block.numbers[block.w[at]]
            rows.append((shard, row["block"], packed_steps(block.hinge(at)), packed_steps(u), packed(w), packed(counts[at])))
        return pd.DataFrame(rows, columns=["shard", "block", "hinge", "u", "w", "counts"])

    return run


def _answer_trigrams(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """Build the shard's trie from all blocks' counts, and answer each block in its own order."""
    hinges = [unpacked_steps(x) for x in frame["hinge"]]
    ends = np.cumsum([len(h) for h in hinges])
    hinge = np.concatenate(hinges)
    del hinges
    u, w = np.concatenate([unpacked_steps(x) for x in frame["u"]]), np.concatenate([unpacked(x) for x in frame["w"]])
    count = np.concatenate([unpacked(x) for x in frame["counts"]])
    order = np.lexsort((w, u, hinge))
    hinge, u, w = hinge[order], u[order], w[order]
    starts = _starts(hinge, u, w)
    total = np.add.reduceat(count[order], starts)
    hinge, u, w = hinge[starts], u[starts], w[starts]
    seen = total > 0
    above, left = Trie(hinge[seen], u[seen], w[seen], total[seen]).query(hinge, u, w)
    runs = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
    a, b = np.empty(len(order), dtype=np.uint16), np.empty(len(order), dtype=np.uint16)
    a[order], b[order] = quantised(above)[runs], quantised(left)[runs]
    rows = [(block, int(key[0]), packed(a[s:e]), packed(b[s:e])) for block, s, e in zip(frame["block"], np.append(0, ends[:-1]), ends)]
    return pd.DataFrame(rows, columns=["block", "shard", "numbers", "totals"])


def _scores(stats: dict, shards: int, trie_shards: int):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        row, answers, found = _grouped(frame)
        block = Block(row, answers, stats, shards, trie_shards)
        above, left = np.empty(len(block.w)), np.empty(len(block.w))
        mine = {s: (a, b) for s, a, b in zip(found["shard"], found["numbers"], found["totals"])}
        for shard, at in _by_shard(block.shard):
            above[at], left[at] = probability(unpacked(mine[shard][0])), probability(unpacked(mine[shard][1]))
        p1 = (block.count + PRIOR) / (stats["tokens"] + PRIOR * (stats["known"] + 1))
        p = np.minimum(above[block.back] + left[block.back] * p1, 1.0)
        begins = np.cumsum(block.lengths) - block.lengths
        each = lambda x: np.add.reduceat(x, begins)
        return pd.DataFrame({
            "id": pd.array(block.ids, dtype="Int64"), "n_tokens": block.lengths, "n_known": each((block.count > 0).astype(np.int64)),
            "base_score": each(np.log10(p1)), "score": each(np.log10(p)),
        })

    return run


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 10, hot: int = HOT, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score for every row.

    Rows whose crc32(id) mod folds is 0 are held out; a null id is neither learned from nor held out. Null
    texts are empty: one token, the end. hot is the number of classes that a word making up all tokens
    would have. Without learned rows every token has probability 1.
    """
    spark = docs.sparkSession
    fold = remainder(F.col(doc_id), folds)
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(fold != 0, F.lit(False)).alias("learned"), F.col(text).alias("text"))
    blocks = stage(rows.mapInArrow(_blocks(block_tokens), BLOCK), "blocks")
    # as many word shards as words ask for: a shard holds every block's entries for its words
    size = blocks.agg(F.count("*").alias("blocks"), F.sum("n_words").alias("entries")).first()
    shards = max(partitions(spark), math.ceil((size["entries"] or 0) / SHARD_WORDS))
    # and as many tasks as shards or blocks, so that none reads more as the corpus grows
    dealt = lambda rows, key, n: rows.repartition(max(partitions(spark), n), key).groupBy(key)
    parts = blocks.mapInPandas(_word_parts(shards), "shard int, block string, words binary, counts binary")
    answered = "block string, shard int, numbers binary, totals binary"
    words = stage(dealt(parts, "shard", shards).applyInPandas(_number_words(shards), answered + ", tokens long, known long, texts long"), "words")
    stats = {k: v or 0 for k, v in words.agg(*[F.sum(c).alias(c) for c in ("tokens", "known", "texts")]).first().asDict().items()}
    stats["hot"] = hot
    tokens = max(stats["tokens"], (stats["tokens"] * folds) // max(folds - 1, 1))
    trie_shards = max(shards, math.ceil(tokens / SHARD_TOKENS))
    none = [F.lit(None).cast("int").alias("shard"), F.lit(None).cast("binary").alias("numbers"), F.lit(None).cast("binary").alias("totals")]
    empty = [F.lit(None).cast(t).alias(c) for c, t in (("ids", "array<long>"), ("learned", "array<boolean>"), ("lengths", "binary"), ("codes", "binary"), ("words", "binary"))]
    own = blocks.select(F.lit(0).alias("kind"), "block", "ids", "learned", "lengths", "codes", "words", *none)
    numbered = words.where("block is not null").select(F.lit(1).alias("kind"), "block", *empty, "shard", "numbers", "totals")
    trigrams = dealt(own.union(numbered), "block", size["blocks"]).applyInPandas(_trigram_parts(stats, shards, trie_shards), "shard int, block string, hinge binary, u binary, w binary, counts binary")
    answers = stage(dealt(trigrams, "shard", trie_shards).applyInPandas(_answer_trigrams, answered), "answers")
    given = answers.select(F.lit(2).alias("kind"), "block", *empty, "shard", "numbers", "totals")
    scored = dealt(own.union(numbered).union(given), "block", size["blocks"]).applyInPandas(_scores(stats, shards, trie_shards), "id long, n_tokens long, n_known long, base_score double, score double")
    out = stage(scored, "scores")
    unstage(blocks, words, answers)
    held_out = F.coalesce(remainder("id", folds) == 0, F.lit(False)).alias("held_out")
    return out.select(F.col("id").alias(doc_id), held_out, "n_tokens", "n_known", F.lit(stats["tokens"]).cast("long").alias("train_tokens"), "base_score", "score")
