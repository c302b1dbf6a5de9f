"""Fill-in-the-middle: a text's prefix, middle and suffix in another order, cut at token boundaries.

A text's bytes become one big integer for each class of byte, a bit for a byte: `bytes.translate` writes the digits,
`int` reads them. Boundaries of all tokens are then three operations on whole integers, their number is a bit count,
and the boundary of a rank is found by halving.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import free_name
from tickloom.llm.tokens import in_slices

LETTERS = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
#: Marks of the three parts, all of one length.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_IS_LETTER = bytes(49 if b in LETTERS else 48 for b in range(256))
_IS_LEAD = bytes(48 if 0x80 <= b < 0xC0 else 49 for b in range(256))


def class_mask(backwards: bytes, table: bytes) -> int:
    """Bit i is set if byte i, counted from the end of backwards, is in the class of table."""
    return int(backwards.translate(table), 2) if backwards else 0


def boundaries(data: bytes) -> tuple[int, int]:
    """(starts, leads): the bytes that start a token, and those that start a code point.

    A token is a run of ASCII letters or one other code point.
    """
    backwards = data[::-1]
    letters, leads = class_mask(backwards, _IS_LETTER), class_mask(backwards, _IS_LEAD)
    return leads ^ (letters & (letters << 1)), leads


def select(mask: int, rank: int, width: int) -> int:
    """The place of the set bit that rank set bits lie below; width if there are no more."""
    if rank >= mask.bit_count():
        return width
    at = 0
    while width > 1:
        half = width >> 1
        low = mask & ((1 << half) - 1)
        below = low.bit_count()
        if rank < below:
            mask, width = low, half
        else:
            mask, rank, at, width = mask >> half, rank - below, at + half, width - half
    return at


def cuts(data: bytes, first: int, second: int) -> tuple[int, int, int, int, int]:
    """n, the bytes before the middle and up to its end, and the code points of prefix and middle, where first and
    second are drawn numbers: their remainders by n + 1 are the tokens before either end of the middle."""
    starts, leads = boundaries(data)
    n = starts.bit_count()
    low, high = sorted((first % (n + 1), second % (n + 1)))
    a, b = select(starts, low, len(data)), select(starts, high, len(data))
    before = (leads & ((1 << a) - 1)).bit_count()
    return n, a, b, before, (leads & ((1 << b) - 1)).bit_count() - before


def transform(data: bytes, draws: tuple[int, int, int, int], plain_from: int, spm_below: int) -> tuple[int, str, int | None, int | None, bytes]:
    """n, form, code points of prefix and middle (None if plain), and the output of one text."""
    n, a, b, before, inside = cuts(data, draws[0], draws[1])
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    if not data or p in data or s in data or m in data or draws[2] % 100 >= plain_from:
        return n, "plain", None, None, data
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    if draws[3] % 100 < spm_below:
        return n, "spm", before, inside, b"".join((s, suffix, p, prefix, m, middle))
    return n, "psm", before, inside, b"".join((p, prefix, s, suffix, m, middle))


def draws_of(doc_id: object, seed: int) -> tuple[int, int, int, int]:
    """Four unsigned 32-bit numbers of a document: the start of a digest of seed and id (a null id: empty)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = 1, plain_from: int = 90, spm_below: int = 20, output: str = "fim") -> DataFrame:
    """docs with a column output: struct (n, form, prefix_chars, middle_chars, text).

    A document is plain (its text as it is, no cuts) if it is empty or null, holds one of the marks, or its draw is
    plain_from or more of 100; else spm if another draw is below spm_below of 100, else psm. Draws depend on seed and
    id alone: rows of one id are cut at the same shares, equal rows alike, and null ids share one draw. Texts of any
    length are cut as a whole, in memory of a few times their bytes. Other columns stay, whatever their names; an
    output name that is taken gets an underscore before it. An empty table stays empty.
    """
    output = free_name(docs, output)
    made = "struct<n bigint, form string, prefix_chars bigint, middle_chars bigint, text string>"
    schema = docs.select("*", F.lit(None).cast(made).alias(output)).schema
    id_at, text_at = docs.columns.index(doc_id), docs.columns.index(text)
    kinds = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 256):
            ids, texts = batch.column(id_at).to_pylist(), batch.column(text_at).cast(pa.binary()).to_pylist()
            rows = [transform(t or b"", draws_of(i, seed), plain_from, spm_below) for i, t in zip(ids, texts)]
            parts = [pa.array(list(c), k.type) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k.type) for k in kinds]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.StructArray.from_arrays(parts, fields=list(kinds))], names=[*batch.schema.names, output])

    return docs.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of: no part holds a mark, so the first of each ends the part before it."""
    wide = F.lit(len(PREFIX))
    second = F.when(form == "spm", F.instr(output, PREFIX)).otherwise(F.instr(output, SUFFIX))
    third = F.instr(output, MIDDLE)
    one = F.substring(output, wide + 1, second - wide - 1)
    two = F.substring(output, second + wide, third - second - wide)
    middle = F.substring(output, third + wide, F.length(output))
    return F.when(form == "plain", output).when(form == "spm", F.concat(two, middle, one)).otherwise(F.concat(one, middle, two))
