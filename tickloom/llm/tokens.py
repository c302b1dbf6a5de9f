"""Words of texts as Arrow arrays, without a Python object per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def plain_texts(texts: pa.Array) -> pa.Array:
    """Texts without nulls. Their type is kept: a cast of a sliced array loses track of its offsets."""
    return pc.fill_null(texts if texts.type in (pa.string(), pa.large_string()) else texts.cast(pa.string()), "")


def words_of(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """All words of some texts one after another, and how many each text has (null text: none).

    Arrow's ASCII whitespace is exactly space and the controls 9 to 13; lower-casing touches A-Z only.
    """
    texts = plain_texts(texts)
    if lower:
        texts = pc.ascii_lower(texts)
    texts = pc.ascii_trim_whitespace(texts)
    lists = pc.ascii_split_whitespace(texts)
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    words = lists.flatten()
    if empty.any():
        counts = np.where(empty, 0, counts)
        words = words.filter(pc.greater(pc.binary_length(words), 0))
    return words, counts


def word_bytes(words: pa.Array) -> tuple[np.ndarray, memoryview]:
    """Start offsets (one more than strings) and the bytes that they point into."""
    kind = np.int64 if words.type == pa.large_string() else np.int32
    if not len(words):
        return np.zeros(1, dtype=np.int64), memoryview(b"")
    offsets = np.frombuffer(words.buffers()[1], dtype=kind)[words.offset : words.offset + len(words) + 1]
    return offsets.astype(np.int64), memoryview(words.buffers()[2] or b"")


def in_slices(batches, size: int):
    """Arrow batches cut to at most size rows, so that a batch of long texts stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)
