"""The words of many texts at once, as numbers, from sums over their bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLANKS = b" \t\n\x0b\x0c\r"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def _kinds(blanks: bytes, breaks: bytes) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[list(blanks)] = 1
    out[list(breaks)] = 2
    return out


class Words:
    """The words of a large binary array of UTF-8 texts, with A-Z lowered, as numbers of a dictionary.

    Words are runs of anything but the ASCII characters ``blanks`` and ``breaks``.  For each word, in order, ``ids`` has
    its number, ``text`` the number of its text, and ``piece`` a number that changes at breaks and texts.
    """

    def __init__(self, texts: pa.Array, blanks: bytes = BLANKS, breaks: bytes = b"") -> None:
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        begin, end = int(offsets[0]), int(offsets[-1])
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[begin:end]
        kind = _kinds(blanks, breaks)[raw]
        inside = kind == 0
        new_text = np.zeros(len(raw) + 1, bool)
        new_text[offsets - begin] = True
        starts = inside.copy()
        starts[1:] &= ~inside[:-1] | new_text[1:-1]
        at = np.flatnonzero(starts)
        self.n_texts = len(texts)
        self.piece = np.cumsum(new_text[:-1] | (kind == 2), dtype=np.int32)[at]
        self.text = np.searchsorted(offsets - begin, at, side="right") - 1
        letters = _LOWER[raw[inside]]
        counted = np.cumsum(inside, dtype=np.int32 if len(raw) < 1 << 31 else np.int64)
        ends = np.append(counted[at].astype(np.int64) - 1, len(letters))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(letters)])
        coded = words.dictionary_encode()
        self.ids, self.dictionary = coded.indices.to_numpy(), coded.dictionary

    def phrases(self, at: np.ndarray, length: int) -> pa.Array:
        """The phrases of ``length`` words that start at the given places, joined by blanks."""
        words = [self.dictionary.take(pa.array(self.ids[at + i])) for i in range(length)]
        return pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.large_binary()))

    def numbers(self, at: np.ndarray, length: int, seed: str = "") -> np.ndarray:
        """A 64-bit number for each phrase that starts at the given places, from the numbers of its words."""
        if not len(at):
            return np.zeros(0, np.uint64)
        own = hashes(self.dictionary, seed)
        out = np.full(len(at), length, np.uint64)
        for i in range(length):
            out = (out ^ own[self.ids[at + i]]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(31)
        return out


def hashes(words: pa.Array, seed: str = "") -> np.ndarray:
    """A 64-bit number for each word of a large binary array, from its bytes eight at a time."""
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    raw = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    sizes = np.diff(offsets)
    padded = np.append(raw, np.zeros(8, np.uint8))
    start = int.from_bytes(seed.encode("utf-8", "surrogatepass"), "little") % 0xFFFFFFFFFFFFFFC5
    out = np.full(len(sizes), start, np.uint64) ^ sizes.astype(np.uint64)
    step = np.uint64(0x9E3779B97F4A7C15)
    live, block = np.arange(len(sizes)), 0
    while len(live):
        at = offsets[live] + 8 * block
        part = np.zeros(len(live), np.uint64)
        left = sizes[live] - 8 * block
        for i in range(8):
            part |= np.where(left > i, padded[np.minimum(at + i, len(raw))], np.uint8(0)).astype(np.uint64) << np.uint64(8 * i)
        mixed = (out[live] ^ part) * step
        out[live] = (mixed ^ (mixed >> np.uint64(29))) * step
        live, block = live[left > 8], block + 1
    return out ^ (out >> np.uint64(32))


def chunks(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.Table]:
    """Rows whose texts have about ``size`` bytes together, or a single longer one; nulls become empty texts.

    The texts are large binaries.
    """
    held, n = [], 0
    for batch in batches:
        at = batch.schema.get_field_index(column)
        texts = pc.fill_null(batch.column(at).cast(pa.binary()).cast(pa.large_binary()), b"")
        batch = batch.set_column(at, column, texts)
        lengths = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = int(lengths[start - 1]) if start else 0
            end = max(start + 1, int(np.searchsorted(lengths, before + size - n, side="right")))
            held.append(batch.slice(start, end - start))
            n += int(lengths[end - 1]) - before
            if n >= size or end < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, n = [], 0
            start = end
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
