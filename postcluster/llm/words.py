"""Word scanning over Arrow string columns with numpy, no Python object per word.

A batch of texts is one byte buffer plus offsets.  Words are the maximal runs
of bytes of one class (whitespace bytes belong to none), so a whole batch is
scanned with a few array passes.  A word's 64-bit hash takes eight bytes at a
time and mixes after each step, so there are no structured clashes (as sums
over powers of a base have); words beyond ``LONG`` bytes have a BLAKE2 hash.

Null texts count as empty.  A word never spans two texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are handled in slices of about this many bytes, whatever the batch size.
SLICE_BYTES = 4 << 20

SPACE = 0
ASCII_SPACE = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])


def byte_classes(separators: bytes = ASCII_SPACE, splitting: bytes = b"") -> np.ndarray:
    """Class of every byte: 0 separates, 1 is word matter, 2 (``splitting``)
    is word matter that never joins class 1."""
    table = np.ones(256, np.uint8)
    table[list(splitting)] = 2
    table[list(separators)] = SPACE
    return table


#: ``[^\x20\x09-\x0D]+``
WORDS = byte_classes()
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (after A-Z is lower-cased)
ALNUM_WORDS = byte_classes(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64's), so that low bits are even."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeds64(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    with np.errstate(over="ignore"):
        base = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return mix64(base + np.uint64(seed)) | np.uint64(1)


_STEP, _LENGTH, _LEFT, _RIGHT = seeds64(4, 11)
#: Bytes of a word that are hashed step by step.
LONG = 64
#: The first i bytes of a little-endian number, for i up to 8.
_FIRST = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


def run_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` consecutive numbers: runs of
    1, 2, 4, ... are joined pairwise, mixed at every join."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, size, level = None, 0, 1, values
    with np.errstate(over="ignore"):
        while True:
            if width & size:
                piece = level[done:done + n]
                out = piece if out is None else mix64(out * _LEFT + (piece ^ _RIGHT))
                done += size
            if 2 * size > width:
                return out
            level = mix64(level[:-size] * _LEFT + (level[size:] ^ _RIGHT))
            size *= 2


@dataclass
class Words:
    """Words of a slice of texts.  ``first[d]:first[d + 1]`` are those of text
    ``d``; word ``w`` is ``data[start[w]:end[w]]``."""

    data: np.ndarray   # uint8, lower-cased if asked
    start: np.ndarray  # int64
    end: np.ndarray    # int64
    first: np.ndarray  # int64, texts + 1
    texts: np.ndarray  # int64 byte offsets of the texts, texts + 1

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self, w: int) -> bytes:
        return self.data[self.start[w]:self.end[w]].tobytes()

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        length = self.end - self.start
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eight = np.ndarray(len(self.data) + 1, "<u8", padded, strides=(1,))  # the 8 bytes from each place on
        with np.errstate(over="ignore"):
            out = mix64(length.astype(np.uint64) * _LENGTH + np.uint64(seed))
            short = np.flatnonzero(length <= LONG)
            at = self.start[short]
            while len(short):
                left = self.end[short] - at
                out[short] = mix64(out[short] * _STEP + (eight[at] & _FIRST[np.minimum(left, 8)]))
                more = left > 8
                short, at = short[more], at[more] + 8
        for w in np.flatnonzero(length > LONG).tolist():
            digest = hashlib.blake2b(self.text(w), digest_size=8, salt=seed.to_bytes(8, "little")).digest()
            out[w] = int.from_bytes(digest, "little")
        return out

    def strings(self) -> pa.Array:
        """The words as strings (of the bytes as scanned)."""
        return strings(self.data, self.start, self.end - self.start)


def strings(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.Array:
    """Strings from ranges of a byte buffer of valid UTF-8."""
    ends = np.cumsum(length)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - length), length)
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(length), [
        None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[at]))])


def scan(texts: pa.Array, classes: np.ndarray = WORDS, lower: bool = False) -> Words:
    """Words of an Arrow string array (nulls are empty texts)."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(offsets):
        offsets = np.zeros(1, np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    data, offsets = data[offsets[0]:offsets[-1]], offsets - offsets[0]
    if lower:
        data = LOWER[data]
    kind = classes[data]
    cut = np.empty(len(kind), bool)  # a word may begin here
    if len(kind):
        cut[0] = True
        np.not_equal(kind[1:], kind[:-1], out=cut[1:])
        inner = offsets[(offsets > 0) & (offsets < len(kind))]
        cut[inner] = True
    bounds = np.flatnonzero(cut)
    ends = np.append(bounds[1:], len(kind))
    word = kind[bounds] != SPACE
    start, end = bounds[word], ends[word]
    return Words(data, start, end, np.searchsorted(start, offsets), offsets)


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``most`` text bytes (a longer text
    is a run of its own)."""
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size.astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def segment_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values[first[i]:first[i + 1]]`` for each i (0 when empty)."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]
