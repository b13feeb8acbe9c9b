"""Words of Arrow text columns as numpy arrays: spans, hashes and Rabin-Karp window hashes.

Everything works on the UTF-8 bytes of a block of whole texts, without a Python object per word.
A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return. A null text counts as an empty one, which has no words.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are hashed at once, and at which a batch is cut into blocks of whole texts.
BLOCK_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_NOT_ALNUM = np.ones(256, dtype=bool)
_NOT_ALNUM[0x80:] = False
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
    _NOT_ALNUM[_low : _high + 1] = False


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finaliser of SplitMix64)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as long as asked for."""

    def __init__(self, base: int):
        self.base, self.up, self.down = base, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            out = []
            for b in (self.base, _inverse(self.base)):
                p = np.full(size, b, np.uint64)
                p[0] = 1
                out.append(np.multiply.accumulate(p))
            if size > 1 << 22:  # of one huge text: not kept
                return out[0][:n], out[1][:n]
            self.up, self.down = out
        return self.up[:n], self.down[:n]


_WORD_POWERS = {1: _Powers(0xD1342543DE82EF95), 2: _Powers(0xAF251AF3B0F025B5)}
#: Words of more bytes than this are hashed one by one, by BLAKE2.
_LONG_WORD = 128
_SEEDS = {1: np.uint64(0x8F1BBCDC9E3779B9), 2: np.uint64(0x5BE0CD19A54FF53B)}
#: What is left of eight bytes of which a word has the first few.
_TAILS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def offsets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of the texts, and where each begins and the last ends. Null texts are empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = texts.buffers()
    at = np.frombuffer(at, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def release() -> None:
    """Give freed memory back, so that idle Python workers hold none of a finished batch's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with whole texts of about ``limit`` bytes; a longer text has its own. Memory is given back at the end."""
    _, at = offsets(batch.column(column))
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j
    release()


@dataclass
class Words:
    """Words of a block: byte spans, and ``first[i]:first[i + 1]`` as the words of text ``i``."""

    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words(texts: pa.Array, alnum: bool = False) -> Words:
    """Words of the texts; with ``alnum``, runs of ASCII letters, digits and bytes of other characters."""
    raw, at = offsets(texts)
    inside = ~(_NOT_ALNUM if alnum else _SPACE)[raw]
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[at] = True
    begins, ends = inside.copy(), inside.copy()
    if len(raw):
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    return Words(raw, starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, at))


def word_hashes(w: Words, lower: bool = False, kind: int = 1) -> np.ndarray:
    """A 64-bit hash of each word's bytes; ``lower`` maps A-Z to a-z first. Two kinds are independent.

    Eight bytes at a time are mixed into the hash, each time by a bijective scramble, so that no regular
    pattern of bytes cancels out as it may in a polynomial modulo a power of two.
    """
    raw = np.zeros(len(w.raw) + 8, np.uint8)
    raw[:-8] = _LOWER[w.raw] if lower else w.raw
    eight = np.ndarray((len(w.raw) + 1,), "<u8", raw.data, strides=(1,))  # the eight bytes from each place
    size = w.ends - w.starts
    out = size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + _SEEDS[kind]
    rows, at, left = slice(None), w.starts, np.minimum(size, _LONG_WORD)
    while len(left):
        part = eight[at] & _TAILS[np.minimum(left, 8)]
        out[rows] = mix(out[rows] * _SEEDS[kind] ^ part)
        more = np.flatnonzero(left > 8)
        rows = more if isinstance(rows, slice) else rows[more]
        at, left = at[more] + 8, left[more] - 8
    for i in np.flatnonzero(size > _LONG_WORD).tolist():
        digest = hashlib.blake2b(raw[w.starts[i] : w.ends[i]].data, digest_size=8, salt=bytes([kind])).digest()
        out[i] = np.frombuffer(digest, "<u8")[0]
    return out


def window_hashes(h: np.ndarray, size: int, kind: int = 1) -> np.ndarray:
    """Rabin-Karp hashes of every ``size`` consecutive word hashes (across texts too: see inside_text)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _WORD_POWERS[kind].get(len(h) + 1)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up[:-1], out=total[1:])
    return mix((total[size:] - total[:n]) * down[:n] + np.uint64(size))


def inside_text(w: Words, size: int) -> np.ndarray:
    """Which windows of ``size`` words lie within one text."""
    n = len(w.starts) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=bool)
    text = w.text_of_word()
    return text[size - 1 :] == text[:n]


def sliding_min(h: np.ndarray, size: int) -> np.ndarray:
    """The least of every ``size`` consecutive values."""
    have, out = 1, h
    while have < size:
        step = min(have, size - have)
        if len(out) <= step:
            return out[:0]
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def signed(h: np.ndarray) -> np.ndarray:
    """The same bits as Spark's BIGINT."""
    return np.ascontiguousarray(h).view(np.int64)
