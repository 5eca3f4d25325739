"""Vectorised text primitives shared by the corpus operators.

Everything here works on one Arrow batch at a time: the texts of a batch are
joined into a single byte buffer and all words of all texts are found, folded
and hashed with numpy, so that no Python code runs once a word.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

#: Fixed odd multiplier of the hashes.
PRIME = 0x9E3779B97F4A7C15

#: The white space of the word pattern ``[^\\x20\\x09-\\x0D]+``.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def _mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64's finalizer: a bijection of 64-bit words."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


mixed = _mixed

#: Slices of more bytes are hashed one by one.
LANES_MOST = 64
#: What counts of a lane with k bytes left.
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets of n + 1); a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    if len(offsets) == 0:
        return raw[:0], np.zeros(1, np.int64)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """All words of a batch: ``starts``/``ends`` in ``raw`` (folded bytes), and ``first`` (n + 1): the words of text i are first[i]..first[i+1]."""

    def __init__(self, column: pa.Array, lower: bool = True):
        raw, offsets = text_bytes(column)
        self.raw = _LOWER[raw] if lower else raw
        gap = np.ones(len(raw) + 1, bool)
        np.take(_IS_SPACE, raw, out=gap[:-1])
        # A word ends where white space or the next text begins.
        begins = ~gap[:-1]
        begins[1:] &= gap[:-2]
        firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
        begins[firsts] = ~gap[firsts]
        stops = ~gap[:-1]
        stops[:-1] &= gap[1:-1]
        lasts = firsts[1:] - 1 if len(firsts) else firsts
        stops[lasts] = ~gap[lasts]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(stops) + 1
        self.offsets = offsets
        self.first = np.searchsorted(self.starts, offsets)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word; equal words have equal hashes in any batch."""
        return slice_hashes(self.raw, self.starts, self.ends)


def slice_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each slice of the bytes ``raw``: its length and its 8-byte lanes, mixed one after the other, or BLAKE2b beyond LANES_MOST bytes."""
    lengths = (ends - starts).astype(np.int64)
    out = _mixed(lengths.astype(np.uint64) * np.uint64(PRIME))
    lanes = np.ndarray((len(raw) + 1,), "<u8", buffer=np.concatenate((raw, np.zeros(8, np.uint8))), strides=(1,))
    live = np.flatnonzero(lengths <= LANES_MOST)
    for k in range(0, LANES_MOST, 8):
        live = live[lengths[live] > k]
        if not len(live):
            break
        left = np.minimum(lengths[live] - k, 8)
        out[live] = _mixed((out[live] ^ (lanes[starts[live] + k] & _MASKS[left])) * np.uint64(PRIME))
    for i in np.flatnonzero(lengths > LANES_MOST).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(raw[starts[i] : ends[i]], digest_size=8).digest(), "little")
    return out


def shingles(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, first of n + 1): every run of ``size`` words of each text; of a text with fewer words the whole run; none without words."""
    counts = np.diff(words.first)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(made, out=first[1:])
    at = np.arange(first[-1]) + np.repeat(words.first[:-1] - first[:-1], made)
    length = np.repeat(np.minimum(counts, size), made)
    out = np.full(len(at), 0x1234567, np.uint64) + length.astype(np.uint64)
    for k in range(size):
        live = slice(None) if k == 0 else length > k
        piece = hashes[(at if k == 0 else at[live]) + k]
        out[live] = _mixed(out[live] * np.uint64(PRIME) + piece) if k else out * np.uint64(PRIME) + piece
    return _mixed(out), first


def distinct(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each group, and their new ``first``."""
    kept, counts = [], np.zeros(len(first), np.int64)
    for i in range(len(first) - 1):
        own = values[first[i] : first[i + 1]]
        if len(own) > 1:
            own = np.sort(own)
            new = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=new[1:])
            own = own[new]
        counts[i + 1] = len(own)
        kept.append(own)
    return (np.concatenate(kept) if kept else values[:0]), np.cumsum(counts)


def frugal() -> None:
    """Freed arrays of 1 MB and more go back to the system at once, and what is free already goes back now.

    Spark keeps idle workers, so what one operator leaves in a worker adds to what the next needs. Where the C
    library has no such settings, nothing happens.
    """
    import ctypes

    c = ctypes.CDLL(None)
    if hasattr(c, "mallopt"):
        c.mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD; setting it also ends its growth with each array freed
        c.mallopt(-1, 4 << 20)  # M_TRIM_THRESHOLD
    if hasattr(c, "malloc_trim"):
        c.malloc_trim(0)
    pa.default_memory_pool().release_unused()
