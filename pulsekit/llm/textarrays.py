"""NumPy views of Arrow text columns: words, word hashes and word n-grams.

All functions work on the concatenated UTF-8 bytes of many texts at once, so a
task spends its time in array operations instead of a Python loop over rows.
Nulls count as empty texts. Word separators are bytes 0x20 and 0x09-0x0D.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # texts handled together; a longer text is a chunk of its own
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_MASK = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (xor-shift, multiply, twice)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@dataclass
class Chunk:
    """Texts ``lo:hi`` of a batch; ``data`` has 8 zero bytes of padding."""
    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return self.hi - self.lo

    @property
    def size(self) -> int:
        return int(self.offsets[-1])


def text_chunks(column: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Split a string column into chunks of whole texts of about ``max_bytes``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    _, off, buf = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        a, b = int(offsets[lo]), int(offsets[hi])
        part = np.zeros(b - a + 8, dtype=np.uint8)
        part[:b - a] = data[a:b]
        yield Chunk(lo, hi, part, offsets[lo:hi + 1] - a)
        lo = hi


def hash_spans(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span (eight bytes a step; ``data`` padded by 8)."""
    view = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    h = mix(lens.astype(np.uint64) + np.uint64(0x51ED270B))
    live = np.arange(len(starts))
    pos, left = starts.astype(np.int64), lens.astype(np.int64)
    while live.size:
        w = view[pos] & _MASK[np.minimum(left, 8)]
        h[live] = mix(h[live] ^ (w * np.uint64(0xA0761D6478BD642F)))
        more = left > 8
        live, pos, left = live[more], pos[more] + 8, left[more] - 8
    return h


@dataclass
class Words:
    """Words of a chunk, in text order."""
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray    # index of the word's text within the chunk
    count: np.ndarray   # words per text
    first: np.ndarray   # index of each text's first word


def words_of(chunk: Chunk, separator: np.ndarray = SEPARATOR) -> Words:
    size = chunk.size
    inside = ~separator[chunk.data[:size]]
    begins = np.zeros(size + 1, dtype=bool)
    begins[chunk.offsets[:-1]] = True
    begins = begins[:size]
    before = np.zeros(size, dtype=bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (begins | ~before))
    last = np.ones(size, dtype=bool)
    last[:-1] = ~inside[1:] | begins[1:]
    end = np.flatnonzero(inside & last) + 1
    count = np.diff(np.searchsorted(start, chunk.offsets))
    text = np.repeat(np.arange(chunk.n), count)
    return Words(start, end, text, count, np.concatenate([[0], np.cumsum(count)[:-1]]).astype(np.int64))


def word_hashes(chunk: Chunk, w: Words) -> np.ndarray:
    return hash_spans(chunk.data, w.start, w.end - w.start)


def ngrams(hashes: np.ndarray, group: np.ndarray, k: int, n_groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``k``-word windows inside each group (a text or a paragraph).

    ``group`` is ascending. A group of 1 to k-1 words has one gram of all its
    words. Returns (gram, group of the gram), ordered by group.
    """
    n = len(hashes)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    mult = np.uint64(0xC2B2AE3D27D4EB4F)
    count = np.bincount(group, minlength=n_groups)
    grams, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if n >= k:
        g = hashes[:n - k + 1].copy()
        for j in range(1, k):
            g = g * mult + hashes[j:n - k + 1 + j]
        ok = group[:n - k + 1] == group[k - 1:]
        grams, owner = mix(g[ok]), group[:n - k + 1][ok]
    short = np.flatnonzero((count > 0) & (count < k))
    if short.size:
        first = np.concatenate([[0], np.cumsum(count)[:-1]])[short]
        g = hashes[first].copy()
        for j in range(1, k - 1):
            more = count[short] > j
            g[more] = g[more] * mult + hashes[first[more] + j]
        grams = np.concatenate([grams, mix(g + count[short].astype(np.uint64))])
        owner = np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        grams, owner = grams[order], owner[order]
    return grams, owner


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def binary_array(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Binaries of ``counts`` 8-byte values each."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]) * 8, type=pa.int32())
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(counts), [None, offsets.buffers()[1], pa.py_buffer(np.ascontiguousarray(values))])


def group_sums(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Column sums of ``values`` (rows x columns) per owner."""
    return np.stack([np.bincount(owner, values[:, j], minlength=n) for j in range(values.shape[1])], axis=1)


def subword_ids(data: np.ndarray, start: np.ndarray, length: np.ndarray, buckets: int,
                prefixes: tuple[int, ...], suffixes: tuple[int, ...], gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of words: the word, its prefixes and suffixes and its inner
    ``gram``-byte strings. Returns (word index, feature id), ordered by word."""
    n = len(start)
    every = np.arange(n)
    owners, ids = [every], [hash_spans(data, start, length)]

    def add(tag, who, at, size):
        owners.append(who)
        ids.append(mix(hash_spans(data, at, np.full(len(at), size)) + np.uint64(tag)))

    for p in prefixes:
        who = every[length >= p]
        add(100 + p, who, start[who], p)
    for s in suffixes:
        who = every[length >= s]
        add(200 + s, who, start[who] + length[who] - s, s)
    count = np.maximum(length - gram + 1, 0)
    who = np.repeat(every, count)
    add(300 + gram, who, start[who] + np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count), gram)
    owner, ids = np.concatenate(owners), np.concatenate(ids)
    order = np.argsort(owner, kind="stable")
    return owner[order], (ids[order] % np.uint64(buckets)).astype(np.int64)
