"""Operator 11: periodic runs of words by an online sparse diagonal DP.

A run is a maximal stretch of words with smallest period q (words q apart are
equal) of at least ``MIN_LENGTH`` words and ``MIN_EXPONENT`` periods. On the
diagonal of lag q (the cells "word i equals word i - q") it is one unbroken
match of length - q cells. The scan goes over the words once, keeps the active
lag with its match length, and emits a run as soon as its diagonal ends.

The cells are sparse because a word only takes up a lag that can still become a
run. Such a diagonal is at least 16 cells long, and at least twice its lag, so
for lags in (L/2, L], L = 16 (lags 1 to 16), 32, 64, ..., a cell counts only
where the whole window of L words starting there occurs earlier. Of the earlier
occurrences the nearest one is the only candidate: a window of L >= q words of a
run with smallest period q that came back after d < q words would give the run
the period gcd(d, q) (Fine and Wilf). So every word looks at one earlier
occurrence per L, a text of n words costs O(n log^2 n) at any repetitiveness,
and no cell of a run is missed. Windows are compared by exact ranks (doubling),
never by hashes alone; a 16-word hash only tells which texts have any.

Defined results: a null text has no words; a text is handled whole, however
long, in memory proportional to it; matches never leave a text; repeated rows
give repeated results; of equally strong runs the strongest is the earliest,
then the one with the smaller period (exponents are compared as exact
fractions); a null doc_id is passed through; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm import textarrays as TA

MIN_LENGTH = 24
MIN_EXPONENT = 3
FIRST_WINDOW = 16  # cells of the shortest diagonal: min over q of max(24 - q, 2 q)
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = ("doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
          "strongest struct<start:long,length:long,period:long>, collapsed string")


def _doubled(rank: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of windows of twice the ``width``, and where each window's nearest earlier copy starts (-1: none)."""
    left, right = rank[:-width].astype(np.int64), rank[width:].astype(np.int64)
    pair = left * (int(rank.max()) + 1) + right
    order = np.argsort(pair, kind="stable")
    same = pair[order[1:]] == pair[order[:-1]]
    out = np.empty(len(pair), dtype=np.int64)
    out[order] = np.concatenate([[0], np.cumsum(~same)])
    before = np.full(len(pair), -1, dtype=np.int64)
    before[order[1:][same]] = order[:-1][same]
    return out, before


def periodic_runs(ids: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple]:
    """(start, length, period) of every run in a sequence of word ids, by start and period."""
    n = len(ids)
    found: list[tuple] = []
    rank, width, top = np.asarray(ids), 1, n // min_exponent
    while 2 * width <= n:
        rank, before = _doubled(rank, width)
        width *= 2
        if width < FIRST_WINDOW:
            continue
        low = 1 if width == FIRST_WINDOW else width // 2 + 1
        if low > top or not (before >= 0).any():
            break  # no window of this many words comes back: neither does a longer one
        lag = np.where(before >= 0, np.arange(len(before)) - before, 0)
        lag[(lag < low) | (lag > min(width, top))] = 0
        # unbroken stretches of one lag: the diagonals of this window size, each emitted where it ends
        edge = np.flatnonzero(np.diff(lag)) + 1
        first = np.concatenate([[0], edge])
        last = np.concatenate([edge, [len(lag)]]) - 1
        live = lag[first] > 0
        q, first, last = lag[first][live], first[live], last[live]
        start, length = first - q, last + width - first + q
        ok = (length >= min_length) & (length >= min_exponent * q)
        found += zip(start[ok].tolist(), length[ok].tolist(), q[ok].tolist())
    return sorted(found, key=lambda r: (r[0], r[2]))


def _normal_words(c: TA.Chunk, w: TA.Words) -> tuple[np.ndarray, np.ndarray]:
    """The words, each followed by one space, as one buffer with word offsets."""
    size = w.end - w.start
    offsets = np.concatenate([[0], np.cumsum(size + 1)]).astype(np.int64)
    flat = np.full(int(offsets[-1]), 0x20, dtype=np.uint8)
    within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    flat[within + np.repeat(offsets[:-1], size)] = c.data[within + np.repeat(w.start, size)]
    return flat, offsets


def _word_ids(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(flat)])
    return words.dictionary_encode().indices.to_numpy()


def _repetitive(ids: np.ndarray, w: TA.Words, n_texts: int) -> np.ndarray:
    """Which texts hold a window of 16 words twice, near enough for a run (by hash: may name too many)."""
    out = np.zeros(n_texts, dtype=bool)
    if len(ids) < FIRST_WINDOW:
        return out
    g, step = TA.mix(ids.astype(np.uint64)), 1
    while step < FIRST_WINDOW:
        g = TA.mix(g[:-step] * np.uint64(0xC2B2AE3D27D4EB4F) + g[step:])
        step *= 2
    at = np.flatnonzero(w.text[:len(g)] == w.text[FIRST_WINDOW - 1:])
    g = g[at] ^ TA.mix(w.text[at].astype(np.uint64) + np.uint64(29))
    order = np.argsort(g, kind="stable")
    same = g[order[1:]] == g[order[:-1]]
    here, earlier = at[order[1:][same]], at[order[:-1][same]]
    near = (here - earlier) * MIN_EXPONENT <= w.count[w.text[here]]
    out[w.text[here[near]]] = True
    return out


def _collapse(flat: np.ndarray, offsets: np.ndarray, kept: np.ndarray) -> bytes:
    """The words of the indices ``kept``, joined by one space."""
    size = offsets[kept + 1] - offsets[kept]
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(offsets[kept], size)
    return flat[at[:-1]].tobytes()


def _scan(order_of: Callable | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in TA.text_chunks(batch.column("text")):
                w = TA.words_of(c)
                flat, offsets = _normal_words(c, w)
                ids = _word_ids(flat, offsets)
                suspect = _repetitive(ids, w, c.n)
                doc_ids = batch.column("doc_id").slice(c.lo, c.n)
                runs, strongest, texts = [], [], []
                for t, doc_id in enumerate(doc_ids.to_pylist()):
                    a, n = int(w.first[t]), int(w.count[t])
                    order = order_of(doc_id, n) if order_of is not None and n else None
                    mine = []
                    if order is not None:
                        mine = periodic_runs(ids[a + order])
                    elif suspect[t]:
                        mine = periodic_runs(ids[a:a + n])
                    runs.append([dict(zip(("start", "length", "period"), r)) for r in mine])
                    best = max(mine, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
                    strongest.append(best and dict(zip(("start", "length", "period"), best)))
                    if not mine and order is None:
                        texts.append(flat[offsets[a]:max(offsets[a], offsets[a + n] - 1)].tobytes())
                        continue
                    depth = np.zeros(n + 1, dtype=np.int64)
                    for s, length, q in mine:
                        depth[s + q] += 1
                        depth[s + length] -= 1
                    kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
                    texts.append(_collapse(flat, offsets, a + (kept if order is None else order[kept])))
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, pa.array(w.count.astype(np.int64)), pa.array(runs, pa.list_(RUN)),
                     pa.array(strongest, RUN), pa.array(texts, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "runs", "strongest", "collapsed"])
    return run


def find_runs(docs: DataFrame, order_of: Callable | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, its runs by start and period, the
    strongest run (greatest length / period), and the text with every run
    reduced to its first period (kept words joined by one space).

    ``order_of(doc_id, n)`` may give the indices of the words to read instead of
    0..n-1 (planted loops for an evaluation), or None to read the text as it is.
    """
    return docs.select("doc_id", "text").mapInArrow(_scan(order_of), SCHEMA)


def planted_loop(doc_id: int | None, n: int) -> np.ndarray | None:
    """The evaluation's loops: in one document of ten, drawn by crc32 of its id,
    the words from a = g % n on repeat the p words that follow a."""
    if doc_id is None:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def run_digests(found: DataFrame) -> DataFrame:
    """The digest columns of ``find_runs``."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[x].cast("string") for x in ("start", "length", "period")]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("strongest.start").alias("start"), F.col("strongest.length").alias("length"),
        F.col("strongest.period").alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")
