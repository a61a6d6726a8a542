"""Operator 1: removal of byte strings of ``LENGTH`` bytes that occur more than once in the corpus.

Every window of ``LENGTH`` bytes belongs to its minimizer, the leftmost least
hash of the ``GRAM``-byte strings inside it, so equal windows meet under one
anchor whatever surrounds them. The windows of one occurrence of an anchor form
a run; the bytes they cover are its context. The job is:

1. anchor rows of all texts; anchors at a single place are dropped;
2. equal contexts collapse to one (all their windows are repeated), which is
   what copies and the inside of shared passages turn into, so hot passages
   shrink before anything is gathered;
3. the different contexts of an anchor are cut into ``BLOCK``-byte symbols
   aligned to the anchor and sorted by a suffix array (``suffix_array``); runs
   of suffixes that agree on the whole symbols of a window hold every repeated
   window, and the windows within a run are matched byte for byte by hash;
4. the marked windows go back to their texts, where the bytes are cut.

Anchors with more than ``MAX_CONTEXTS`` different contexts never meet in one
task: their windows are counted by hash in a plain aggregation instead.

Defined results: null is an empty text; texts shorter than ``LENGTH`` lose
nothing; documents with equal text (repeated rows too) are copies of each other
and lose every byte from ``LENGTH`` bytes on; a null doc_id comes back null;
an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.llm import textarrays as TA
from pulsekit.llm.storage import saved
from pulsekit.llm.suffix_array import suffix_array

LENGTH = 400
GRAM = 64
BLOCK = 32
MAX_CONTEXTS = 4096
SYMBOLS = 20_000          # symbols sorted together, unless one anchor has more
_POS_BITS = 24
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def _prefix_hash(data: np.ndarray) -> np.ndarray:
    up, _ = _power_tables(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=out[1:])
    return out


def _span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = _power_tables(len(prefix))
    return TA.mix((prefix[end] - prefix[start]) * down[start])


def _runs(data: np.ndarray, owner_end: np.ndarray, length: int, gram: int):
    """Anchor runs of the windows of ``data``.

    ``owner_end[s]`` is the end of the text that byte s belongs to. Returns
    first window, last window, anchor position, anchor hash and context hash.
    """
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    prefix = _prefix_hash(data)
    w = length - gram + 1
    at = np.arange(n - gram + 1)
    g = _span_hash(prefix, at, at + gram)
    mask = np.uint64((1 << _POS_BITS) - 1)
    key = (g & ~mask) | at.astype(np.uint64)
    blocks = -(-len(key) // w)
    padded = np.full(blocks * w, ~np.uint64(0), dtype=np.uint64)
    padded[:len(key)] = key
    grid = padded.reshape(blocks, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - length + 1
    least = np.minimum(behind[:m], ahead[w - 1:w - 1 + m])
    starts = np.flatnonzero(np.arange(m) + length <= owner_end[:m])
    if not starts.size:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    pos = (least[starts] & mask).astype(np.int64)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (pos[1:] != pos[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    lo, hi, a = starts[first], starts[last], pos[first]
    shape = ((a - lo).astype(np.uint64) << np.uint64(32)) | (hi - lo).astype(np.uint64)
    return lo, hi, a, g[a], TA.mix(_span_hash(prefix, lo, hi + length) ^ TA.mix(shape))


def _text_runs(c: TA.Chunk, length: int, gram: int):
    """Runs of a chunk; a text over the piece size is read in overlapping pieces.

    A run that a piece border cuts becomes two runs; equal windows still meet
    under their anchor.
    """
    piece = 1 << (_POS_BITS - 1)
    ends = np.repeat(c.offsets[1:], np.diff(c.offsets))
    parts = []
    for s in range(0, max(c.size, 1), piece):
        e = min(c.size, s + piece + length - 1)
        lo, hi, a, g, ctx = _runs(c.data[s:e], ends[s:e] - s, length, gram)
        parts.append((lo + s, hi + s, a + s, g, ctx))
    return [np.concatenate(x) for x in zip(*parts)]


def _anchor_rows(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
            for c in TA.text_chunks(batch.column("text")):
                lo, hi, a, g, ctx = _text_runs(c, length, gram)
                t = np.searchsorted(c.offsets, lo, side="right") - 1
                base = c.offsets[t]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g.view(np.int64)), pa.array(ctx.view(np.int64)), pa.array(k1[c.lo:c.hi][t]),
                     pa.array(k2[c.lo:c.hi][t]), pa.array(lo - base, pa.int64()), pa.array(hi - lo + 1, pa.int32()),
                     pa.array(a - lo, pa.int32())], ["anchor", "ctx", "k1", "k2", "lo", "wins", "off"])
    return run


def _contexts(length: int):
    """Cut the wanted contexts out of their texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("anchor", "ctx", "n_ctx", "wins", "off")
        for batch in batches:
            texts, want = batch.column("text"), batch.column("want")
            for i in range(batch.num_rows):
                raw = texts[i].as_py().encode()
                rows = want[i].as_py()
                for j in range(0, len(rows), 2000):
                    part = rows[j:j + 2000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[n] for x in part], pa.int64()) for n in names]
                        + [pa.array([raw[x["lo"]:x["lo"] + x["wins"] - 1 + length] for x in part], pa.binary())],
                        [*names, "raw"])
    return run


def _mark(offs, wins, raws, length: int, block: int) -> list[np.ndarray]:
    """For contexts of whole anchor groups: which windows occur in another context.

    Contexts are aligned to their anchors; returns a boolean array each.
    """
    data = np.frombuffer(b"".join(raws), dtype=np.uint8)
    size = np.array([len(r) for r in raws])
    base = np.concatenate([[0], np.cumsum(size)[:-1]])
    offs, wins = np.array(offs), np.array(wins)
    lead = offs % block
    n_sym = (size - lead) // block
    # symbols: block hashes as dense numbers above the separators 0..contexts-1
    ctx_of = np.repeat(np.arange(len(raws)), n_sym)
    within = np.arange(len(ctx_of)) - np.repeat(np.cumsum(n_sym) - n_sym, n_sym)
    start = base[ctx_of] + lead[ctx_of] + within * block
    prefix = _prefix_hash(data)
    _, names = np.unique(_span_hash(prefix, start, start + block), return_inverse=True)
    n = len(raws)
    text = np.empty(len(ctx_of) + n, dtype=np.int64)
    slot = np.arange(len(ctx_of)) + ctx_of
    text[slot] = names + n
    text[np.cumsum(n_sym + 1) - 1] = np.arange(n)
    sa = np.array(suffix_array(text.tolist()), dtype=np.int64)
    # suffixes that agree on all the whole symbols of a window
    need = (length - block + 1) // block
    padded = np.concatenate([text, -1 - np.arange(need)])
    same = np.ones(len(sa) - 1, dtype=bool)
    for t in range(need):
        column = padded[sa + t]
        same &= column[1:] == column[:-1]
    run_id = np.concatenate([[0], np.cumsum(~same)])
    crowd = np.bincount(run_id)[run_id] > 1
    symbol_at = np.full(len(text), -1, dtype=np.int64)
    symbol_at[slot] = np.arange(len(ctx_of))
    sym = symbol_at[sa]
    crowd &= sym >= 0
    sym, run_id = sym[crowd], run_id[crowd]
    marks = [np.zeros(w, dtype=bool) for w in wins]
    if not len(sym):
        return marks
    ctx = ctx_of[sym]
    at = lead[ctx] + within[sym] * block          # byte position inside the context
    steps = np.arange(block)
    s = at[:, None] - steps[None, :]
    ok = (s >= 0) & (s < wins[ctx][:, None])
    row, col = np.nonzero(ok)
    s, ctx, run_id = s[row, col], ctx[row], run_id[row]
    shift = (s - offs[ctx] + (1 << 31)).astype(np.uint64)
    where = base[ctx] + s
    key = TA.mix(_span_hash(prefix, where, where + length) ^ TA.mix((run_id.astype(np.uint64) << np.uint64(32)) ^ shift))
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    hit = count[inverse] > 1
    first = np.concatenate([[0], np.cumsum(wins)])
    flat = np.zeros(first[-1], dtype=bool)
    flat[first[ctx[hit]] + s[hit]] = True
    return [flat[a:b] for a, b in zip(first[:-1], first[1:])]


def _marker(length: int, block: int):
    """Suffix-sort the contexts of whole anchor groups, about ``SYMBOLS`` symbols at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, symbols, anchor = [], 0, None

        def close():
            marks = _mark([x[2] for x in held], [x[3] for x in held], [x[4] for x in held], length, block)
            keep = [i for i, m in enumerate(marks) if m.any()]
            return pa.RecordBatch.from_arrays(
                [pa.array([held[i][0] for i in keep], pa.int64()), pa.array([held[i][1] for i in keep], pa.int64()),
                 pa.array([np.packbits(marks[i]).tobytes() for i in keep], pa.binary())], ["anchor", "ctx", "mask"])

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("anchor", "ctx", "off", "wins", "raw")]
            for x in zip(*cols):
                if x[0] != anchor:
                    if symbols >= SYMBOLS:
                        yield close()
                        held, symbols = [], 0
                    anchor = x[0]
                held.append(x)
                symbols += len(x[4]) // block + 1
        if held:
            yield close()
    return run


def _window_rows(length: int):
    """(h1, h2, anchor, ctx, win) of every window of contexts of crowded anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("anchor", "ctx", "off", "wins", "raw")]
            for anchor, ctx, off, wins, raw in zip(*cols):
                prefix = _prefix_hash(np.frombuffer(raw, np.uint8))
                s = np.arange(wins)
                h = _span_hash(prefix, s, s + length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(s - off, pa.int64()),
                     pa.array(np.full(wins, anchor), pa.int64()),
                     pa.array(np.full(wins, ctx), pa.int64()), pa.array(s, pa.int32())],
                    ["h", "shift", "anchor", "ctx", "win"])
    return run


def _cut(length: int):
    """Remove the marked bytes of each text and digest what is left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, runs, copies = batch.column("text"), batch.column("runs"), batch.column("copies").to_pylist()
            out = []
            for i in range(batch.num_rows):
                raw = (texts[i].as_py() or "").encode()
                n = len(raw)
                if copies[i] and copies[i] > 1 and n >= length:
                    out.append((n, n, 1, hashlib.sha256(b"").hexdigest()))
                    continue
                found = runs[i].as_py()
                if not found:
                    out.append((n, 0, 0, hashlib.sha256(raw).hexdigest()))
                    continue
                depth = np.zeros(n + 1, dtype=np.int64)
                for x in found:
                    if x["mask"] is None:
                        depth[x["lo"]] += 1
                        depth[x["lo"] + x["wins"] - 1 + length] -= 1
                    else:
                        s = x["lo"] + np.flatnonzero(np.unpackbits(np.frombuffer(x["mask"], np.uint8))[:x["wins"]])
                        np.add.at(depth, s, 1)
                        np.add.at(depth, s + length, -1)
                gone = np.cumsum(depth[:-1]) > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                out.append((n, int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
            cols = list(zip(*out)) if out else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in cols[:3]), pa.array(cols[3], pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return run


def remove_repeats(spark: SparkSession, docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                   block: int = BLOCK, max_contexts: int = MAX_CONTEXTS) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Texts are told apart by a pair of 64-bit hashes.
    """
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"), "text")
    long = d.where(F.octet_length("text") >= length)
    copies = saved(spark, long.groupBy("k1", "k2").agg(F.count("*").alias("copies"), F.min("doc_id").alias("rep")),
                   "copies")
    rows = saved(spark, long.select("k1", "k2", "text").mapInArrow(
        _anchor_rows(length, gram), "anchor long, ctx long, k1 long, k2 long, lo long, wins int, off int"), "anchors")
    place = F.xxhash64("k1", "k2", "lo", "ctx")
    shared = saved(spark, rows.groupBy("anchor").agg(F.min(place).alias("a"), F.max(place).alias("b"))
                   .where("a < b").select(F.col("anchor").alias("shared")), "shared-anchors")
    repeated = saved(spark, rows.join(shared, F.col("anchor") == F.col("shared")).drop("shared").distinct(), "repeated")
    # equal contexts collapse; one place of each stands for all
    classes = repeated.groupBy("anchor", "ctx").agg(
        F.min(F.struct("k1", "k2", "lo", "wins", "off")).alias("at"), F.count("*").alias("places"))
    classes = saved(spark, classes, "contexts")
    crowd = saved(spark, classes.groupBy("anchor").agg(F.count("*").alias("n_ctx")).where("n_ctx > 1"), "crowds")
    wants = (
        classes.join(crowd, "anchor")
        .groupBy(F.col("at.k1").alias("w1"), F.col("at.k2").alias("w2"))
        .agg(F.collect_list(F.struct("anchor", "ctx", "n_ctx", "at.lo", "at.wins", "at.off")).alias("want"))
        .join(copies.select(F.col("k1").alias("w1"), F.col("k2").alias("w2"), "rep"), ["w1", "w2"])
    )
    contexts = (
        long.join(wants, (F.col("k1") == F.col("w1")) & (F.col("k2") == F.col("w2"))
                  & F.col("doc_id").eqNullSafe(F.col("rep")))
        .dropDuplicates(["w1", "w2"]).select("text", "want")
        .mapInArrow(_contexts(length), "anchor long, ctx long, n_ctx long, wins long, off long, raw binary")
    )
    contexts = saved(spark, contexts, "context-bytes")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    masks = (
        contexts.where(F.col("n_ctx") <= max_contexts).repartition(n, "anchor").sortWithinPartitions("anchor")
        .mapInArrow(_marker(length, block), "anchor long, ctx long, mask binary")
    )
    windows = contexts.where(F.col("n_ctx") > max_contexts).mapInArrow(
        _window_rows(length), "h long, shift long, anchor long, ctx long, win int")
    met = windows.groupBy("h", "shift", "anchor").agg(F.min("ctx").alias("x"), F.max("ctx").alias("y")) \
        .where("x < y").select("h", "shift", "anchor")
    crowded = windows.join(met, ["h", "shift", "anchor"]).groupBy("anchor", "ctx").agg(
        F.collect_set("win").alias("wins_met"))
    masks = masks.withColumn("wins_met", F.lit(None).cast("array<int>")).unionByName(
        crowded.withColumn("mask", F.lit(None).cast("binary")))
    masks = saved(spark, masks, "masks")
    verdict = saved(spark, classes.join(masks, ["anchor", "ctx"], "left").select(
        F.col("anchor").alias("va"), F.col("ctx").alias("vc"), (F.col("places") > 1).alias("every"),
        "mask", "wins_met").where("every or mask is not null or wins_met is not null"), "verdicts")
    runs = (
        repeated.join(verdict, (F.col("anchor") == F.col("va")) & (F.col("ctx") == F.col("vc")))
        .select("k1", "k2", "lo", "wins", F.when(~F.col("every"), F.col("mask")).alias("mask"),
                F.when(~F.col("every"), F.col("wins_met")).alias("wins_met"))
    )
    # windows of crowded anchors as runs of one window each
    single = runs.where("wins_met is not null").withColumn("win", F.explode("wins_met")).select(
        "k1", "k2", (F.col("lo") + F.col("win")).alias("lo"), F.lit(1).alias("wins"),
        F.lit(None).cast("binary").alias("mask"))
    runs = runs.where("wins_met is null").drop("wins_met").unionByName(single)
    per_text = runs.groupBy(F.col("k1").alias("r1"), F.col("k2").alias("r2")).agg(
        F.collect_list(F.struct("lo", "wins", "mask")).alias("runs"))
    state = copies.where("copies > 1").select(F.col("k1").alias("r1"), F.col("k2").alias("r2"), "copies").join(
        per_text, ["r1", "r2"], "full")
    state = saved(spark, state.select("r1", "r2", "copies", F.when(F.coalesce("copies", F.lit(0)) < 2, F.col("runs"))
                                      .alias("runs")), "runs")
    return (
        d.join(state, (F.col("k1") == F.col("r1")) & (F.col("k2") == F.col("r2")), "left")
        .select("doc_id", "text", "copies", "runs")
        .mapInArrow(_cut(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    )
