"""Resampling by splitting counts down a tree of index bins.

n draws from a group are first dealt to bins of its users, and only then drawn
inside a bin. Users lie in bins by the first bits of a hash of their key. The
root of the tree holds all n draws of a replicate; a node passes a binomial
(with replacement) or hypergeometric (without) share to its left half, so the
leaves get exactly the counts that n single draws would give. Only these counts,
(replicate, group, bin), meet the bins' values in a shuffle: no draw is ever a
row, and no task holds more than one bin of at most 1/4,096 of a large group.

Every random number is a hash of (seed, group, replicate, node or bin, draw):
the same under any partitioning and after lost executors. One md5 a replicate
seeds a counter-based 32-bit generator (a Weyl sequence through a finalizer),
which SQL can repeat.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.functions.columns import stable_hash32

BIN_USERS = 16    # a group gets bins until they hold about so many users,
MAX_BITS = 12     # at most 4,096
CHUNK = 256       # replicates whose counts travel together
# Counter step (2^32 / golden ratio), finalizer multipliers, bin step.
STEP, MULT_1, MULT_2, BIN_STEP = 0x9E3779B9, 0x85EBCA6B, 0xC2B2AE35, 0x7FEB352D
_BLOCK = 1 << 21  # elements handled at once


def mix32(x: np.ndarray) -> np.ndarray:
    """32-bit finalizer: xor-shift and multiply, twice."""
    x = x.astype(np.uint32)
    x = (x ^ (x >> np.uint32(16))) * np.uint32(MULT_1)
    x = (x ^ (x >> np.uint32(13))) * np.uint32(MULT_2)
    return x ^ (x >> np.uint32(16))


def node_uniform(base: np.ndarray, node: np.ndarray) -> np.ndarray:
    """52-bit uniform of a replicate's tree node."""
    at = base.astype(np.uint64) + node.astype(np.uint64) * np.uint64(2 * STEP)
    high, low = mix32(at & np.uint64(0xFFFFFFFF)), mix32((at + np.uint64(STEP)) & np.uint64(0xFFFFFFFF))
    return (high.astype(np.float64) * 2.0 ** 20 + (low >> np.uint32(12))) / 2.0 ** 52


def draw_index(base: np.ndarray, bin_: int, j: np.ndarray, size: int) -> np.ndarray:
    """Index 0..size-1 of draw ``j`` in a bin."""
    start = mix32((mix32(base).astype(np.uint64) + np.uint64((bin_ + 1) * BIN_STEP)) & np.uint64(0xFFFFFFFF))
    x = mix32((start.astype(np.uint64) + j.astype(np.uint64) * np.uint64(STEP)) & np.uint64(0xFFFFFFFF))
    return ((x.astype(np.uint64) * np.uint64(size)) >> np.uint64(32)).astype(np.int64)


def left_share(u: np.ndarray, m: np.ndarray, left: np.ndarray, total: np.ndarray, replace: bool) -> np.ndarray:
    """How many of ``m`` draws fall on ``left`` of ``total`` users: the inverse
    distribution at ``u`` (least k with P(X <= k) >= u).

    Probabilities come from the ratio of neighbours over nine deviations around
    the mean and are divided by their sum (the rest is below 1e-17).
    """
    out = np.where(left == total, m, 0).astype(np.int64)
    todo = np.flatnonzero((left > 0) & (left < total) & (m > 0))
    m, left, total, u = (x[todo].astype(np.float64) for x in (m, left, total, u))
    p = left / total
    spread = m * p * (1 - p) * (1.0 if replace else (total - m) / np.maximum(total - 1, 1))
    half = np.ceil(9 * np.sqrt(spread)) + 10
    low = np.maximum(0.0 if replace else np.maximum(0, m - (total - left)), np.floor(m * p) - half)
    high = np.minimum(m if replace else np.minimum(m, left), np.floor(m * p) + half)
    order = np.argsort(high - low, kind="stable")
    at = 0
    while at < len(order):
        width = int((high - low)[order[at]]) + 1
        rows = order[at:at + max(1, _BLOCK // max(width, 64))]
        width = int((high - low)[rows].max()) + 1
        k = low[rows, None] + np.arange(width - 1)
        mm, ll, tt = m[rows, None], left[rows, None], total[rows, None]
        if replace:
            ratio = (mm - k) / (k + 1) * (ll / (tt - ll))
        else:
            # beyond the support the divisor may vanish; those cells are cut off below
            ratio = (mm - k) * (ll - k) / ((k + 1) * np.where((rest := tt - ll - mm + k + 1) > 0, rest, 1))
        ratio[k >= high[rows, None]] = 0
        weight = np.cumprod(np.concatenate([np.ones((len(rows), 1)), ratio], axis=1), axis=1)
        below = np.cumsum(weight, axis=1)
        below /= below[:, -1:]
        out[todo[rows]] = np.minimum(low[rows] + (below < u[rows, None]).sum(axis=1), high[rows])
        at += len(rows)
    return out


def bin_counts(sizes: np.ndarray, n: int, base: np.ndarray, replace: bool) -> np.ndarray:
    """Draws per (replicate, bin): ``n`` a replicate, dealt over bins of ``sizes`` users (a power of two of them)."""
    bits = len(sizes).bit_length() - 1
    tree = [np.asarray(sizes, dtype=np.int64)]
    while len(tree[0]) > 1:
        tree.insert(0, tree[0].reshape(-1, 2).sum(axis=1))
    counts = np.full((len(base), 1), n, dtype=np.int64)
    for level in range(bits):
        width = 1 << level
        node = np.broadcast_to(np.arange(width, 2 * width), counts.shape)
        m, live = counts.ravel(), np.flatnonzero(counts.ravel() > 0)
        seeds = np.repeat(base, width)[live]
        total = np.broadcast_to(tree[level], counts.shape).ravel()[live]
        left = np.broadcast_to(tree[level + 1][::2], counts.shape).ravel()[live]
        share = np.zeros(len(m), dtype=np.int64)
        share[live] = left_share(node_uniform(seeds, node.ravel()[live]), m[live], left, total, replace)
        share = share.reshape(counts.shape)
        counts = np.stack([share, counts - share], axis=2).reshape(len(base), 2 * width)
    return counts


def pick_distinct(base: np.ndarray, bin_: int, want: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, index): the first ``want`` different indices of each row's draws, by draw number."""
    n = len(base)
    budget = want + want // 2 + 8
    while True:
        row = np.repeat(np.arange(n), budget)
        j = np.arange(len(row)) - np.repeat(np.cumsum(budget) - budget, budget)
        idx = draw_index(np.repeat(base, budget), bin_, j, size)
        _, first = np.unique(row * size + idx, return_index=True)
        first.sort()  # first comings in draw order, row by row
        have = np.bincount(row[first], minlength=n)
        short = have < want
        if not short.any():
            rank = np.arange(len(first)) - np.repeat(np.cumsum(have) - have, have)
            first = first[rank < want[row[first]]]
            return row[first], idx[first]
        budget = np.where(short, 2 * budget, budget)  # more draws of the same sequence; the first ones stay


def sum_inside(bin_, size, columns, replicates, bases, counts):
    """Sums of the values drawn with replacement, per replicate."""
    ends = np.cumsum(counts)
    j = np.arange(int(ends[-1])) - np.repeat(ends - counts, counts)
    idx = draw_index(np.repeat(bases, counts), bin_, j, size)
    return [replicates, *[np.add.reduceat(c[idx], ends - counts) for c in columns]]


def moments_inside(bin_, size, columns, replicates, bases, counts):
    """Count, sum and sum of squares of the users drawn without replacement, per iteration."""
    v = columns[0]
    rest = counts > size - counts  # more than half of the bin: draw the users left out
    want = np.where(rest, size - counts, counts)
    row, idx = pick_distinct(bases, bin_, want, size)
    n = len(bases)
    s1, s2 = (np.bincount(row, x[idx], minlength=n) for x in (v, v * v))
    s1, s2 = np.where(rest, v.sum() - s1, s1), np.where(rest, (v * v).sum() - s2, s2)
    return [replicates, counts, s1, s2]


def group_bits(largest: int) -> int:
    """Bits of the bin number for groups of at most ``largest`` users."""
    bits = 0
    while bits < MAX_BITS and BIN_USERS << bits < largest:
        bits += 1
    return bits


def _bin(key: str, bits: int):
    return F.shiftright(stable_hash32(key), 32 - bits).cast("int")


def bin_sizes(vals: DataFrame, group: str, key: str) -> tuple[int, dict]:
    """(bits, users per bin by group). At most 4,096 rows a group reach the driver."""
    rows = vals.groupBy(group, _bin(key, MAX_BITS).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    fine: dict = {}
    for r in rows:
        fine.setdefault(r[group], np.zeros(1 << MAX_BITS, dtype=np.int64))[r["b"]] += r["n"]
    bits = group_bits(max((int(x.sum()) for x in fine.values()), default=0))
    return bits, {g: x.reshape(1 << bits, -1).sum(axis=1) for g, x in fine.items()}


def _deal(sizes: dict, draws: dict, replace: bool, group_type: pa.DataType):
    groups = list(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            replicate = batch.column("replicate").to_numpy()
            for number, g in enumerate(groups):
                bases = batch.column(f"base_{number}").to_numpy()
                for at in range(0, len(replicate), CHUNK):
                    reps, base = replicate[at:at + CHUNK], bases[at:at + CHUNK]
                    counts = bin_counts(sizes[g], draws[g], base, replace)
                    used = np.flatnonzero(counts.any(axis=0))
                    some = [np.flatnonzero(counts[:, b]) for b in used]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([g] * len(used), group_type), pa.array(used, pa.int32()),
                         pa.array([reps[i] for i in some], pa.list_(pa.int64())),
                         pa.array([base[i] for i in some], pa.list_(pa.int64())),
                         pa.array([counts[i, b] for i, b in zip(some, used)], pa.list_(pa.int64()))],
                        ["_g", "_b", "replicates", "bases", "counts"])
    return run


def split_draws(vals: DataFrame, group: str, key: str, columns: list[str], replicates: int, draws, seed: int,
                replace: bool, inside: Callable, schema: str) -> DataFrame:
    """Deal ``draws`` (a number per group, from its size) of every replicate over the
    bins and run ``inside`` on each bin with its counts.

    ``inside(bin, size, columns, replicates, bases, counts)`` gets the bin's values,
    ordered by (hash of key, key), and the replicates that draw from it; it returns
    arrays for ``schema``, to which the group is added as ``_g``.
    """
    bits, sizes = bin_sizes(vals, group, key)
    spark = vals.sparkSession
    kind = vals.schema[group].dataType
    if not sizes:
        return spark.createDataFrame([], T.StructType([T.StructField("_g", kind)])).select("*", *[
            F.lit(None).cast(t).alias(c) for c, t in (x.strip().split(" ") for x in schema.split(","))])
    wanted = {g: int(draws(int(x.sum()))) for g, x in sizes.items()}
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    grid = spark.range(0, replicates, 1, parts).select(F.col("id").alias("replicate"), *[
        stable_hash32(seed, F.lit(g).cast("string"), "replicate").alias(f"base_{i}") for i, g in enumerate(sizes)])
    from pyspark.sql.pandas.types import to_arrow_type
    counts = grid.mapInArrow(
        _deal(sizes, wanted, replace, to_arrow_type(kind)),
        f"_g {kind.simpleString()}, _b int, replicates array<long>, bases array<long>, counts array<long>")
    bins = (
        vals.select(F.col(group).alias("_g"), _bin(key, bits).alias("_b"),
                    F.struct(stable_hash32(key).alias("_h"), F.col(key).alias("_k"), *columns).alias("_v"))
        .groupBy("_g", "_b").agg(F.sort_array(F.collect_list("_v")).alias("_v"))  # a bin of one group
        .select("_g", "_b", *[F.col(f"_v.{c}").alias(c) for c in columns])
    )
    # a counts row is a bin of a chunk of replicates; merge joins neither side whole
    met = counts.hint("merge").join(bins.hint("merge"), ["_g", "_b"])
    names = [x.strip().split(" ")[0] for x in schema.split(",")]

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                at = {c: batch.column(c)[i] for c in batch.schema.names}
                lists = {c: at[c].values.to_numpy(zero_copy_only=False)
                         for c in ("replicates", "bases", "counts", *columns)}
                size = len(lists[columns[0]])
                weight = np.cumsum(np.maximum(lists["counts"], 1))
                edge = np.searchsorted(weight, np.arange(0, weight[-1], _BLOCK) + 1)
                for a, b in zip(edge, [*edge[1:], len(weight)]):
                    if a < b:
                        out = inside(at["_b"].as_py(), size, [lists[c] for c in columns], lists["replicates"][a:b],
                                     lists["bases"][a:b], lists["counts"][a:b])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([at["_g"].as_py()] * len(out[0]), batch.schema.field("_g").type),
                             *[pa.array(x) for x in out]], ["_g", *names])
    return met.mapInArrow(draw, f"_g {kind.simpleString()}, {schema}")


# Python workers need only numpy and pyarrow, not this package: ship the module by value.
import sys as _sys  # noqa: E402

from pyspark import cloudpickle as _cloudpickle  # noqa: E402

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
