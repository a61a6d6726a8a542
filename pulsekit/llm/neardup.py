"""MinHash banding: candidate groups, exact verification on whole n-gram sets, classes.

Shared by the document join and the paragraph dedup. Items are identified by
the 64-bit hash of their text, so equal texts are one item from the start and a
hot text never fills a bucket.

Plan: (1) each item's band hashes go out as (bucket, id) rows; buckets keep only
their least and greatest id, combined before the shuffle; (2) rows of buckets
with two different items link the item to the bucket's least id, and the
components of these links are the candidate groups; (3) each group is cut into
blocks of ``BLOCK`` items and every pair of blocks is one unit of work that
compares the full n-gram sets by a matrix product and returns one row per item
(links, spanning edge), never the pairs; (4) components of the verified edges.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.llm import textarrays as TA
from pulsekit.llm.components import connected_components
from pulsekit.llm.storage import discard, saved

SHINGLE_WORDS = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.9999
BLOCK = 256
COLUMNS = 4096
PARTS = 8                # parts of packed keys a shuffle partition
PACKED_KEYS = "part long, buckets binary, ids binary, units binary"
SMALL = 16               # units of up to so many items are verified together,
SMALL_LOAD = 1 << 19     # until they hold about so many grams
_SEEDS = TA.mix(np.arange(1, 1025, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))


def choose_bands(threshold: float = THRESHOLD, target_recall: float = TARGET_RECALL,
                 max_hashes: int = 96) -> tuple[int, int]:
    """(bands, rows): the most selective banding (most rows) whose recall at
    ``threshold`` reaches the target within the hash budget."""
    best = None
    for rows in range(1, 33):
        bands = math.ceil(math.log1p(-target_recall) / math.log1p(-threshold ** rows))
        if bands * rows <= max_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("no banding reaches the target recall within max_hashes")
    return best


def band_hashes(grams: np.ndarray, owner: np.ndarray, bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes (items x bands, signed) of the items that have grams, and those items."""
    if not len(grams):
        return np.zeros((0, bands), np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    out = np.empty((len(first), bands), dtype=np.uint64)
    mixed = np.empty_like(grams)
    for b in range(bands):
        h = np.full(len(first), b, dtype=np.uint64)
        for r in range(rows):
            i = 2 * (b * rows + r)
            np.bitwise_xor(grams, _SEEDS[i % 1024], out=mixed)
            np.multiply(mixed, _SEEDS[(i + 1) % 1024] | np.uint64(1), out=mixed)
            h = h * np.uint64(0x9FB21C651E98DF25) + np.minimum.reduceat(mixed, first)
        out[:, b] = TA.mix(h + np.uint64(b))
    return out.view(np.int64), owner[first]


def candidate_groups(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Candidate groups of band rows (bucket, id): table (id, grp, size) of the items that share a bucket."""
    buckets = saved(spark, rows.groupBy("bucket").agg(F.min("id").alias("hub"), F.max("id").alias("top"))
                    .where("hub < top").select("bucket", "hub"), "buckets")
    links = rows.join(buckets, "bucket").where("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b"))
    groups = saved(spark, connected_components(spark, links).withColumnRenamed("comp", "grp"), "groups")
    sizes = saved(spark, groups.groupBy("grp").agg(F.count("*").alias("size")), "group-sizes")
    return saved(spark, groups.join(sizes, "grp"), "candidates")


def _hub_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows in the order of their buckets, a link from every other item of a bucket to its first."""
    bucket = hub = before = None
    for batch in batches:
        b, ids = batch.column("bucket").to_numpy(), batch.column("id").to_numpy()
        if not len(b):
            continue
        new = np.concatenate([[b[0] != bucket], b[1:] != b[:-1]])
        first = np.where(new, np.arange(len(b)), -1)
        first = np.maximum.accumulate(first)
        hubs = np.where(first >= 0, ids[first], 0 if hub is None else hub)
        again = np.concatenate([[not new[0] and ids[0] == before], (ids[1:] == ids[:-1]) & ~new[1:]])
        keep = (ids != hubs) & ~again
        bucket, hub, before = b[-1], hubs[-1], ids[-1]
        yield pa.RecordBatch.from_arrays([pa.array(ids[keep]), pa.array(hubs[keep])], ["a", "b"])


def key_parts(spark: SparkSession) -> int:
    """Parts of packed keys: several to a shuffle partition, so that partitions are even and a part is small."""
    return PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))


def packed_keys(held: list, n_parts: int) -> pa.RecordBatch:
    """Arrays (buckets, ids of the buckets' items, unit ids) as one row (part, buckets, ids, units) of each part."""
    def cut(key, *values):
        part = (key.view(np.uint64) % np.uint64(n_parts)).astype(np.int64)
        order = np.argsort(part.astype(np.uint16) if n_parts <= 1 << 16 else part, kind="stable")
        return [x[order] for x in (key, *values)], np.bincount(part, minlength=n_parts)

    bucket, ids, units = (np.concatenate(x) for x in zip(*held))
    (bucket, ids), n = cut(bucket, ids)
    (units,), m = cut(units)
    row = np.flatnonzero(n + m)
    return pa.RecordBatch.from_arrays(
        [pa.array(row), TA.binary_array(bucket, n[row]), TA.binary_array(ids, n[row]), TA.binary_array(units, m[row])],
        ["part", "buckets", "ids", "units"])


def _part_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From packed keys in the order of their parts: the links of the buckets, and a link to itself of each unit id
    that comes up again."""
    def close(held):
        bucket, ids, units = (np.frombuffer(b"".join(x), np.int64) for x in zip(*held))
        order = np.argsort(bucket)
        rows = pa.RecordBatch.from_arrays([pa.array(bucket[order]), pa.array(ids[order])], ["bucket", "id"])
        yield from _hub_links(iter([rows]))
        units = np.sort(units)
        again = pa.array(np.unique(units[1:][units[1:] == units[:-1]]))
        yield pa.RecordBatch.from_arrays([again, again], ["a", "b"])

    part, held = None, []
    for batch in batches:
        cols = [batch.column(x) for x in ("buckets", "ids", "units")]
        for at, p in enumerate(batch.column("part").to_pylist()):
            if p != part and held:
                yield from close(held)
                held = []
            part = p
            held.append(tuple(x[at].as_buffer() for x in cols))
    if held:
        yield from close(held)


def linked_groups(spark: SparkSession, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``candidate_groups``, from packed keys shuffled once, and the table (id) of the unit ids that come up again.

    The makers of ``rows`` send an item's rows once a task, so a hot item is at most
    a row a task in each of its buckets.
    """
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    links = saved(spark, rows.repartition(n, "part").sortWithinPartitions("part").mapInArrow(
        _part_links, "a long, b long"), "links")
    often = saved(spark, links.where("a = b").select(F.col("a").alias("id")), "often")
    groups = saved(spark, connected_components(spark, links).withColumnRenamed("comp", "grp"), "groups")
    discard(spark, links)
    sizes = saved(spark, groups.groupBy("grp").agg(F.count("*").alias("size")), "group-sizes")
    out = saved(spark, groups.join(sizes, "grp"), "candidates")
    discard(spark, groups, sizes)
    return out, often


def _similar(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Boolean matrix of pairs of sets with Jaccard similarity of at least ``threshold``."""
    n = len(sets)
    size = np.array([len(s) for s in sets], dtype=np.float64)
    value, col = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(n), size.astype(np.int64))
    shared = np.bincount(col, minlength=len(value)) > 1  # a gram of one set adds to no intersection
    keep = shared[col]
    row, col = row[keep], (np.cumsum(shared) - 1)[col[keep]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    inter = np.zeros((n, n), dtype=np.float64)
    width = int(shared.sum())
    for c in range(0, width, COLUMNS):
        a, b = np.searchsorted(col, [c, c + COLUMNS])
        m = np.zeros((n, min(COLUMNS, width - c)), dtype=np.float32)
        m[row[a:b], col[a:b] - c] = 1
        inter += m @ m.T
    union = size[:, None] + size[None, :] - inter
    similar = inter >= threshold * union - 1e-9
    np.fill_diagonal(similar, False)
    return similar


def _verify_unit(ids, weights, side, sets, diagonal: bool, threshold: float):
    """Links and spanning labels of one pair of blocks."""
    similar = _similar(sets, threshold)
    if not diagonal:
        similar &= side[:, None] != side[None, :]
    links = similar @ weights
    label = ids.copy()
    top = np.iinfo(np.int64).max
    while True:
        low = np.minimum(label, np.where(similar, label[None, :], top).min(axis=1))
        if (low == label).all():
            break
        label = low
    keep = links > 0
    return ids[keep], links[keep], label[keep]


def _verify_small(units: list, threshold: float):
    """Links and spanning labels of many units of at most ``SMALL`` items, each one the only block of its group.

    The n-gram sets of all are sorted together; ``inter[i, j]`` counts what item i shares with the j-th item of its unit.
    """
    count = np.array([len(u[0]) for u in units])
    ids, weights, size, grams = (np.concatenate([u[i] for u in units]) for i in (0, 1, 3, 4))
    n = len(ids)
    unit = np.repeat(np.arange(len(units)), count)
    head = (np.cumsum(count) - count)[unit]
    place = np.arange(n) - head
    row = np.repeat(np.arange(n), size)
    # grams of different units are told apart by a mark (and by the check of the unit below)
    value = grams ^ TA.mix(unit[row].astype(np.uint64))
    order = np.argsort(value)
    value, row = value[order], row[order]
    inter = np.zeros(n * SMALL)
    at, step = np.arange(len(value)), 0
    while at.size:
        step += 1
        at = at[at + step < len(value)]
        at = at[value[at] == value[at + step]]
        x, y = row[at], row[at + step]
        own = unit[x] == unit[y]
        x, y = x[own], y[own]
        inter += np.bincount(np.concatenate([x * SMALL + place[y], y * SMALL + place[x]]), minlength=n * SMALL)
    inter = inter.reshape(n, SMALL)
    j = np.arange(SMALL)[None, :]
    there = j < count[unit][:, None]
    other = np.where(there, head[:, None] + j, 0)
    similar = there & (j != place[:, None]) & (
        inter >= threshold * (size[:, None] + size[other] - inter) - 1e-9)
    links = np.where(similar, weights[other], 0).sum(axis=1)
    label = ids.copy()
    top = np.iinfo(np.int64).max
    while True:
        low = np.minimum(label, np.where(similar, label[other], top).min(axis=1))
        if (low == label).all():
            break
        label = low
    keep = links > 0
    return ids[keep], links[keep], label[keep]


def _verifier(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small, load = [], 0   # small units wait for each other
        key, many, held = None, False, []

        def out(got, multi):
            return pa.RecordBatch.from_arrays(
                [pa.array(got[0]), pa.array(got[1].astype(np.int64)), pa.array(got[2]),
                 pa.array([multi] * len(got[0]), pa.bool_())], ["id", "links", "root", "multi"])

        def close():
            nonlocal small, load
            unit = held[0] if len(held) == 1 else [np.concatenate(x) for x in zip(*held)]
            if len(unit[0]) < 2:
                return
            if many or len(unit[0]) > SMALL:
                ids, weights, side, size, grams = unit
                yield out(_verify_unit(ids, weights.astype(np.float64), side, np.split(grams, np.cumsum(size)[:-1]),
                                       key[1] == key[2], threshold), many)
                return
            small.append([x.copy() for x in unit])  # not to hold the batches they came in
            load += len(unit[4]) + SMALL * len(unit[0])
            if load >= SMALL_LOAD:
                yield out(_verify_small(small, threshold), False)
                small, load = [], 0

        for batch in batches:
            if not batch.num_rows:
                continue
            g, bi, bj, ids, weight, block, blocks = (
                batch.column(c).to_numpy() for c in ("grp", "bi", "bj", "id", "weight", "block", "blocks"))
            column = batch.column("grams").cast(pa.large_binary())
            _, off, buf = column.buffers()
            offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1] // 8
            grams = np.frombuffer(buf, np.uint64, buf.size // 8) if buf is not None and buf.size else np.zeros(0, np.uint64)
            size = np.diff(offsets)
            new = np.ones(len(g), dtype=bool)
            new[1:] = (g[1:] != g[:-1]) | (bi[1:] != bi[:-1]) | (bj[1:] != bj[:-1])
            cuts = np.append(np.flatnonzero(new), len(g))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if key != (g[a], bi[a], bj[a]):
                    if held:
                        yield from close()
                    key, many, held = (g[a], bi[a], bj[a]), bool(blocks[a] > 1), []
                held.append((ids[a:b], weight[a:b], block[a:b], size[a:b], grams[offsets[a]:offsets[b]]))
        if held:
            yield from close()
        if small:
            yield out(_verify_small(small, threshold), False)
    return run


def verified_classes(spark: SparkSession, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Verify candidate items and return (id, comp, links) of the items that have a link.

    ``items``: id, grp, size, weight (documents that carry the text), grams
    (binary: sorted distinct uint64). ``links`` sums the weights of the linked items.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    work = (
        items.withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("id", F.lit(7)), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("grp", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"),
                "id", "weight", "block", "blocks", "grams")
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    units = work.repartition(n, "grp", "bi", "bj").sortWithinPartitions("grp", "bi", "bj")
    found = saved(spark, units.mapInArrow(_verifier(threshold), "id long, links long, root long, multi boolean"),
                  "verified")
    links = found.groupBy("id").agg(F.sum("links").alias("links"), F.min("root").alias("root"),
                                    F.max("multi").alias("multi"))
    wide = connected_components(spark, found.where("multi").select(F.col("id").alias("a"), F.col("root").alias("b")))
    return saved(spark, links.join(wide, "id", "left").select(
        "id", F.coalesce("comp", "root").alias("comp"), "links"), "classes")
