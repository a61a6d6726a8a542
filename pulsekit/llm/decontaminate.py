"""Operator 4: benchmark decontamination by spaced seeds.

Words are runs of letters and digits in lower case. Each fixed mask hashes only
the words at its marked positions, so a substituted word at an unmarked
position does not hide a match. Seeds of texts and benchmark items are joined;
every hit fixes an alignment, and the aligned words around it are compared: an
item leaks into a text when some aligned window of min(item length, ``WINDOW``)
words agrees in at least ``AGREE`` of its places.

Seeds of texts are first held against a bitmap of the benchmark's seeds (a
fixed ``2**BITMAP_BITS`` bits, however large the benchmark), so only likely
hits are shuffled; the join itself is exact.

Items of fewer than ``MIN_ITEM`` words are found only by all their words in a row,
unchanged, and only if they say enough to tell a copy from common speech: at least
``SHORT_WORDS`` words, or ``SHORT_BYTES`` bytes in words (scripts without spaces).
Items shorter than that are not searched; ``unsearchable`` lists them.

Defined results: null and empty texts have no hits; equal items count once each by their
item_id; the longest verified overlap is reported, ties by more equal words, then
the later place; very long texts are searched whole, in memory proportional to them; copies of a text get the same result; a null doc_id comes back null;
an empty benchmark leaves every document clean; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.llm import textarrays as TA
from pulsekit.llm.storage import saved

# The masks (six of seven to ten positions). Wherever the substitutions that AGREE allows stand in 10 to
# 15 words, one of the masks has a place without any.
MASKS = ("11011011", "1110010101", "1010110011", "1111101", "110001111", "101110011")
MIN_ITEM = 10
SHORT_WORDS, SHORT_BYTES = 5, 21
WINDOW = 15
AGREE = 0.8
BITMAP_BITS = 26
_NOT_WORD = np.ones(256, dtype=bool)
_NOT_WORD[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = False
_NOT_WORD[128:] = False


def _words(c: TA.Chunk):
    w = TA.words_of(c, _NOT_WORD)
    return w, TA.word_hashes(c, w)


def _seeds(w: TA.Words, h: np.ndarray, lengths: tuple[int, ...]):
    """(word count of a short item or 0, seed, word index of its start) for every mask, and every length of a short
    item, and every start whose span stays in one text."""
    n = len(h)
    masks = [(0, m + 1, mask) for m, mask in enumerate(MASKS)] + [(x, 100 + x, "1" * x) for x in lengths]
    for short, tag, mask in masks:
        span = len(mask)
        if n < span:
            continue
        g = np.full(n - span + 1, tag, dtype=np.uint64)
        for j, on in enumerate(mask):
            if on == "1":
                g = g * np.uint64(0xC2B2AE3D27D4EB4F) + h[j:n - span + 1 + j]
        at = np.flatnonzero(w.text[:n - span + 1] == w.text[span - 1:])
        yield short, TA.mix(g[at]), at


def _seed_rows(lengths: tuple[int, ...], bitmap=None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if bitmap is None else bitmap.value
        for batch in batches:
            key = batch.column("key").to_numpy()
            for c in TA.text_chunks(batch.column("text")):
                w, h = _words(c)
                for short, seed, at in _seeds(w, h, lengths):
                    if bits is not None:
                        slot = (seed & np.uint64((1 << BITMAP_BITS) - 1)).astype(np.int64)
                        ok = (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
                        seed, at = seed[ok], at[ok]
                    elif len(seed):
                        count = w.count[w.text[at]]
                        ok = count == short if short else count >= MIN_ITEM
                        seed, at = seed[ok], at[ok]
                    t = w.text[at]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(seed.view(np.int64)), pa.array(key[c.lo:c.hi][t]),
                         pa.array((at - w.first[t]).astype(np.int64))], ["seed", "key", "pos"])
    return run


def _short_lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts of the items that are too short for the masks."""
    for batch in batches:
        for c in TA.text_chunks(batch.column("text")):
            n = np.unique(_words(c)[0].count)
            yield pa.RecordBatch.from_arrays([pa.array(n[(n > 0) & (n < MIN_ITEM)].astype(np.int32))], ["n"])


def _told_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The items with a flag: long enough to be searched."""
    for batch in batches:
        for c in TA.text_chunks(batch.column("text")):
            w = _words(c)[0]
            size = np.bincount(w.text, (w.end - w.start).astype(np.float64), minlength=c.n)
            part = batch.slice(c.lo, c.n)
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), part.column("text"), pa.array((w.count >= SHORT_WORDS) | (size >= SHORT_BYTES))],
                ["key", "text", "searched"])


def _items(benchmark: DataFrame) -> DataFrame:
    """(key, text, searched) of the different items; key is the hash of the text as given."""
    items = benchmark.where("text is not null").select(F.xxhash64("text").alias("key"), F.lower("text").alias("text"))
    return items.dropDuplicates(["key"]).mapInArrow(_told_apart, "key long, text string, searched boolean")


def unsearchable(benchmark: DataFrame) -> DataFrame:
    """(item_id) of the items too short to be searched, null texts included."""
    short = _items(benchmark).where("not searched").select(F.col("key").alias("skey"))
    named = benchmark.select("item_id", F.xxhash64("text").alias("tkey"), F.col("text").isNull().alias("none"))
    return named.join(short, F.col("tkey") == F.col("skey"), "left").where("none or skey is not null").select("item_id")


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """Bitmap of the seeds: at most 2**BITMAP_BITS / 64 words reach the driver."""
    slot = F.col("seed").bitwiseAND((1 << BITMAP_BITS) - 1)
    words = seeds.groupBy(F.shiftright(slot, 6).alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast((seed & {(1 << BITMAP_BITS) - 1}) & 63 AS int))")).alias("bits")).toArrow()
    bits = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.int64)
    bits[words.column("at").to_numpy()] = words.column("bits").to_numpy()
    return bits.view(np.uint8)


def aligned_overlap(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int]:
    """Words of the item inside agreeing windows at this alignment: (overlap, equal words, first word in doc)."""
    n = min(len(item), WINDOW)
    lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
    if hi - lo < n:
        return 0, 0, 0
    equal = (doc[lo + shift:hi + shift] == item[lo:hi]).astype(np.int64)
    total = np.concatenate([[0], np.cumsum(equal)])
    good = np.flatnonzero(total[n:] - total[:-n] >= AGREE * n - 1e-9)
    if not len(good):
        return 0, 0, 0
    depth = np.zeros(len(equal) + 1, dtype=np.int64)
    np.add.at(depth, good, 1)
    np.add.at(depth, good + n, -1)
    inside = np.cumsum(depth[:-1]) > 0
    return int(inside.sum()), int(equal[inside].sum()), int(good[0] + lo + shift)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for key, text, items in zip(batch.column("key").to_pylist(), batch.column("text"), batch.column("items")):
            items = items.as_py()
            hashes = []
            for x in (text.as_py(), *(y["text"] for y in items)):
                c = next(TA.text_chunks(pa.array([x], pa.string())))
                hashes.append(_words(c)[1])
            for x, item in zip(items, hashes[1:]):
                best = max(aligned_overlap(hashes[0], item, s) for s in x["shifts"])
                if best[0]:
                    out.append((key, x["item"], *best, len(item)))
        cols = list(zip(*out)) if out else [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cols],
                                         ["key", "item", "overlap", "equal", "start", "item_words"])


def leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(key, item, overlap, equal, start, item_words): verified overlaps of distinct texts (key: text hash) and items."""
    items = saved(spark, _items(benchmark).where("searched").drop("searched"), "items")
    seeds = saved(spark, items.mapInArrow(_seed_rows(tuple(range(1, MIN_ITEM))), "seed long, key long, pos long").select(
        "seed", F.col("key").alias("item"), F.col("pos").alias("at")), "item-seeds")
    bitmap = spark.sparkContext.broadcast(_bitmap(seeds))
    lengths = tuple(r.n for r in items.mapInArrow(_short_lengths, "n int").distinct().collect())  # at most MIN_ITEM - 1
    texts = docs.where("text is not null").select(F.xxhash64("text").alias("key"), "doc_id",
                                                  F.lower("text").alias("text"))
    found = texts.select("key", "text").mapInArrow(_seed_rows(lengths, bitmap), "seed long, key long, pos long")
    hits = saved(spark, found.join(seeds, "seed").select("key", "item", (F.col("pos") - F.col("at")).alias("shift"))
                 .distinct(), "hits")
    near = hits.groupBy("key", "item").agg(F.collect_list("shift").alias("shifts"))
    wanted = near.join(items.select(F.col("key").alias("item"), F.col("text")), "item").groupBy("key").agg(
        F.collect_list(F.struct("item", "text", "shifts")).alias("items"))
    # one row of each text that has hits; the key holds doc_id so that copies spread over the partitions
    rep = texts.select("key", "doc_id").join(hits.select("key").distinct(), "key").groupBy("key").agg(
        F.min("doc_id").alias("rdoc"))
    wanted = wanted.join(rep, "key").withColumnRenamed("key", "wkey")
    rows = texts.join(wanted, (F.col("key") == F.col("wkey")) & F.col("doc_id").eqNullSafe(F.col("rdoc"))) \
        .dropDuplicates(["wkey"]).select("key", "text", "items")
    return saved(spark, rows.mapInArrow(
        _verify, "key long, item long, overlap long, equal long, start long, item_words long"), "leaks")


def find_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, contaminated, n_items, item_ids (sorted), max_overlap (words)."""
    found = leaks(spark, docs, benchmark)
    names = benchmark.where("text is not null").select(F.xxhash64("text").alias("item"), "item_id")
    per_text = found.join(names, "item").groupBy(F.col("key").alias("tkey")).agg(
        F.array_sort(F.collect_list("item_id")).alias("item_ids"), F.max("overlap").alias("max_overlap"))
    keyed = docs.select("doc_id", F.xxhash64("text").alias("key"), F.col("text").isNotNull().alias("has"))
    return keyed.join(per_text, (F.col("key") == F.col("tkey")) & F.col("has"), "left").select(
        "doc_id", F.col("tkey").isNotNull().alias("contaminated"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
        F.coalesce("max_overlap", F.lit(0)).cast("long").alias("max_overlap"))


def drop_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) without a verified overlap with a benchmark item."""
    found = saved(spark, leaks(spark, docs, benchmark).select("key").distinct(), "leaked")
    return docs.join(found, docs["text"].isNotNull() & (F.xxhash64(docs["text"]) == found["key"]), "left_anti")
