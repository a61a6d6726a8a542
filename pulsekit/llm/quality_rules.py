"""Operator 9: quality rules whose cutoffs come with a bound on false rejections.

Base rules on word counts and repetition are fixed. On top, every rule score
(higher is worse) gets a cutoff per stratum (language): labelled documents of
quality 1 are the holdout, and a cutoff is certified when the exact binomial
test rejects "more than its share of alpha of the good documents of this stratum fall at or
beyond it". Within a stratum and rule the fixed grid is tested from the mildest
cutoff on and testing stops at the first failure (fixed sequence); across rules
and strata the level is divided (Bonferroni), and alpha is divided over the
rules so that their union stays below alpha. All certified cutoffs hold at once with
probability 1 - delta, so any choice among them keeps the guarantee: the one that
rejects the most bad documents per good one is used, the mildest on ties; a rule that
finds no bad documents is not used.

A trial is a document: of the rows of a doc_id one counts (least text hash), and of
documents with one text and stratum one counts (with the least quality), so copies
and repeated rows certify nothing that the documents alone do not.

Defined results: null text has no words (and fails the base rules); documents
without a label (or without a doc_id) take no part in calibration; strata without a certified cutoff
reject nothing by it; a null language is a stratum of its own; several labels
of a doc_id count as one with the least quality; ties between cutoffs go to the
mildest; texts of any length are measured whole, in memory proportional to them;
empty tables give empty tables; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from pulsekit.llm import textarrays as TA
from pulsekit.llm.sampling import log_binomial_tail
from pulsekit.llm.storage import saved

ALPHA = 0.02
DELTA = 0.05
WINDOW_WORDS = 8
_RATES = [0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05]
# Cutoff grids, mildest first; a document is rejected at score >= cutoff.
GRIDS = {
    "symbol_rate": [2.0, 1.5, 1.0, *_RATES],
    "dup_line_rate": _RATES,
    "repeat_rate": _RATES,
    "upper_rate": _RATES,
    "mean_word_length": [40.0, 30.0, 25.0, 20.0, 18.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.0],
    "mark_rate": [3.0, 2.5, 2.0, 1.5, 1.2, 1.0, *_RATES[:8]],
}
_IS = {name: np.zeros(256, dtype=bool) for name in ("symbol", "upper", "mark")}
_IS["symbol"][list(b"#*$%&|<>")] = True
_IS["upper"][list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
_IS["mark"][list(b"#*$%&|<>!?=+~^_@{}[]\\/")] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _counts(c: TA.Chunk, k: int) -> list[np.ndarray]:
    data = c.data[:c.size]
    w = TA.words_of(c)
    # code points in words: bytes that do not continue a character, outside separators
    chars = _per_text(((data & 0xC0) != 0x80) & ~TA.SEPARATOR[data], c.offsets)
    # lines with a word; a line equal to an earlier one of its text is a repeat
    newline = np.flatnonzero(data == 0x0A)
    edge = np.unique(np.concatenate([c.offsets[:-1], newline + 1]))
    edge = edge[edge < c.size]
    owner = np.searchsorted(c.offsets, edge, side="right") - 1
    stop = np.append(edge[1:], c.size)
    stop = np.minimum(stop, c.offsets[owner + 1])
    ends_in_newline = (stop > edge) & (c.data[np.maximum(stop - 1, 0)] == 0x0A)
    length = stop - edge - ends_in_newline
    word_total = np.searchsorted(w.start, edge + length) - np.searchsorted(w.start, edge)
    real = word_total > 0
    edge, owner, length = edge[real], owner[real], length[real]
    salt = TA.mix(np.arange(c.n, dtype=np.uint64) + np.uint64(17))
    lines = np.bincount(owner, minlength=c.n)
    _, first = np.unique(TA.hash_spans(c.data, edge, length) ^ salt[owner], return_index=True)
    dup_lines = lines - np.bincount(owner[first], minlength=c.n)
    # words inside k-word windows found twice or more in the text
    n = len(w.start)
    repeat = np.zeros(c.n, dtype=np.int64)
    if n >= k:
        h = TA.word_hashes(c, w)
        g = h[:n - k + 1].copy()
        for j in range(1, k):
            g = g * np.uint64(0xC2B2AE3D27D4EB4F) + h[j:n - k + 1 + j]
        ok = np.flatnonzero(w.text[:n - k + 1] == w.text[k - 1:])
        _, inverse, count = np.unique(TA.mix(g[ok]) ^ salt[w.text[ok]], return_inverse=True, return_counts=True)
        twice = ok[count[inverse] > 1]
        depth = np.zeros(n + 1, dtype=np.int64)
        np.add.at(depth, twice, 1)
        np.add.at(depth, twice + k, -1)
        covered = np.cumsum(depth[:-1]) > 0
        repeat = np.bincount(w.text[covered], minlength=c.n)
    return [w.count, chars, _per_text(_IS["symbol"][data], c.offsets), dup_lines, repeat, lines,
            _per_text(_IS["upper"][data], c.offsets), _per_text(_IS["mark"][data], c.offsets)]


def _measure(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in TA.text_chunks(batch.column("text")):
                part = batch.slice(c.lo, c.n)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("stratum"), part.column("key")]
                    + [pa.array(x.astype(np.int64)) for x in _counts(c, k)], ["doc_id", "stratum", "key", *COUNTS])
    return run


def _p_values(alpha: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs = [log_binomial_tail(n, k, alpha) if k <= alpha * n else 0.0
                    for n, k in zip(batch.column("n_good").to_pylist(), batch.column("good_hit").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(logs, pa.float64())],
                                             [*batch.schema.names, "log_p"])
    return run


def _scores() -> dict[str, Column]:
    words = F.greatest("n_words", F.lit(1))
    return {
        "symbol_rate": F.col("n_symbols") / words,
        "dup_line_rate": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeat_rate": F.col("n_repeat_words") / words,
        "upper_rate": F.col("n_upper") / F.greatest("word_chars", F.lit(1)),
        "mean_word_length": F.col("word_chars") / words,
        "mark_rate": F.col("n_marks") / words,
    }


def _levels() -> Column:
    """How many cutoffs of each rule's grid the document reaches, by rule."""
    scores = _scores()
    return F.array(*[
        F.struct(F.lit(rule).alias("rule"),
                 sum((F.when(scores[rule] >= cut, 1).otherwise(0) for cut in grid), F.lit(0)).alias("level"))
        for rule, grid in GRIDS.items()])


def certified_cutoffs(spark: SparkSession, measured: DataFrame, labels: DataFrame, alpha: float = ALPHA,
                      delta: float = DELTA) -> DataFrame:
    """(stratum, rule, index): reject the stratum's documents that reach at least ``index`` of the rule's cutoffs
    (the whole grid: the mildest cutoff)."""
    one = labels.where("quality is not null").groupBy(F.col("doc_id").alias("lid")).agg(
        F.min("quality").alias("quality"))
    labelled = measured.join(one, F.col("doc_id") == F.col("lid"))
    per_doc = labelled.groupBy("doc_id").agg(F.min(F.struct("key", "stratum", "quality", *COUNTS)).alias("r")).select("r.*")
    trials = per_doc.groupBy("key", "stratum").agg(F.min(F.struct("quality", *COUNTS)).alias("r")).select("stratum", "r.*")
    long = (
        trials.select("stratum", "quality", F.explode(_levels()).alias("x"))
        .groupBy("stratum", F.col("x.rule").alias("rule"), F.col("x.level").alias("level"))
        .agg(F.sum(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
             F.sum(F.when(F.col("quality") == 0, 1).otherwise(0)).alias("bad"))
    )
    long = saved(spark, long, "levels")  # strata x rules x grid
    sizes = F.create_map(*[F.lit(x) for rule, grid in GRIDS.items() for x in (rule, len(grid))])
    cuts = long.select("stratum", "rule").distinct().withColumn("index", F.explode(F.sequence(F.lit(1), sizes[F.col("rule")])))
    hits = (
        cuts.join(long, ["stratum", "rule"]).groupBy("stratum", "rule", "index")
        .agg(F.sum("good").alias("n_good"),
             F.sum(F.when(F.col("level") >= F.col("index"), F.col("good")).otherwise(0)).alias("good_hit"),
             F.sum(F.when(F.col("level") >= F.col("index"), F.col("bad")).otherwise(0)).alias("bad_hit"))
    )
    n_strata = max(1, long.select("stratum").distinct().count())
    tested = hits.mapInArrow(
        _p_values(alpha / len(GRIDS)),
        "stratum string, rule string, index int, n_good long, good_hit long, bad_hit long, log_p double")
    path = Window.partitionBy("stratum", "rule").orderBy(F.desc("index")).rowsBetween(Window.unboundedPreceding, 0)
    passed = (
        tested.withColumn("ok", F.col("log_p") <= math.log(delta / (len(GRIDS) * n_strata)))
        .withColumn("certified", F.min("ok").over(path)).where("certified and bad_hit > 0")
        .withColumn("gain", F.col("bad_hit") - 5 * F.col("good_hit")).where("gain > 0")
    )
    return passed.groupBy("stratum", "rule").agg(F.max(F.struct("gain", "index")).alias("best")).select(
        "stratum", "rule", "best.index")


def apply_rules(spark: SparkSession, docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA,
                stratum: str = "lang", k: int = WINDOW_WORDS) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, kept, and failed_rules (names)."""
    measured = saved(spark, docs.select(
        "doc_id", F.coalesce(F.col(stratum).cast("string"), F.lit("\x00null")).alias("stratum"),
        F.xxhash64("text").alias("key"), "text").mapInArrow(
            _measure(k), "doc_id long, stratum string, key long, " + ", ".join(f"{c} long" for c in COUNTS)), "measured")
    chosen = saved(spark, certified_cutoffs(spark, measured, labels, alpha, delta)
                   .groupBy(F.col("stratum").alias("sname"))
                   .agg(F.collect_list(F.struct("rule", "index")).alias("cuts")), "cutoffs")
    failed = F.filter(F.col("levels"), lambda x: F.exists(
        F.col("cuts"), lambda c: (c["rule"] == x["rule"]) & (x["level"] >= c["index"])))
    out = (
        measured.withColumn("levels", _levels()).join(chosen, F.col("stratum") == F.col("sname"), "left")
        .withColumn("failed_rules", F.coalesce(F.transform(failed, lambda x: x["rule"]),
                                               F.array().cast("array<string>")))
        .withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    )
    return out.select("doc_id", *COUNTS[:5], "base_failed",
                      (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"), "failed_rules")
