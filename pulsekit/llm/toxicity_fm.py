"""Operator 2: toxicity scores from a factorization machine over hashed terms.

A text is the set of its lower-case terms (runs of ASCII letters and digits or
non-ASCII bytes). A term's weight and factor vector are sums over its hashed
features (the term, prefixes, suffixes, inner byte strings), so unseen terms
that share parts with known ones still score. The score is

    sigmoid(b + sum_t w_t + 1/(2n) sum_f ((sum_t v_tf)^2 - sum_t v_tf^2)),

the second sum being the pairwise interactions of the n terms, each entering
with 1/sqrt(n). Features of fewer than ``MIN_PAIRS`` (text, term) pairs of the
sample are not learned. The machine is fitted
by AdaGrad with soft-thresholded linear weights in one task, on a sample of at
most about ``PER_LABEL`` labelled documents of either label; everything else
(label counts, scoring) covers all rows. The parameters returned are the mean
over the steps of the second half of the epochs: single steps of long texts move
thousands of terms at once, and the last one alone would decide for whole kinds
of texts. Sampled rows are weighted back to the true label shares, and label 1
counts ``MISS_WEIGHT`` times, so a missed toxic text costs as much as that many
clean texts flagged.

Defined results: null and empty texts have no terms and score the intercept;
without both labels in the learning folds the score is the share of label 1 (0
if there are no labels); several labels of a doc_id count as the greatest, and
of several rows of a labelled doc_id the least text is learned from; a null doc_id is
never learned from and not held out; very long texts are scored whole, in memory
proportional to them; a score of exactly 0.5 counts as toxic; repeated rows get equal
scores; an empty table gives an empty table; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.llm import textarrays as TA
from pulsekit.llm.sampling import bounded_sample, fold

PER_LABEL = 3000
BUCKETS = 1 << 18
FACTORS = 4
PREFIXES, SUFFIXES, GRAM = (3, 5, 6, 7), (4,), 5
EPOCHS = 12
MISS_WEIGHT = 4.0
MIN_PAIRS = 10
_NOT_TERM = np.ones(256, dtype=bool)
_NOT_TERM[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = False
_NOT_TERM[128:] = False


def _terms(c: TA.Chunk):
    """Distinct (text, term) pairs of a chunk and its distinct terms.

    Returns text of each pair, term index of each pair, and start and length of each term.
    """
    w = TA.words_of(c, _NOT_TERM)
    h = TA.word_hashes(c, w)
    term, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    pair = np.unique(w.text * np.int64(max(len(term), 1)) + inverse)
    return (pair // max(len(term), 1), pair % max(len(term), 1), term,
            w.start[first], w.end[first] - w.start[first])


def _features(c: TA.Chunk, start, length):
    return TA.subword_ids(c.data, start, length, BUCKETS, PREFIXES, SUFFIXES, GRAM)


class _Sample:
    """Terms of the sample: texts x distinct terms x features, built chunk by chunk."""

    def __init__(self, texts: pa.Array):
        rows, cols, known, ids, counts, base = [], [], {}, [], [], 0
        for c in TA.text_chunks(texts):
            text, term, name, start, length = _terms(c)
            owner, feats = _features(c, start, length)
            bounds = np.searchsorted(owner, np.arange(len(name) + 1))
            place = np.empty(len(name), np.int64)
            for j, key in enumerate(name.tolist()):
                at = known.get(key)
                if at is None:
                    at = known[key] = len(counts)
                    part = feats[bounds[j]:bounds[j + 1]]
                    ids.append(part)
                    counts.append(len(part))
                place[j] = at
            rows.append(text + c.lo)
            cols.append(place[term])
        self.row, self.col = np.concatenate(rows), np.concatenate(cols)
        self.ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)

    def keep(self, able: np.ndarray) -> None:
        """Forget the features that are not ``able``."""
        kept = able[self.ids]
        self.bounds = np.concatenate([[0], np.cumsum(kept)])[self.bounds]
        self.ids = self.ids[kept]


def _ranges(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    n = stop - start
    return np.repeat(start - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())


def _fit(texts: pa.Array, y: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS) -> dict:
    rng = np.random.default_rng(7)
    s = _Sample(texts)
    order = np.argsort(s.row, kind="stable")
    col = s.col[order]
    text_at = np.searchsorted(s.row[order], np.arange(len(y) + 1))
    w = np.zeros(BUCKETS)
    pairs_of_term = np.bincount(col, minlength=len(s.bounds) - 1)
    learned = np.bincount(s.ids, np.repeat(pairs_of_term, np.diff(s.bounds)), minlength=BUCKETS) >= MIN_PAIRS
    s.keep(learned)
    v = rng.normal(0, 0.02, (BUCKETS, FACTORS)) * learned[:, None]
    gw, gv = np.full(BUCKETS, 1e-3), np.full((BUCKETS, FACTORS), 1e-4)
    share = float(np.average(y, weights=weight))
    b = math.log(share / (1 - share))
    rate, l1, batch = 0.15, 3e-3, 64
    mean_w, mean_v, mean_b, steps = np.zeros_like(w), np.zeros_like(v), 0.0, 0
    for epoch in range(epochs):
        mixed = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            rows = mixed[at:at + batch]
            picked = _ranges(text_at[rows], text_at[rows + 1])
            n_terms = text_at[rows + 1] - text_at[rows]
            who = np.repeat(np.arange(len(rows)), n_terms)
            term, inverse = np.unique(col[picked], return_inverse=True)
            fid = s.ids[_ranges(s.bounds[term], s.bounds[term + 1])]
            owner = np.repeat(np.arange(len(term)), s.bounds[term + 1] - s.bounds[term])
            tw = np.bincount(owner, w[fid], minlength=len(term))
            tv = TA.group_sums(owner, v[fid], len(term))
            sv = TA.group_sums(who, tv[inverse], len(rows))
            sq = np.bincount(who, (tv ** 2).sum(1)[inverse], minlength=len(rows))
            z = b + np.bincount(who, tw[inverse], minlength=len(rows)) + 0.5 * ((sv ** 2).sum(1) - sq) / np.maximum(n_terms, 1)
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            g = (p - y[rows]) * weight[rows] / weight[rows].mean()
            b -= 0.02 * g.mean()
            gt = np.bincount(inverse, g[who], minlength=len(term))
            gn = g / np.maximum(n_terms, 1)
            gtv = TA.group_sums(inverse, gn[who, None] * sv[who], len(term)) \
                - np.bincount(inverse, gn[who], minlength=len(term))[:, None] * tv
            ids = np.flatnonzero(np.bincount(fid, minlength=BUCKETS))
            dw = np.bincount(fid, gt[owner], minlength=BUCKETS)[ids] / len(rows)
            dv = TA.group_sums(fid, gtv[owner], BUCKETS)[ids] / len(rows) + 1e-4 * v[ids]
            gw[ids] += dw ** 2
            gv[ids] += dv ** 2
            step = rate / np.sqrt(gw[ids])
            new = w[ids] - step * dw
            w[ids] = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0)
            v[ids] -= np.clip(0.02 / np.sqrt(gv[ids]) * dv, -0.05, 0.05)
            if 2 * epoch >= epochs:
                mean_w += w
                mean_v += v
                mean_b, steps = mean_b + b, steps + 1
    return {"b": mean_b / steps, "w": (mean_w / steps).astype(np.float32), "v": (mean_v / steps).astype(np.float32)}


def _trainer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = pd.concat(list(batches), ignore_index=True)
    if rows["label"].nunique() < 2:
        return
    rows = rows.sort_values(["draw", "doc_id"], kind="stable")
    label = rows["label"].to_numpy(float)
    weight = np.where(label == 1, MISS_WEIGHT, 1.0) / rows["rate"].to_numpy(float)
    model = _fit(pa.array(rows["text"].fillna("")), label, weight)
    yield pd.DataFrame({"model": [pickle.dumps(model)]})


def _scorer(broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = broadcast.value
        for batch in batches:
            for c in TA.text_chunks(batch.column("text")):
                text, term, name, start, length = _terms(c)
                owner, fid = _features(c, start, length)
                tw = np.bincount(owner, model["w"][fid], minlength=len(name))
                tv = TA.group_sums(owner, model["v"][fid], len(name))
                z = model["b"] + np.bincount(text, tw[term], minlength=c.n)
                sv = TA.group_sums(text, tv[term], c.n)
                sq = np.bincount(text, (tv ** 2).sum(1)[term], minlength=c.n)
                z = z + 0.5 * ((sv ** 2).sum(1) - sq) / np.maximum(np.bincount(text, minlength=c.n), 1)
                score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                part = batch.slice(c.lo, c.n)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(x) for x in part.schema.names if x != "text"), pa.array(score)],
                    [*(x for x in part.schema.names if x != "text"), "score"])
    return run


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> dict:
    """Fit on labelled rows outside fold 0; a dict with only ``b`` when both labels are not there."""
    one = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label")) \
        .where(fold() != 0)
    chosen, counts = bounded_sample(one, "label", per_label, 2)
    n = sum(counts.values())
    if len(counts) < 2:
        share = counts.get(1, 0) / n if n else 0.0
        return {"b": 30.0 if share else -30.0}
    chosen = chosen.select(F.col("doc_id").alias("lid"), "label", "rate",
                           F.xxhash64("doc_id", F.lit(11)).alias("draw"))
    # bounded by per_label rows of each label (in expectation), so it is sent to every task
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("lid")).groupBy("doc_id", "label", "rate", "draw").agg(
        F.lower(F.min("text")).alias("text"))
    got = rows.repartition(1).mapInPandas(_trainer, "model binary").collect()
    if not got:
        return {"b": math.log(max(counts.get(1, 0), 1) / max(counts.get(0, 0), 1))}
    return pickle.loads(got[0]["model"])


def score_texts(spark: SparkSession, docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, k1, k2, score) for every row; k1, k2 are hashes of the text."""
    d = docs.select("doc_id", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"),
                    F.lower("text").alias("text"))
    if "w" not in model:
        score = 1 / (1 + math.exp(-model["b"])) if abs(model["b"]) < 30 else float(model["b"] > 0)
        return d.select("doc_id", "k1", "k2", F.lit(score).alias("score"))
    return d.mapInArrow(_scorer(spark.sparkContext.broadcast(model)), "doc_id long, k1 long, k2 long, score double")


def score_toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored = score_texts(spark, docs, fit(spark, docs, labels, per_label))
    return scored.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(spark: SparkSession, docs: DataFrame, labelled: DataFrame, labels: DataFrame,
               per_label: int = PER_LABEL) -> DataFrame:
    """The rows of ``docs`` (all columns) that score below 0.5; ``labelled`` holds the texts of ``labels``."""
    model = fit(spark, labelled, labels, per_label)
    if "w" not in model:
        return docs.where(F.lit(model["b"] < 0))
    held = docs.select(F.lower("text").alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    kinds = docs.schema.simpleString().removeprefix("struct")
    scored = held.mapInArrow(_scorer(spark.sparkContext.broadcast(model)), f"row struct{kinds}, score double")
    return scored.where("score < 0.5").select("row.*")
