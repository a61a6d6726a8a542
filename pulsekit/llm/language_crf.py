"""Operator 5: language of texts by a linear-chain conditional random field over words.

Every word (run of letters or non-ASCII bytes, lower case) gets an emission
score per language from hashed features: the word itself (lexicon), prefixes,
suffixes and three-byte strings. Transitions between the languages of
neighbouring words are learned with them. Posteriors of every word come from
forward-backward over the whole text, so code-switched texts are labelled word
by word; the text's language is the one with the greatest posterior mass and
its score the share of that mass.

Training (one task): maximum likelihood by AdaGrad on word sequences of a
sample of at most about ``PER_LANG`` documents a language, words labelled with
the document's language; some sequences join pieces of two documents, from
which switches are learned. Counts and predictions cover all rows.

Defined results: ``und`` with score 0 for null texts and texts without a
letter, and for all texts when nothing can be learned; only the ``MAX_LANGS``
most frequent languages are learned; of several rows of a doc_id and language the
least text is learned from; a null doc_id is never learned from and not held out;
of equally likely languages the alphabetically first is taken; a text is labelled whole,
in memory of its words x languages; repeated rows get equal results; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.llm import textarrays as TA
from pulsekit.llm.sampling import bounded_sample, fold

PER_LANG = 500
MAX_LANGS = 200
BUCKETS = 1 << 17
PREFIXES, SUFFIXES, GRAM = (1, 2, 3), (2, 3, 4), 3
SEQUENCE = 24
EPOCHS = 4
SWITCHED = 0.3            # share of training sequences that join two documents
TOGETHER_BYTES = 12 << 20  # texts labelled together
_NOT_WORD = np.ones(256, dtype=bool)
_NOT_WORD[list(b"abcdefghijklmnopqrstuvwxyz")] = False
_NOT_WORD[128:] = False


def _words(c: TA.Chunk):
    """Words of a chunk and, for each, the index of its distinct word, with that word's place."""
    w = TA.words_of(c, _NOT_WORD)
    h = TA.hash_spans(c.data, w.start, w.end - w.start)
    _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    return w, inverse, w.start[first], w.end[first] - w.start[first]


def _features(c: TA.Chunk, start, length):
    return TA.subword_ids(c.data, start, length, BUCKETS, PREFIXES, SUFFIXES, GRAM)


def forward_backward(emission: np.ndarray, transition: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Word posteriors of many sequences at once.

    ``emission``: words x labels (log scores), sequence i being words
    ``first[i] : first[i] + count[i]``; the start is uniform.
    """
    e = np.exp(emission - emission.max(1, keepdims=True))
    a = np.exp(transition - transition.max())
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    steps = int(count[0]) if len(count) else 0
    live = np.searchsorted(-count, -np.arange(steps), side="left")  # sequences longer than the step
    alpha = np.empty_like(e)
    prev = None
    for t in range(steps):
        at = first[:live[t]] + t
        x = e[at] if prev is None else (prev[:live[t]] @ a) * e[at]
        prev = x / x.sum(1, keepdims=True)
        alpha[at] = prev
    out = alpha
    beta = np.ones((len(count), e.shape[1]), dtype=e.dtype)
    for t in range(steps - 2, -1, -1):
        n = live[t + 1]
        at = first[:n] + t
        x = (beta[:n] * e[at + 1]) @ a.T
        beta[:n] = x / x.sum(1, keepdims=True)
        p = alpha[at] * beta[:n]
        out[at] = p / p.sum(1, keepdims=True)
    return out


def _pairwise(emission, transition, lens):
    """Posteriors of padded sequences (batch x steps x labels) and expected transitions."""
    batch, steps, n = emission.shape
    e = np.exp(emission - emission.max(2, keepdims=True))
    a = np.exp(transition - transition.max())
    alpha, beta = np.empty_like(e), np.ones_like(e)
    alpha[:, 0] = e[:, 0] / e[:, 0].sum(1, keepdims=True)
    for t in range(1, steps):
        x = (alpha[:, t - 1] @ a) * e[:, t]
        alpha[:, t] = x / x.sum(1, keepdims=True)
    expected = np.zeros((n, n))
    for t in range(steps - 2, -1, -1):
        x = (beta[:, t + 1] * e[:, t + 1]) @ a.T
        inside = (t + 1 < lens)[:, None]
        beta[:, t] = np.where(inside, x / x.sum(1, keepdims=True), 1.0)
        xi = alpha[:, t][:, :, None] * a[None] * (beta[:, t + 1] * e[:, t + 1])[:, None, :]
        xi /= xi.sum((1, 2), keepdims=True)
        expected += (xi * inside[:, :, None]).sum(0)
    p = alpha * beta
    return p / p.sum(2, keepdims=True), expected


def _fit(texts: pa.Array, labels: list[str], epochs: int = EPOCHS) -> dict:
    rng = np.random.default_rng(5)
    names = sorted(set(labels))
    y = np.array([names.index(x) for x in labels])
    # sequences: words of the sample cut into pieces, some glued to a piece of another text
    owner, ids, base, word_of, label_of = [], [], 0, [], []
    for c in TA.text_chunks(texts):
        w, inverse, start, length = _words(c)
        o, f = _features(c, start, length)
        owner.append(o + base)
        ids.append(f)
        word_of.append(inverse + base)
        label_of.append(np.stack([y[c.lo + w.text], c.lo + w.text], axis=1))
        base += len(start)
    owner, ids = np.concatenate(owner), np.concatenate(ids)
    word, tag = np.concatenate(word_of), np.concatenate(label_of)
    if not len(word):
        return {"names": names}
    bounds = np.searchsorted(owner, np.arange(base + 1))
    half = SEQUENCE // 2
    cut = np.flatnonzero(np.concatenate([[True], tag[1:, 1] != tag[:-1, 1]]))
    ends = np.append(cut[1:], len(word))
    pieces = np.array([(s, min(s + half, b)) for a, b in zip(cut, ends) for s in range(a, b, half)])
    n = len(names)
    table, trans = np.zeros((BUCKETS, n)), np.zeros((n, n))
    gt, gtr = np.full((BUCKETS, n), 1e-6), np.full((n, n), 1e-6)
    batch = 256
    for _ in range(epochs):
        order = rng.permutation(len(pieces))
        for at in range(0, len(order), batch):
            mine = order[at:at + batch]
            follow = np.minimum(mine + 1, len(pieces) - 1)
            other = np.where(rng.random(len(mine)) < SWITCHED, rng.permutation(mine), follow)
            left, right = pieces[mine], pieces[other]
            lens = (left[:, 1] - left[:, 0]) + (right[:, 1] - right[:, 0])
            steps = int(lens.max())
            col = np.arange(steps)[None, :]
            in_left = col < (left[:, 1] - left[:, 0])[:, None]
            pos = np.where(in_left, left[:, :1] + col, right[:, :1] + col - (left[:, 1] - left[:, 0])[:, None])
            valid = col < lens[:, None]
            pos = np.where(valid, pos, 0)
            seen, inverse = np.unique(word[pos], return_inverse=True)
            inverse = inverse.reshape(pos.shape)
            n_feat = bounds[seen + 1] - bounds[seen]
            who = np.repeat(np.arange(len(seen)), n_feat)
            fid = ids[np.repeat(bounds[seen] - np.concatenate([[0], np.cumsum(n_feat)[:-1]]), n_feat)
                      + np.arange(n_feat.sum())]
            score = TA.group_sums(who, table[fid], len(seen)) / n_feat[:, None] * 4
            emission = np.where(valid[:, :, None], score[inverse], 0.0)
            post, expected = _pairwise(emission, trans, lens)
            truth = np.eye(n)[tag[pos, 0]]
            grad = np.where(valid[:, :, None], post - truth, 0.0)
            by_word = TA.group_sums(inverse.ravel(), grad.reshape(-1, n), len(seen)) / n_feat[:, None] * 4
            uniq, fi = np.unique(fid, return_inverse=True)
            d = TA.group_sums(fi, by_word[who], len(uniq)) / len(mine) + 1e-5 * table[uniq]
            gt[uniq] += d ** 2
            table[uniq] -= 0.3 * d / np.sqrt(gt[uniq])
            pairs = np.zeros((n, n))
            both = valid[:, 1:]
            np.add.at(pairs, (tag[pos[:, :-1], 0][both], tag[pos[:, 1:], 0][both]), 1)
            dt = (expected - pairs) / len(mine)
            gtr += dt ** 2
            trans -= 0.1 * dt / np.sqrt(gtr)
    return {"names": names, "table": (table * 4).astype(np.float32), "transition": trans.astype(np.float32)}


def _trainer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = pd.concat(list(batches), ignore_index=True)
    if not len(rows):
        return
    rows = rows.sort_values(["draw", "doc_id"], kind="stable")
    yield pd.DataFrame({"model": [pickle.dumps(_fit(pa.array(rows["text"].fillna("")), rows["lang"].tolist()))]})


def _emissions(c: TA.Chunk, table: np.ndarray):
    w, inverse, start, length = _words(c)
    owner, fid = _features(c, start, length)
    n_feat = np.maximum(np.bincount(owner, minlength=len(start)), 1)
    scores = TA.group_sums(owner, table[fid], len(start)) / n_feat[:, None]
    return w.count, scores[inverse].astype(np.float32)


def word_posteriors(texts: pa.Array, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors (words x languages) of the words of lower-case texts, and words per text."""
    counts, parts = [], []
    for c in TA.text_chunks(texts):
        n, e = _emissions(c, model["table"])
        counts.append(n)
        parts.append(e)
    count, e = np.concatenate(counts), np.concatenate(parts)
    first = np.concatenate([[0], np.cumsum(count)[:-1]]).astype(np.int64)
    has = count > 0
    return forward_backward(e, model["transition"], first[has], count[has]), count


def _labeller(broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = broadcast.value
        names = np.array(model["names"], dtype=object)
        for batch in batches:
            letters = batch.column("letters")
            texts = batch.column("text")
            for c in TA.text_chunks(texts, TOGETHER_BYTES):
                post, count = word_posteriors(texts.slice(c.lo, c.n), model)
                mass = TA.group_sums(np.repeat(np.arange(c.n), count), post, c.n)
                ok = (count > 0) & np.array(letters.slice(c.lo, c.n).to_pylist(), dtype=bool)
                best = mass.argmax(1)
                score = np.where(ok, mass[np.arange(c.n), best] / np.maximum(count, 1), 0.0)
                part = batch.slice(c.lo, c.n)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.where(ok, names[best], "und").tolist(), pa.string()),
                     pa.array(np.clip(score, 0, 1)), pa.array(count.astype(np.int64))],
                    ["doc_id", "lang_pred", "score", "n_words"])
    return run


def fit(spark: SparkSession, docs: DataFrame, per_lang: int = PER_LANG) -> dict | None:
    """Fit on rows outside fold 0 with a language; None when there are none."""
    rows = docs.where("lang is not null and text is not null").where(fold() != 0).select(
        "doc_id", F.lower("text").alias("text"), F.col("lang").cast("string").alias("lang"))
    chosen, counts = bounded_sample(rows, "lang", per_lang, MAX_LANGS)
    if not counts:
        return None
    # one row of each doc_id and language, so that repeated rows cannot swell the sample
    got = chosen.groupBy("doc_id", "lang").agg(F.min("text").alias("text")) \
        .select("doc_id", "text", "lang", F.xxhash64("doc_id", F.lit(11)).alias("draw")) \
        .repartition(1).mapInPandas(_trainer, "model binary").collect()
    model = pickle.loads(got[0]["model"]) if got else None
    return model if model and "table" in model else None


def identify(spark: SparkSession, docs: DataFrame, per_lang: int = PER_LANG, model: dict | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, n_words."""
    model = model or fit(spark, docs, per_lang)
    held = F.coalesce(fold() == 0, F.lit(False)).alias("held_out")
    if model is None:
        return docs.select("doc_id", held, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(0).cast("long").alias("n_words"))
    rows = docs.select("doc_id", F.lower("text").alias("text"),
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    out = rows.mapInArrow(_labeller(spark.sparkContext.broadcast(model)),
                          "doc_id long, lang_pred string, score double, n_words long")
    return out.select("doc_id", held, "lang_pred", "score", "n_words")
