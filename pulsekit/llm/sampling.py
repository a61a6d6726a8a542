"""Fold rule and bounded training samples shared by the learned operators."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the doc_id as text, mod 5; fold 0 is held out, null belongs to no fold."""
    return F.crc32(F.col(doc_id).cast("string")) % 5


def bounded_sample(rows: DataFrame, label: str, per_label: int, max_labels: int) -> tuple[DataFrame, dict]:
    """A sample of about ``per_label`` rows of each label, drawn by a hash of doc_id.

    Only label counts reach the driver (labels that come back: the ``max_labels``
    most frequent). Returns the rows with a ``rate`` column, and the counts.
    """
    counts = {r[0]: r[1] for r in rows.where(F.col(label).isNotNull()).groupBy(label).count()
              .orderBy(F.desc("count"), label).limit(max_labels).collect()}
    rate = F.lit(0.0)
    for value, n in counts.items():
        rate = F.when(F.col(label) == F.lit(value), F.lit(min(1.0, per_label / n))).otherwise(rate)
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    return rows.withColumn("rate", rate).where(draw < F.col("rate")), counts


def log_binomial_tail(n: int, k: int, p: float, block: int = 1 << 14) -> float:
    """log P(X <= k) for X ~ Binomial(n, p), summed from X = k down until nothing is left that counts.

    Going down, each term is a smaller part of the one above, so what is left
    below a term is at most a geometric series; its bound is added, which keeps the
    result an upper bound, exact to about 1e-15.
    """
    if k >= n:
        return 0.0
    if k < 0:
        return -math.inf
    top = (math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
           + k * math.log(p) + (n - k) * math.log1p(-p))
    total, scale, at = 1.0, 0.0, k  # in units of exp(top); scale is the log of the last term
    while at > 0:
        i = np.arange(at, max(at - block, 0), -1, dtype=np.float64)
        ratio = i * ((1 - p) / p) / (n - i + 1)  # of the term at i - 1 to the one at i
        logs = scale + np.cumsum(np.log(ratio))
        total += float(np.exp(logs).sum())
        scale, at = float(logs[-1]), at - len(i)
        r = at * ((1 - p) / p) / (n - at + 1)
        if r < 1 and (rest := math.exp(scale) * r / (1 - r)) < 1e-16 * total:
            total += rest
            break
    return min(0.0, top + math.log(total))
