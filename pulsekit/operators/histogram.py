"""Equal-width histograms with edges shared across the counted groups.

Bin edges follow numpy's rule (``bins`` equal bins spanning [min, max], the
last bin closed on the right; a constant series spans [v - 0.5, v + 0.5]).
The per-edge-group (min, max) is a bounded summary (one row per edge group,
and edge groups are a handful of series or metric names) fetched once and
inlined as literals, so binning is a codegen'd column expression and
counting is one partial/final aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ranges(df: DataFrame, value: str, edges_by: list[str]) -> list[tuple[tuple, float, float]]:
    rows = df.groupBy(*edges_by).agg(F.min(value).alias("lo"), F.max(value).alias("hi")).collect()
    out = []
    for r in rows:
        if r["lo"] is None:  # no rows at all
            continue
        lo, hi = float(r["lo"]), float(r["hi"])
        if lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        out.append((tuple(r[k] for k in edges_by), lo, hi))
    return out


def _pick(edges_by: list[str], ranges, which: int) -> Column:
    if not edges_by:
        return F.lit(ranges[0][which] if ranges else None).cast("double")
    expr = None
    for key, lo, hi in ranges:
        cond = None
        for k, v in zip(edges_by, key):
            c = F.col(k).isNull() if v is None else (F.col(k) == F.lit(v))
            cond = c if cond is None else cond & c
        val = F.lit(lo if which == 1 else hi)
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr if expr is not None else F.lit(None).cast("double")


def equal_width_histogram(df: DataFrame, value: str, bins: int, by: list[str] | tuple = (),
                          edges_by: list[str] | tuple = ()) -> DataFrame:
    """Counts per (by..., bin) with columns bin, bin_lo, bin_hi, n.

    ``edges_by`` (a subset of ``by``) selects which rows share edges; rows
    with a null, NaN or infinite value are not counted; no rows give no bins.
    """
    by, edges_by = list(by), list(edges_by)
    finite = F.abs(F.col(value).cast("double")) < F.lit(float("inf"))  # null and NaN are not
    base = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")) & finite)
    ranges = _ranges(base, value, edges_by)
    lo, hi = _pick(edges_by, ranges, 1), _pick(edges_by, ranges, 2)
    x = F.col(value).cast("double")
    idx = F.least(F.floor((x - lo) / (hi - lo) * F.lit(bins)), F.lit(bins - 1)).cast("int")
    counted = (
        base.select(*by, idx.alias("bin"), lo.alias("_lo"), hi.alias("_hi"))
        .groupBy(*by, "bin", "_lo", "_hi")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    return counted.select(
        *by, "bin",
        (F.col("_lo") + F.col("bin") * width).alias("bin_lo"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
        "n",
    )


def auto_bin_count(df: DataFrame, value: str) -> int:
    """numpy's ``bins='auto'`` rule as of NumPy 1.x (what the reference's
    plots used): width = min(Freedman-Diaconis, Sturges), or Sturges alone
    when the interquartile range is 0. (NumPy 2 relaxes the FD width to at
    least half the square-root rule.) Uses one bounded summary (n, min, max
    and the exact quartiles)."""
    import math

    from pulsekit.operators.ranks import exact_quantiles

    base = df.where(F.col(value).isNotNull()).select(F.lit(0).alias("_k"), F.col(value).cast("double").alias("_v"))
    q = {r["q"]: r["quantile"] for r in exact_quantiles(base, ["_k"], "_v", [0.25, 0.75]).collect()}
    row = base.agg(F.count("_v").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")).collect()[0]
    n, lo, hi = row["n"], row["lo"], row["hi"]
    if not n or hi == lo:
        return 1
    sturges = (hi - lo) / (math.log2(n) + 1.0)
    fd = 2.0 * (q[0.75] - q[0.25]) * n ** (-1.0 / 3.0)
    width = min(fd, sturges) if fd > 0 else sturges
    return max(1, int(math.ceil((hi - lo) / width)))
