"""Exact ranks and quantiles without sorting a whole group in one task.

A group (an experiment arm, one test) can hold a third of all rows, so a
window partitioned by the group alone would put it in a single task. The
rank of a value is instead assembled from two bounded pieces:

1. the distinct-value table (key, value, n) - a hash aggregate with map-side
   combine;
2. value bins from approximate-quantile edges (a bounded list, computed once
   and applied as a JVM-side bucketizer); per (key, bin) totals are a small
   table whose running sum gives each bin's offset;
3. within (key, bin) a running sum ordered by value gives the count of
   smaller values inside the bin.

``below`` = bin offset + in-bin running count is the exact number of rows of
the key with a smaller value. Every value lands in exactly one bin because
binning is by value, not by partition.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.session import shared_dir

DEFAULT_BINS = 1024


def value_edges(dv: DataFrame, value: str, bins: int, rel_err: float = 1e-3) -> list[float]:
    """Approximate-quantile bin edges of ``value`` (at most ``bins - 1`` of them)."""
    if bins <= 1:
        return []
    probs = [i / bins for i in range(1, bins)]
    edges = dv.approxQuantile(value, probs, rel_err)
    return sorted({float(e) for e in edges if e is not None and not math.isnan(e)})


def with_value_bin(dv: DataFrame, value: str, edges: list[float], out: str = "_bin") -> DataFrame:
    inner = [e for e in edges if math.isfinite(e)]
    if not inner:  # one bin: nothing to search
        return dv.withColumn(out, F.lit(0.0))
    splits = [-math.inf] + inner + [math.inf]
    tmp = "_value_as_double"
    bucketizer = Bucketizer(splits=splits, inputCol=tmp, outputCol=out, handleInvalid="keep")
    return bucketizer.transform(dv.withColumn(tmp, F.col(value).cast("double"))).drop(tmp)


def _window(keys: list[str]) -> Window:
    return Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))


def ranked_with_bins(df: DataFrame, keys: list[str], value: str, counts: dict[str, Column] | None = None,
                     bins: int = DEFAULT_BINS) -> tuple[DataFrame, DataFrame]:
    """(ranked rows with their ``_bin``, bin table (keys, _bin, _offset, _bin_n)).

    The bin table has at most keys x ``bins`` rows.
    """
    counts = counts or {}
    aggs = [F.count(F.lit(1)).alias("n")] + [F.count_if(c).alias(name) for name, c in counts.items()]
    dv = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(*aggs)
    # read twice (quantile edges, then ranking): materialize once in the shared checkpoint folder
    shared_dir(df.sparkSession)
    dv = dv.checkpoint(eager=True)
    binned = with_value_bin(dv, value, value_edges(dv, value, bins))
    bin_table = binned.groupBy(*keys, "_bin").agg(F.sum("n").alias("_bin_n")).select(
        *keys, "_bin", "_bin_n",
        F.coalesce(
            F.sum("_bin_n").over(_window(keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_offset"),
    )
    in_bin = Window.partitionBy(*keys, "_bin").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        binned.join(bin_table.select(*keys, "_bin", "_offset"), [*keys, "_bin"])
        .withColumn("below", F.col("_offset") + F.coalesce(F.sum("n").over(in_bin), F.lit(0)))
        .drop("_offset")
    )
    return ranked, bin_table


def ranked_values(df: DataFrame, keys: list[str], value: str,
                  counts: dict[str, Column] | None = None, bins: int = DEFAULT_BINS) -> DataFrame:
    """One row per (keys, value) with ``n`` (rows holding the value), any
    extra conditional counts, and ``below`` (rows of the key with a smaller value)."""
    return ranked_with_bins(df, keys, value, counts, bins)[0].drop("_bin")


def _and(conds):
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float],
                    bins: int = DEFAULT_BINS) -> DataFrame:
    """Exact quantiles with linear interpolation (position q * (n - 1)), one
    row per (keys, q) with column ``quantile``. Equal to pandas / DuckDB
    ``quantile_cont``.

    Each target position is first resolved to its value bin on the small bin
    table, and only then matched against the ranked values on (keys, bin),
    so no key's values are gathered into one task.
    """
    ranked, bin_table = ranked_with_bins(df, keys, value, bins=bins)
    totals = bin_table.groupBy(*keys).agg(F.sum("_bin_n").alias("_total"))
    h = F.col("q") * (F.col("_total") - 1)
    positions = (
        totals.select(*keys, "_total", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("q"))
        .select(*keys, "q", F.floor(h).alias("_lo_pos"), (h - F.floor(h)).alias("_frac"))
        .select(*keys, "q", "_frac",
                F.explode(F.array(
                    F.struct(F.lit("lo").alias("side"), F.col("_lo_pos").alias("pos")),
                    F.struct(F.lit("hi").alias("side"),
                             F.when(F.col("_frac") > 0, F.col("_lo_pos") + 1).otherwise(F.col("_lo_pos"))
                             .alias("pos")),
                )).alias("p"))
        .select(*keys, "q", "_frac", "p.side", "p.pos")
    )
    p, b = positions.alias("p"), bin_table.alias("b")
    pos_bins = p.join(b, _and([F.col(f"p.{k}") == F.col(f"b.{k}") for k in keys]
                              + [(F.col("b._offset") <= F.col("p.pos")),
                                 (F.col("p.pos") < F.col("b._offset") + F.col("b._bin_n"))])
                      ).select(*[F.col(f"p.{k}").alias(k) for k in keys], "p.q", "p._frac", "p.side", "p.pos", "b._bin")
    r, pb = ranked.alias("r"), pos_bins.alias("pb")
    # pos_bins has keys x probs x 2 rows (a bounded handful per key): broadcast it
    picked = r.join(F.broadcast(pb), _and(
        [F.col(f"r.{k}") == F.col(f"pb.{k}") for k in keys + ["_bin"]]
        + [(F.col("r.below") <= F.col("pb.pos")), (F.col("pb.pos") < F.col("r.below") + F.col("r.n"))])
    ).select(*[F.col(f"pb.{k}").alias(k) for k in keys], "pb.q", "pb._frac", "pb.side",
             F.col(f"r.{value}").cast("double").alias("_v"))
    both = picked.groupBy(*keys, "q", "_frac").agg(
        F.max(F.when(F.col("side") == "lo", F.col("_v"))).alias("_vlo"),
        F.max(F.when(F.col("side") == "hi", F.col("_v"))).alias("_vhi"),
    )
    return both.select(*keys, "q", (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_frac")).alias("quantile"))
