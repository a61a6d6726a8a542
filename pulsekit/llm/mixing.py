"""Operator 10: mixing sources to target weights (DataFrame and SQL functions only).

The weight of a source is its share of the tokens to the power of an exponent
between 0 (uniform) and 1 (natural shares), normalised. The exponent is the
greatest whose weights reach a target entropy (as a share of the entropy of
uniform weights), raised where needed until no source is repeated more than
``max_repeats`` times. Both are found by bisection: a round cuts the interval into
``GRID`` parts, and one aggregate over the table of source totals (a row a source,
however many) tells on which side of the answer each cut lies. Only these sums
reach the driver.

The weights are realised as budgeted block permutations. A source's documents
are dealt into ``n_blocks`` blocks by a hash; every epoch of a source visits its
blocks in an order of its own; whole epochs take all blocks, the last one stops
where the source's budget (weight x token budget) ends. Only the block where it
ends is resolved further: by ranges of the hash that orders its documents, and
document by document inside the range where the budget ends, so no task sees more
than one block's share of one range in ``RANGES``.

Defined results: documents without a word (null text too) carry no tokens and
are never drawn; a null source is a source of its own; the total never exceeds
the budget, and a source falls short of its own by less than one document of
the last block; only the count of words matters, however long a text; blocks of one
rank by hash go by number; documents with equal doc_id are told apart by their text,
rows equal in both are all drawn alike; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from pulsekit.llm.storage import saved

TARGET_ENTROPY = 0.97   # share of the entropy of uniform weights
MAX_REPEATS = 4.0
N_BLOCKS = 1024
ROUNDS = 50              # halvings of [0, 1]
GRID_BITS = 5            # halvings a round
GRID = 1 << GRID_BITS
RANGES = 1 << 16
NULL_SOURCE = "\x00null"


def _figures(totals: DataFrame, total: float, size: float, exponents: list[float]) -> list[tuple[float, float]]:
    """(entropy, greatest repetition) of the weights at each exponent: one row of sums over the sources."""
    p = F.col("tokens") / F.lit(total)
    sums = []
    for j, x in enumerate(exponents):
        power = F.pow(p, F.lit(x))
        sums += [F.sum(power).alias(f"s{j}"), F.sum(power * F.log(p)).alias(f"t{j}"),
                 F.max(power / F.col("tokens")).alias(f"r{j}")]
    row = totals.agg(*sums).first()
    return [(math.log(row[f"s{j}"]) - x * row[f"t{j}"] / row[f"s{j}"], size * row[f"r{j}"] / row[f"s{j}"])
            for j, x in enumerate(exponents)]


def _exponent(totals: DataFrame, total: float, sources: int, size: float, target_entropy: float, max_repeats: float) -> float:
    """The greatest exponent with the target entropy, or the least with the repetition limit if that is greater."""
    goal = target_entropy * math.log(sources)
    (least_entropy, _), (_, most_repeats) = _figures(totals, total, size, [1.0, 0.0])
    by_entropy, by_repeats = [0.0, 1.0], [0.0, 1.0]
    for _ in range(ROUNDS // GRID_BITS):
        cuts = [[lo + (hi - lo) * j / GRID for j in range(1, GRID)] for lo, hi in (by_entropy, by_repeats)]
        found = _figures(totals, total, size, cuts[0] + cuts[1])
        # entropy falls and the greatest repetition falls as the exponent grows
        high = sum(h >= goal for h, _ in found[:GRID - 1])
        much = sum(r > max_repeats for _, r in found[GRID - 1:])
        for interval, k in ((by_entropy, high), (by_repeats, much)):
            lo, hi = interval
            interval[:] = [lo + (hi - lo) * k / GRID, lo + (hi - lo) * (k + 1) / GRID]
    return round(max(1.0 if least_entropy >= goal else by_entropy[0], 0.0 if most_repeats <= max_repeats else by_repeats[1]), 9)


def mixing_weights(docs_tokens: DataFrame, target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS,
                   budget: int | None = None) -> DataFrame:
    """(source, tokens, weight, target, exponent) from rows (source, n_tokens).

    ``budget`` in tokens, all tokens by default; a budget above ``max_repeats``
    times all tokens cannot be met within the limit and ends at natural shares.
    """
    totals = saved(docs_tokens.sparkSession, docs_tokens.groupBy("source").agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0"), "totals")
    row = totals.agg(F.sum("tokens").alias("total"), F.count("*").alias("n")).first()
    if not row["n"]:
        return totals.select("source", "tokens", F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("target"),
                             F.lit(1.0).alias("exponent"))
    total = float(row["total"])
    size = total if budget is None else float(budget)
    x = _exponent(totals, total, row["n"], size, target_entropy, max_repeats)
    power = F.pow(F.col("tokens") / F.lit(total), F.lit(x))
    whole = totals.agg(F.sum(power)).first()[0]
    weight = F.round(power / F.lit(whole), 9)
    return totals.select("source", "tokens", weight.alias("weight"),
                         F.floor(weight * F.lit(size)).cast("long").alias("target"), F.lit(x).alias("exponent"))


def _order(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *parts))


def mix(spark: SparkSession, docs: DataFrame, target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS,
        budget: int | None = None, n_blocks: int = N_BLOCKS) -> DataFrame:
    """One row per drawn copy: doc_id, source, epoch (from 1), block, block_rank (place of the block in its epoch), n_tokens."""
    d = docs.select(
        "doc_id", F.coalesce(F.col("source").cast("string"), F.lit(NULL_SOURCE)).alias("source"),
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_tokens"),
        F.md5("text").alias("digest")).where("n_tokens > 0")
    d = d.withColumn("mark", _order(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("digest"))).drop("digest")
    d = d.withColumn("block", (F.conv(F.substring("mark", 1, 8), 16, 10).cast("long") % n_blocks).cast("int"))
    d = saved(spark, d, "mix-docs")
    weights = saved(spark, mixing_weights(d, target_entropy, max_repeats, budget), "mix-weights")
    blocks = saved(spark, d.groupBy("source", "block").agg(F.sum("n_tokens").alias("block_tokens")), "mix-blocks")
    # every epoch of every source: its blocks in an order of their own (at most n_blocks rows a window)
    epochs = weights.withColumn("epoch", F.explode(F.sequence(
        F.lit(1).cast("long"), F.ceil(F.col("target") / F.col("tokens")).cast("long")))).where("target > 0")
    visit = Window.partitionBy("source", "epoch").orderBy(
        _order(F.col("source"), F.col("epoch").cast("string"), F.col("block").cast("string")), "block")
    plan = (
        epochs.join(blocks, "source")
        .withColumn("block_rank", F.row_number().over(visit).cast("long"))
        .withColumn("after", F.sum("block_tokens").over(visit.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("left", F.col("target") - (F.col("epoch") - 1) * F.col("tokens"))
        .withColumn("before", F.col("after") - F.col("block_tokens")).where("before < left")
        .select(F.col("source").alias("s"), F.col("block").alias("b"), "epoch", "block_rank",
                (F.col("after") <= F.col("left")).alias("whole"), (F.col("left") - F.col("before")).alias("room"))
    )
    plan = saved(spark, plan, "mix-plan")
    drawn = d.join(plan, (F.col("source") == F.col("s")) & (F.col("block") == F.col("b")))
    cols = ["doc_id", "source", "epoch", "block", "block_rank", "n_tokens"]
    # the block where the budget ends: documents in order of their mark while they fit; ranges of the mark first
    ending = drawn.where("not whole").withColumn("range", F.conv(F.substring("mark", 1, 4), 16, 10).cast("int"))
    visit_ranges = Window.partitionBy("source", "epoch").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    ranges = (  # at most RANGES rows an epoch of a source
        ending.groupBy("source", "epoch", "range").agg(F.sum("n_tokens").alias("in_range"))
        .withColumn("to_range", F.sum("in_range").over(visit_ranges))
        .select(F.col("source").alias("rs"), F.col("epoch").alias("re"), F.col("range").alias("rr"),
                (F.col("to_range") - F.col("in_range")).alias("offset"))
    )
    inside = Window.partitionBy("source", "epoch", "range").orderBy("mark").rangeBetween(Window.unboundedPreceding, 0)
    part = (
        ending.join(ranges, (F.col("source") == F.col("rs")) & (F.col("epoch") == F.col("re")) & (F.col("range") == F.col("rr")))
        .where("offset < room")
        .withColumn("used", F.col("offset") + F.sum("n_tokens").over(inside)).where("used <= room")
    )
    return drawn.where("whole").select(*cols).unionByName(part.select(*cols))
