"""Two-sample tests as DataFrame operators.

Both tests take a long frame (group column + value column, optional ``by``
keys that identify independent tests, e.g. metric or iteration) and a list
of (a, b) group pairs, and return one row per (by..., a, b, alternative).

* Welch's t-test needs only (n, mean, sample variance) per group: one
  partial/final aggregate; the t statistic and Welch-Satterthwaite degrees of
  freedom are column expressions; the p-value comes from a pandas UDF that
  sees one row per test.
* Mann-Whitney U uses exact mid-ranks from ``ranks.ranked_values`` (no group
  is sorted in one task), the tie-corrected normal approximation with
  continuity correction, U of the first sample as the statistic, and the
  same alternatives and method choice as SciPy's default: 'greater' uses U1,
  'less' U2, 'two-sided' max(U1, U2) with the tail doubled; the exact null
  distribution of U when a sample has at most 8 values and there are no
  ties, the normal approximation otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.functions.pvalues import mwu_pvalue, student_t_pvalue
from pulsekit.operators.ranks import DEFAULT_BINS, ranked_values

ALTERNATIVES = ("less", "greater", "two-sided")
EXACT_MAX = 8  # SciPy's default: exact U distribution when a sample is this small and nothing ties
MWU_METHODS = ("auto", "exact", "asymptotic")


def _group_type(df: DataFrame, group: str) -> T.DataType:
    return df.schema[group].dataType


def _nan_to_null(c):
    return F.when(~F.isnan(c), c)


def _members(df: DataFrame, group: str, pairs) -> DataFrame:
    """(_member, group_a, group_b, _side) rows: which pair and side each group feeds (bounded by ``pairs``)."""
    gt = _group_type(df, group)
    schema = T.StructType([
        T.StructField("_member", gt), T.StructField("group_a", gt), T.StructField("group_b", gt),
        T.StructField("_side", T.StringType()),
    ])
    return df.sparkSession.createDataFrame(
        [(g, a, b, s) for a, b in pairs for g, s in ((a, "a"), (b, "b"))], schema)


def _alternatives(alternatives):
    return F.explode(F.array(*[F.lit(a) for a in alternatives])).alias("alternative")


def welch_ttest(df: DataFrame, group: str, value: str, pairs, alternatives=ALTERNATIVES, by=()) -> DataFrame:
    by = list(by)
    tagged = df.where(F.col(value).isNotNull()).join(
        F.broadcast(_members(df, group, pairs)), F.col(group) == F.col("_member"))

    def on(side, c):
        return F.when(F.col("_side") == side, F.col(c))

    # one conditional-moment aggregate per (by..., pair): partial sums are combined map-side
    moments = tagged.groupBy(*by, "group_a", "group_b").agg(
        F.count(on("a", value)).alias("n_a"), F.count(on("b", value)).alias("n_b"),
        F.avg(on("a", value)).alias("mean_a"), F.avg(on("b", value)).alias("mean_b"),
        F.var_samp(on("a", value)).alias("var_a"), F.var_samp(on("b", value)).alias("var_b"),
    )
    return welch_from_moments(moments, by, alternatives)


def welch_from_moments(moments: DataFrame, by=(), alternatives=ALTERNATIVES) -> DataFrame:
    """Welch's test from one row per (by..., group_a, group_b) with n_a, n_b, mean_a, mean_b, var_a, var_b."""
    qa = F.col("var_a") / F.col("n_a")
    qb = F.col("var_b") / F.col("n_b")
    se2 = qa + qb
    sized = (F.col("n_a") >= 2) & (F.col("n_b") >= 2)
    valid = sized & (se2 > 0)
    # both variances zero (as SciPy): df is taken as 1 and different means give t = +-inf
    degenerate = sized & (se2 == 0) & (F.col("mean_a") != F.col("mean_b"))
    inf = F.lit(float("inf"))
    t = (F.when(valid, (F.col("mean_a") - F.col("mean_b")) / F.sqrt(se2))
         .when(degenerate, F.when(F.col("mean_a") > F.col("mean_b"), inf).otherwise(-inf)))
    dof = (F.when(valid, se2 * se2 / (qa * qa / (F.col("n_a") - 1) + qb * qb / (F.col("n_b") - 1)))
           .when(degenerate, F.lit(1.0)))
    out = moments.select(
        *by, "group_a", "group_b", _alternatives(alternatives), "n_a", "n_b", "mean_a", "mean_b", "var_a", "var_b",
        t.alias("t_stat"), dof.alias("dof"))
    p = student_t_pvalue(F.col("t_stat"), F.col("dof"), F.col("alternative"))
    return out.withColumn("p_value", F.when(F.col("t_stat").isNotNull(), _nan_to_null(p)))


def mann_whitney_u(df: DataFrame, group: str, value: str, pairs, alternatives=ALTERNATIVES, by=(),
                   bins: int = DEFAULT_BINS, method: str = "auto") -> DataFrame:
    """Mann-Whitney U of the group pairs.

    ``method``: 'asymptotic' is the normal approximation with tie and continuity
    correction; 'exact' the null distribution of U, at any size; 'auto' is exact
    where a sample has at most ``EXACT_MAX`` values and nothing ties. With ties
    U has no such distribution: 'exact' gives a null p-value.
    """
    if method not in MWU_METHODS:
        raise ValueError(f"method must be one of {MWU_METHODS}, not {method!r}")
    by = list(by)
    tagged = df.join(F.broadcast(_members(df, group, pairs)), F.col(group) == F.col("_member")).select(
        *by, "group_a", "group_b", "_side", value)
    keys = [*by, "group_a", "group_b"]
    ranked = ranked_values(tagged, keys, value,
                           counts={"_na": F.col("_side") == "a", "_nb": F.col("_side") == "b"}, bins=bins)
    dec = T.DecimalType(38, 0)
    n = F.col("n").cast(dec)
    # twice the rank sum of sample a: mid-rank = below + (n + 1) / 2, kept in exact decimals
    sums = ranked.groupBy(*keys).agg(
        F.sum("_na").alias("n_a"),
        F.sum("_nb").alias("n_b"),
        F.sum(F.col("_na").cast(dec) * (F.col("below").cast(dec) * 2 + n + 1)).alias("_r2"),
        F.sum(n * n * n - n).alias("_tie"),
    )
    na, nb = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    u1 = (F.col("_r2").cast("double") / 2) - na * (na + 1) / 2
    nonempty = (F.col("n_a") > 0) & (F.col("n_b") > 0)  # an empty sample has no U (SciPy raises)
    stats = sums.select(*keys, "n_a", "n_b", F.when(nonempty, u1).alias("u_stat"),
                        F.col("_tie").cast("double").alias("_tie"))
    tested = stats.select("*", _alternatives(alternatives))
    u2 = na * nb - F.col("u_stat")
    alt = F.col("alternative")
    u = F.when(alt == "greater", F.col("u_stat")).when(alt == "less", u2).otherwise(F.greatest(F.col("u_stat"), u2))
    total = na + nb
    # NULL for a test with at most one value in total (no tie correction, no U)
    s = F.sqrt(na * nb / 12 * ((total + 1) - F.try_divide(F.col("_tie"), total * (total - 1))))
    z = F.when(s > 0, (u - na * nb / 2 - 0.5) / s)
    factor = F.when(alt == "two-sided", F.lit(2.0)).otherwise(F.lit(1.0))
    able = (F.col("_tie") == 0) & F.col("u_stat").isNotNull()
    small = (F.col("n_a") <= EXACT_MAX) | (F.col("n_b") <= EXACT_MAX)
    exact = {"auto": able & small, "exact": able, "asymptotic": F.lit(False)}[method]
    out = tested.select(*keys, "alternative", "n_a", "n_b", "u_stat", z.alias("z"), factor.alias("_factor"),
                        s.alias("_s"), u.alias("_u"), exact.alias("_exact"))
    p = mwu_pvalue(F.col("z"), F.col("_factor"), F.col("_u"), F.col("n_a"), F.col("n_b"), F.col("_exact"))
    # all values tied (s = 0): the continuity-corrected z is -inf and every alternative gives p = 1
    known = F.when(F.col("z").isNotNull(), _nan_to_null(p)) \
        .when((F.col("_s") == 0) & F.col("u_stat").isNotNull(), F.lit(1.0))
    return out.withColumn("p_value", F.when(F.col("_exact"), known) if method == "exact" else known) \
        .drop("_factor", "_s", "_u", "_exact")
