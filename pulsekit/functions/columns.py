"""Column expressions shared by the operators. All are built-in Spark
functions, so they stay inside whole-stage codegen."""

from __future__ import annotations

import math
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Age bins, half-open [lo, hi); everything else (65 and over,
# negative, null) is '65+'.
AGE_BINS = (
    (0, 18, "0-18"),
    (18, 25, "18-24"),
    (25, 35, "25-34"),
    (35, 45, "35-44"),
    (45, 55, "45-54"),
    (55, 65, "55-64"),
)
AGE_OTHER = "65+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def age_bin(age="age") -> Column:
    a = _col(age)
    expr = None
    for lo, hi, label in AGE_BINS:
        cond = (a >= lo) & (a < hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(AGE_OTHER)


def gender_label(gender="gender") -> Column:
    return F.when(_col(gender) == 1, "male").otherwise("female")


def safe_ratio(num, den) -> Column:
    """num / den as double, NULL when den is 0 or NULL (never raises under ANSI)."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def on_day(ts, day: date) -> Column:
    """``to_date(ts) = day``; Catalyst rewrites it into a pushed-down range on ``ts``."""
    return F.to_date(_col(ts)) == F.lit(day)


def between_days(ts, first: date, last: date) -> Column:
    """Inclusive day window on a timestamp column (pushed down as a range)."""
    return F.to_date(_col(ts)).between(F.lit(first), F.lit(last))


def before_day_after(ts, as_of: date) -> Column:
    """History cutoff: keep rows strictly before the day after ``as_of``."""
    return _col(ts) < F.lit(as_of + timedelta(days=1)).cast("timestamp_ntz")



def hash_key(*parts) -> Column:
    """':'-joined string of the parts (ints become literals, str are column names)."""
    cols = []
    for p in parts:
        if isinstance(p, int):
            cols.append(F.lit(str(p)))
        else:
            cols.append(_col(p).cast("string"))
    return F.concat_ws(":", *cols)


def stable_hash32(*parts) -> Column:
    """Unsigned 32-bit integer from the first 8 hex digits of md5 of the key.

    Deterministic across engines and partitionings (DuckDB gives the same
    value with ``('0x' || substr(md5(key), 1, 8))::BIGINT``).
    """
    return F.conv(F.substring(F.md5(hash_key(*parts)), 1, 8), 16, 10).cast("bigint")


def stable_uniform(*parts) -> Column:
    """Uniform double in [0, 1) from 52 bits of md5 of the key."""
    bits = F.conv(F.substring(F.md5(hash_key(*parts)), 1, 13), 16, 10).cast("bigint")
    return bits.cast("double") / F.lit(float(2 ** 52))


def hash_bucket(user_id="user_id", n: int = 50) -> Column:
    """Bucket in [0, n) from the md5 hash of the id."""
    return F.pmod(stable_hash32(user_id), F.lit(n)).cast("int")


def _poisson1_cdf(max_k: int = 17) -> tuple[float, ...]:
    # Rule: F(k) = sum_{j<=k} e^-1 / j!; stops where F reaches 1.0 in doubles.
    out, term, acc = [], math.exp(-1.0), 0.0
    for k in range(max_k + 1):
        acc += term
        out.append(acc)
        term /= k + 1
    return tuple(out)


POISSON1_CDF = _poisson1_cdf()


def poisson1_draw(u) -> Column:
    """Inverse CDF of Poisson(1) applied to a uniform column: smallest k with u < F(k)."""
    u = _col(u)
    expr = None
    for k, cdf in enumerate(POISSON1_CDF):
        cond = u < F.lit(cdf)
        expr = F.when(cond, F.lit(k)) if expr is None else expr.when(cond, F.lit(k))
    return expr.otherwise(F.lit(len(POISSON1_CDF))).cast("int")


def day_range(first: date, last: date) -> list[date]:
    return [first + timedelta(days=i) for i in range((last - first).days + 1)]
