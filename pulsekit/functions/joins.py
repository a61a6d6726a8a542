"""Join strategy behind an explicit size check.

Static size estimates do not account for row multiplication by ``explode``
(replicates, iterations, draws), so the planner can mistake a huge exploded
side for a small one and broadcast it. Joins against such sides choose their
strategy from a known row count instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A narrow (key, index, value) row is a few dozen bytes: 2M rows stay well
# under the usual broadcast budget of an executor.
BROADCAST_MAX_ROWS = 2_000_000


def join_known_small(big: DataFrame, small: DataFrame, on, how: str = "inner", small_rows: int | None = None,
                     max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``small`` only if it has at most ``max_rows`` rows (counted when
    not given); otherwise a sort-merge join hinted on both sides, so neither
    side is broadcast on a wrong estimate."""
    rows = small.count() if small_rows is None else small_rows
    if rows <= max_rows:
        return big.join(F.broadcast(small), on, how)
    return big.hint("merge").join(small.hint("merge"), on, how)
