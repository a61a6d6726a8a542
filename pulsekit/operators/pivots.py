"""Matrices of the app report (hour x day activity, cohort x day retention).

Pivots are given their column values up front (derived from ``as_of``), so
Spark does not run an extra job to discover distinct values, and the output
schema is stable even on days without data. Labels use the report's
'EEE dd MMM' format.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.functions.columns import day_range
from pulsekit.operators import audience

# Day label formats of the reports (matrix axes, weekly series, report date).
LABEL_FORMAT = "EEE dd MMM"
SERIES_FORMAT = "dd MMM"
REPORT_DATE_FORMAT = "dd/MM/yyyy"


def day_label(d: date) -> str:
    return d.strftime("%a %d %b")


def activity_heatmap(feed: DataFrame, messages: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Rows = hour, columns = the trailing window's days, cells = actions."""
    first, last = audience.trailing_window(as_of, days)
    labels = [day_label(x) for x in day_range(first, last)]
    cells = audience.activity_by_hour(feed, messages, as_of, days).withColumn(
        "day_label", F.date_format("day", LABEL_FORMAT))
    # hours descending, as the heatmap is drawn (top row = latest hour)
    return cells.groupBy("hour").pivot("day_label", labels).agg(F.max("actions")).orderBy(F.desc("hour"))


def retention_matrix(feed: DataFrame, messages: DataFrame, as_of: date, source: str, days: int = 7) -> DataFrame:
    """Rows = cohort start (date and label), columns = action day, cells = users, for one source."""
    return retention_matrix_from(audience.retention_cohorts(feed, messages, as_of, days), as_of, source, days)


def retention_matrix_from(cohorts: DataFrame, as_of: date, source: str, days: int = 7) -> DataFrame:
    """The retention matrix from a (action, start, source, users) cohort table."""
    labels = [day_label(x) for x in day_range(as_of - timedelta(days=days), as_of)]
    cells = (
        cohorts
        .where(F.col("source") == source)
        .withColumn("action_label", F.date_format("action", LABEL_FORMAT))
        .withColumn("start_label", F.date_format("start", LABEL_FORMAT))
    )
    return cells.groupBy("start", "start_label").pivot("action_label", labels).agg(F.max("users"))
