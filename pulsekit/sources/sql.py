"""SQL entry point: run a parameterized query over the logs and get a DataFrame.

The reference formats SQL strings; here values travel as named parameter
markers (``:first``), so they are typed literals Catalyst can push down and
never text spliced into the query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulsekit.sources.logs import EventLogs


def register_logs(logs: EventLogs, feed_view: str = "feed_actions", message_view: str = "message_actions") -> None:
    """Expose the two logs to Spark SQL as temporary views."""
    logs.feed.createOrReplaceTempView(feed_view)
    logs.messages.createOrReplaceTempView(message_view)


def extract_df(spark: SparkSession, query: str, frames: dict[str, DataFrame] | None = None, **args) -> DataFrame:
    """``spark.sql`` with named parameter markers; ``{name}`` in the query stands for the frame of that name."""
    return spark.sql(query, args=args, **(frames or {}))


FEED_DAILY_SQL = """
WITH actions AS (
  SELECT CAST(time AS DATE) AS day, user_id, int(action = 'view') AS viewed, int(action = 'like') AS liked FROM {feed}
), days AS (
  SELECT day, count(DISTINCT user_id) AS dau, sum(viewed) AS views, sum(liked) AS likes
  FROM actions WHERE day >= :first AND day <= :last GROUP BY day
)
SELECT day AS date, dau, views, likes, bround(100 * double(likes) / nullif(views, 0), 1) AS ctr FROM days
"""
