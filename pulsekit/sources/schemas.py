"""Declared schemas of the two event logs, the metrics mart and the raw events."""

from pyspark.sql import types as T

# One row per feed action (a view or a like).
FEED_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType(), False),
    T.StructField("post_id", T.IntegerType(), True),
    T.StructField("action", T.StringType(), True),        # 'view' | 'like'
    T.StructField("time", T.TimestampNTZType(), True),
    T.StructField("gender", T.IntegerType(), True),       # 1 = male, anything else = female
    T.StructField("age", T.IntegerType(), True),
    T.StructField("os", T.StringType(), True),
    T.StructField("source", T.StringType(), True),        # 'ads' | 'organic'
    T.StructField("city", T.StringType(), True),
    T.StructField("exp_group", T.IntegerType(), True),
])

# One row per message; the receiver column keeps the source data's spelling.
MESSAGE_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType(), False),
    T.StructField("reciever_id", T.LongType(), True),
    T.StructField("time", T.TimestampNTZType(), True),
    T.StructField("gender", T.IntegerType(), True),
    T.StructField("age", T.IntegerType(), True),
    T.StructField("os", T.StringType(), True),
    T.StructField("source", T.StringType(), True),
])

MART_METRICS = ("views", "likes", "messages_received", "messages_sent", "users_received", "users_sent")

# The long-form daily metrics mart (output contract).
MART_SCHEMA = T.StructType(
    [
        T.StructField("event_date", T.DateType(), False),
        T.StructField("dimension", T.StringType(), False),
        T.StructField("dimension_value", T.StringType(), True),
    ]
    + [T.StructField(m, T.LongType(), False) for m in MART_METRICS]
)

# The driver's raw events table that the fixture adapter maps onto the logs.
EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType(), True),
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("props", T.StringType(), True),
])
