"""Hand-made log frames for edge cases."""

from datetime import datetime

from pulsekit.sources.schemas import FEED_SCHEMA, MESSAGE_SCHEMA


def ts(day: int, hour: int = 12, minute: int = 0) -> datetime:
    return datetime(2024, 1, day, hour, minute)


def feed_row(user, action, t, post=1, gender=1, age=30, os="iOS", source="organic", city="c1", group=1):
    return (user, post, action, t, gender, age, os, source, city, group)


def msg_row(user, receiver, t, gender=1, age=30, os="iOS", source="organic"):
    return (user, receiver, t, gender, age, os, source)


def feed_df(spark, rows):
    return spark.createDataFrame(rows, FEED_SCHEMA)


def msg_df(spark, rows):
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)
