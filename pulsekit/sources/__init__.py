from pulsekit.sources.schemas import FEED_SCHEMA, MESSAGE_SCHEMA, MART_SCHEMA, EVENTS_SCHEMA
from pulsekit.sources.logs import EventLogs, logs_from_events, load_fixture_logs, read_log
from pulsekit.sources.mart import (
    clean_mart, publish_mart, read_mart, read_mart_table, read_published_mart, write_mart, write_mart_table,
)

__all__ = [
    "FEED_SCHEMA", "MESSAGE_SCHEMA", "MART_SCHEMA", "EVENTS_SCHEMA",
    "EventLogs", "logs_from_events", "load_fixture_logs", "read_log",
    "write_mart", "read_mart", "write_mart_table", "read_mart_table",
    "publish_mart", "read_published_mart", "clean_mart",
]
