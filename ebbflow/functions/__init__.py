"""Column expressions (all built-in Spark functions, no Python UDFs)."""

from ebbflow.functions.labels import alert_message, status_label
from ebbflow.functions.text import blank_to_null
from ebbflow.functions.time import day_of, hour_floor, hour_text, parse_timestamp, rounded

__all__ = [
    "alert_message",
    "blank_to_null",
    "day_of",
    "hour_floor",
    "hour_text",
    "parse_timestamp",
    "rounded",
    "status_label",
]
