"""Structured Streaming live views (R1-R5) and topic drain/tail entry points."""

from frostlake.streaming.live import (
    drain_topic,
    drain_until_quiet,
    last_n_readings,
    latest_reading,
    live_kpis,
    live_points,
    messages_received,
    read_live_views,
    start_dump_json,
    start_live_views,
    tail_topic_views,
)

__all__ = [
    "drain_topic",
    "drain_until_quiet",
    "last_n_readings",
    "latest_reading",
    "live_kpis",
    "live_points",
    "messages_received",
    "read_live_views",
    "start_dump_json",
    "start_live_views",
    "tail_topic_views",
]
