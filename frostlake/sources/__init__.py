"""Sources: lake layers, raw JSON, topics and file-fed streams, test fixtures."""

from frostlake.sources.lake import TableNotFound, conform_raw, read_layer, read_raw_json, resolve_table
from frostlake.sources.topics import (
    accepted,
    decode_json_values,
    empty_source_fallback,
    file_value_stream,
    kafka_stream,
    rejected,
    tail_topic,
)

__all__ = [
    "TableNotFound",
    "accepted",
    "conform_raw",
    "decode_json_values",
    "empty_source_fallback",
    "file_value_stream",
    "kafka_stream",
    "read_layer",
    "read_raw_json",
    "rejected",
    "resolve_table",
    "tail_topic",
]
