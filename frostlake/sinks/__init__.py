"""Sinks: layer snapshots, raw landing, exports, keyed JSON, run log, manifest."""

from frostlake.sinks.files import (
    RunLog,
    SchemaMismatch,
    dump_json,
    encode_keyed_json,
    export_csv,
    export_json,
    lake_manifest,
    land_raw,
    write_layer,
    write_topic,
)

__all__ = [
    "RunLog",
    "SchemaMismatch",
    "dump_json",
    "encode_keyed_json",
    "export_csv",
    "export_json",
    "lake_manifest",
    "land_raw",
    "write_layer",
    "write_topic",
]
