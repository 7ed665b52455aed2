"""frostlake: a chiller telemetry lakehouse on Spark (DataFrame / SQL / Structured Streaming)."""

__version__ = "0.1.0"
