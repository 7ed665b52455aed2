"""On-disk inputs that Spark derives from the driver tables, built on demand.

Round-trip, lake-catalogue and streaming queries need files: raw JSON lines,
a written lake, message files to stream, and the outputs of streaming runs.
Each is produced by Spark jobs from ``events`` (so it scales with the data),
under the shared checkpoint folder, the first time a query needs it, and then
reused for the rest of the application.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frostlake.plans.increments import refresh_days
from frostlake.plans.medallion import run_pipeline
from frostlake.session import app_id, scratch_path
from frostlake.sinks.files import PACKED, dump_json
from frostlake.sources.fixtures import dirty_messages, drifting_lines, live, telemetry
from frostlake.sources.lake import read_layer
from frostlake.sources.topics import accepted, decode_json_values, file_value_stream, live_schema_with_seq
from frostlake.streaming import live as L

# The live messages arrive as LIVE_FILES files, LIVE_PARALLEL
# per micro-batch (like a topic with LIVE_PARALLEL partitions): 3 batches.
LIVE_PARALLEL = 8
LIVE_FILES = 3 * LIVE_PARALLEL


def decoded_live_stream(spark: SparkSession, live_json: str) -> DataFrame:
    values = file_value_stream(spark, live_json, max_files_per_trigger=LIVE_PARALLEL)
    return accepted(decode_json_values(values, live_schema_with_seq()))


class Workspace:
    """Lazily built folders; each property runs its Spark jobs once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.root = scratch_path(spark, "workspace")
        self.drain_checkpoint = f"{self.root}/_ckpt/drain"
        self._lock = threading.RLock()
        self._built: dict[str, str] = {}

    def _once(self, name: str, build) -> str:
        with self._lock:
            if name not in self._built:
                path = f"{self.root}/{name}"
                build(path)
                self._built[name] = path
            return self._built[name]

    @property
    def raw_json(self) -> str:
        """The telemetry raw layer as JSON lines (the pipeline's input)."""
        return self._once("raw_json", lambda p: dump_json(telemetry(self.spark, self.sf_dir), p, packed=True))

    @property
    def gold_states(self) -> str:
        """A lake whose gold states were refreshed three times: by the morning readings of all days, then by all readings
        of the later half of the days, then of the others."""

        def build(root: str) -> None:
            slv = read_layer(self.spark, self.lake, "silver")
            refresh_days(slv.where("Hour_of_Day < 12 OR Hour_of_Day IS NULL"), root)
            days = [r["Date"] for r in slv.select("Date").distinct().orderBy("Date").collect()]
            half = len(days) // 2
            for some in (days[half:], days[:half]):
                refresh_days(slv, root, some)

        return self._once("gold_states", build)

    @property
    def lake(self) -> str:
        """A lake written by the full pipeline from ``raw_json``."""
        return self._once("lake", lambda p: run_pipeline(self.spark, self.raw_json, p))

    @property
    def live_json(self) -> str:
        """Live messages as JSON lines in LIVE_FILES files by arrival range."""

        def build(p: str) -> None:
            lv = live(self.spark, self.sf_dir)
            lv.repartitionByRange(LIVE_FILES, F.col("seq")).write.option("ignoreNullFields", "false").json(p)

        return self._once("live_json", build)

    @property
    def drifting_json(self) -> str:
        """Raw JSON lines whose keys and types drift from the 40 text fields."""
        return self._once("drifting_json", lambda p: drifting_lines(self.spark, self.sf_dir).write.options(**PACKED).text(p))

    @property
    def dirty_text(self) -> str:
        """Messages of every good and bad kind, one a line."""
        return self._once("dirty_text", lambda p: dirty_messages(self.spark, self.sf_dir).select("value").write.text(p))

    def _drained_dirty(self, name: str, start) -> str:
        values = file_value_stream(self.spark, self.dirty_text)
        return self._once(name, lambda p: start(values, p, f"{self.root}/_ckpt/{name}").awaitTermination())

    @property
    def dirty_accepted(self) -> str:
        decode = lambda v: accepted(decode_json_values(v, live_schema_with_seq()))
        return self._drained_dirty("dirty_accepted", lambda v, p, c: L.start_dump_json(decode(v), p, c))

    @property
    def dirty_rejects(self) -> str:
        return self._drained_dirty("dirty_rejects", L.start_dump_rejects)

    @property
    def live_drained(self) -> str:
        """S4 + K3: everything decodable drained into JSON lines (the drain's
        checkpoint is ``drain_checkpoint``)."""

        def build(p: str) -> None:
            stream = decoded_live_stream(self.spark, self.live_json)
            L.start_dump_json(stream, p, self.drain_checkpoint).awaitTermination()

        return self._once("live_drained", build)

    @property
    def live_accepted(self) -> str:
        """F5 applied on the stream, dumped to JSON lines."""

        def build(p: str) -> None:
            acc = L.accepted_live(decoded_live_stream(self.spark, self.live_json))
            L.start_dump_json(acc, p, f"{self.root}/_ckpt/accepted").awaitTermination()

        return self._once("live_accepted", build)

    @property
    def live_views(self) -> str:
        """R1-R4 from one streaming query (one parse per message): its checkpoint."""

        def build(p: str) -> None:
            L.start_live_views(decoded_live_stream(self.spark, self.live_json), p, available_now=True).awaitTermination()

        return self._once("live_views", build)


_LOCK = threading.Lock()
_CACHE: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    key = (app_id(spark), sf_dir.rstrip("/"))
    with _LOCK:
        if key not in _CACHE:
            _CACHE[key] = Workspace(spark, sf_dir)
        return _CACHE[key]
