"""The live views' state, kept by the streaming query itself.

One stateful operator serves R1-R4. Messages are dealt to shards by the hash of their arrival number, so that no
device and no burst fills one task. Before that, each task of a batch drops what cannot be among its shards' newest
``n`` (``Newest``), so that a shard gets n messages a task, however many came. Each shard keeps in Spark's state store:

* ``newest`` (list): its newest ``n`` messages by arrival;
* ``latest`` (value): the newest of them, and ``seen`` (value): how many messages were accepted.

The store's version and the source's offsets are committed together, batch by batch: a query that was killed goes
on from both, and a batch that is run again starts from the state before it. A new checkpoint is a new state. The
views are batch reads of the last committed state (``read_state``), merged over the shards: n rows and two values each.
"""

from __future__ import annotations

import datetime as dt
import heapq
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from frostlake.session import hadoop_fs

SHARDS = 4
_SHARD, _COUNTS, _OF = "_shard", "_accepted", "___"
_CONF = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def _flat(df: DataFrame) -> list[Column]:
    """The columns, with a struct's fields as columns of their own (``seq___offset``): the store's Python side
    takes plain values, and names of letters, digits and underscores."""
    out = []
    for f in df.schema.fields:
        inner = f.dataType.fieldNames() if isinstance(f.dataType, T.StructType) else [None]
        out += [F.col(f"`{f.name}`").alias(f.name) if g is None else F.col(f"`{f.name}`.`{g}`").alias(f"{f.name}{_OF}{g}") for g in inner]
    return out


def _nested(df: DataFrame) -> DataFrame:
    """``df`` with the columns of ``_flat`` as structs again."""
    names: dict[str, list[str]] = {}
    for c in df.columns:
        names.setdefault(c.split(_OF)[0], []).append(c)
    struct = lambda cs: F.struct(*[F.col(f"`{c}`").alias(c.split(_OF, 1)[1]) for c in cs])
    return df.select(*[F.col(name) if cs == [name] else struct(cs).alias(name) for name, cs in names.items()])


class Newest:
    """The newest ``n`` messages of each shard among those of one task (Arrow batches), by the ``order`` columns, nulls
    first; of equal ones the later. One of a shard's messages counts for all that were left out, too (``_COUNTS``)."""

    def __init__(self, n: int, order: list[str]):
        self.n, self.order = n, order

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, left_out = None, {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if kept is None else pa.concat_tables([kept, table])
            at = pa.array(range(len(table)), pa.int64())
            keys = [(_SHARD, "ascending"), *[(c, "descending") for c in self.order], ("_at", "descending")]
            ranked = pc.sort_indices(table.select([_SHARD, *self.order]).append_column("_at", at), sort_keys=keys, null_placement="at_end")
            shards, start, keep = table[_SHARD].take(ranked).to_numpy(), 0, []
            for end in [*(shards[1:] != shards[:-1]).nonzero()[0] + 1, len(shards)]:
                if end > start:
                    keep.append(ranked.slice(start, min(self.n, end - start)))
                    shard = int(shards[start])
                    left_out[shard] = left_out.get(shard, 0) + max(0, end - start - self.n)
                start = end
            # in their order of arrival, so that of equal ones the later stays the later
            kept = table.take(pa.concat_arrays(keep).sort()) if keep else table
        if kept is not None and len(kept):
            first, counts = set(), []
            for shard in kept[_SHARD].to_pylist():
                counts.append(1 if shard in first else 1 + left_out[shard])
                first.add(shard)
            kept = kept.set_column(kept.column_names.index(_COUNTS), _COUNTS, pa.array(counts, pa.int64()))
            yield from kept.combine_chunks().to_batches()


class NewestMessages(StatefulProcessor):
    """State of one shard; messages are ordered by the ``order`` columns, nulls first. A message counts ``_COUNTS``
    times, 0 for one that the views leave out. With ``forward`` every message is passed on; otherwise none."""

    def __init__(self, schema: T.StructType, n: int, order: list[str], forward: bool):
        self.schema, self.columns, self.n, self.forward = schema, schema.fieldNames(), n, forward
        self.order = [self.columns.index(c) for c in order]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getListState("newest", self.schema)
        self.latest = handle.getValueState("latest", self.schema)
        self.seen = handle.getValueState("seen", "messages long")

    def _arrival(self, message: tuple) -> tuple:
        # a timestamp has a zone when it comes from the stream, and none when it comes from the store
        plain = lambda v: v.astimezone(dt.timezone.utc) if isinstance(v, dt.datetime) else v
        return tuple((message[i] is not None, plain(message[i])) for i in self.order)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        heap = [(self._arrival(tuple(r)), i, tuple(r)) for i, r in enumerate(self.newest.get())]
        heapq.heapify(heap)
        old, accepted = len(heap), 0
        for at, row in enumerate(rows):
            message = tuple(row[c] for c in self.columns)
            if row[_COUNTS]:
                item = (self._arrival(message), old + at, message)
                accepted += row[_COUNTS]
                # never more than n messages in memory
                (heapq.heappush if len(heap) < self.n else heapq.heappushpop)(heap, item)
            if self.forward:
                yield Row(**dict(zip(self.columns, message)))
        if accepted:
            heap.sort()
            self.newest.put([message for _, _, message in heap])
            self.latest.update(heap[-1][2])
            before = self.seen.get()
            self.seen.update(((before[0] if before else 0) + accepted,))

    def close(self) -> None:
        pass


@contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]):
    """Session settings while a query is started; the query keeps them."""
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def start_newest(
    messages: DataFrame,
    checkpoint: str,
    n: int,
    order_col: str,
    counts: Column,
    archive: str | None = None,
    shards: int = SHARDS,
    available_now: bool = False,
    processing_time: str = "1 second",
) -> StreamingQuery:
    """Keep the newest ``n`` of the messages for which ``counts`` holds, the latest and their number, in the
    query's state. ``archive`` gets every message as JSON lines, each once, in the same query; ``shards`` is
    fixed by the checkpoint's first run."""
    spark = messages.sparkSession
    flat = messages.select(*_flat(messages))
    order = [c for c in flat.columns if c == order_col or c.startswith(f"{order_col}{_OF}")]
    shard = F.pmod(F.xxhash64(order_col), F.lit(shards)).cast("int").alias(_SHARD)
    counted = F.coalesce(counts, F.lit(False)).cast("long").alias(_COUNTS)
    dealt = messages.select(*_flat(messages), shard, counted)
    if archive is None:
        dealt = dealt.where(F.col(_COUNTS) > 0)
        dealt = dealt.mapInArrow(Newest(n, order), dealt.schema)
    mode = "Update" if archive is None else "Append"
    state = NewestMessages(flat.schema, n, order, archive is not None)
    # one state partition per shard
    with _settings(spark, {**_CONF, "spark.sql.shuffle.partitions": str(shards)}):
        out = _nested(dealt.groupBy(_SHARD).transformWithState(state, flat.schema, mode, "None"))
        w = out.writeStream.outputMode(mode.lower()).option("checkpointLocation", checkpoint)
        w = w.format("noop") if archive is None else w.format("json").option("path", archive).option("ignoreNullFields", "false")
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
        return w.start()


def has_state(spark: SparkSession, checkpoint: str) -> bool:
    """Whether the query has committed a batch (metadata only)."""
    fs, commits = hadoop_fs(spark, f"{checkpoint.rstrip('/')}/commits")
    return fs.exists(commits) and any(st.getPath().getName().isdigit() for st in fs.listStatus(commits))


def read_state(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    """One state variable, a row per value and shard, as of the last committed batch."""
    with _settings(spark, _CONF):
        state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", variable).load()
    return _nested(state.select("list_element.*" if variable == "newest" else "value.*"))
