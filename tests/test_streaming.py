"""Streaming: decoding, drains, live views in the query's state, batch = stream,
restart from checkpoint and replay of a batch."""

from __future__ import annotations

import json
import os
import time

import pytest
from conftest import SF_SMALL

from frostlake.sources import topics as TP
from frostlake.sources.fixtures import live
from frostlake.streaming import live as L
from frostlake.streaming.state import SHARDS, read_state


def _write_lines(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def _msg(seq, ent=70.0, code="0", **kw):
    rec = {
        "seq": seq,
        "timestamp": "2024-01-01T00:00:%02d.000000" % (seq % 60),
        "Device_ID": "CHILLER_%02d" % (1 + seq % 15),
        "Entering_Chilled_Water_Temperature_Sensor": ent,
        "Leaving_Chilled_Water_Temperature_Sensor": 41.0,
        "Condenser_Water_Flow_Rate_Sensor_GPM": 300.0,
        "System_Power_Consumption_kW": 100.0 + seq,
        "Active_Fault_Code": code,
        "Pump_Hours": 1000 + seq,
        "CO2_Level_PPM": 500,
    }
    rec.update(kw)
    return json.dumps(rec)


def test_decode_rejects_malformed_arrays_scalars(spark):
    values = [_msg(1), "{not json", "[1, 2]", '[{"seq": 3}]', "42", "null", None, _msg(2, ent=None)]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    dec = TP.decode_json_values(df, TP.live_schema_with_seq())
    good = TP.accepted(dec).collect()
    assert sorted(r.seq for r in good) == [1, 2]
    assert TP.rejected(dec).count() == 6
    # a missing field is null, not a rejection
    miss = spark.createDataFrame([('{"seq": 9, "Device_ID": "X"}',)], "value string")
    r = TP.accepted(TP.decode_json_values(miss, TP.live_schema_with_seq())).collect()[0]
    assert r.seq == 9 and r.Entering_Chilled_Water_Temperature_Sensor is None


def _stream(spark, src):
    values = TP.file_value_stream(spark, src, max_files_per_trigger=1)
    return TP.accepted(TP.decode_json_values(values, TP.live_schema_with_seq()))


def test_drain_twice_reads_only_new(spark, tmp_dir):
    src, out, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    _write_lines(src, "a.json", [_msg(i) for i in range(3)])
    L.start_dump_json(_stream(spark, src), out, ck).awaitTermination()
    schema = TP.live_schema_with_seq()
    assert spark.read.schema(schema).json(out).count() == 3
    _write_lines(src, "b.json", [_msg(i) for i in range(3, 5)])
    L.start_dump_json(_stream(spark, src), out, ck).awaitTermination()
    assert spark.read.schema(schema).json(out).count() == 5
    L.start_dump_json(_stream(spark, src), out, ck).awaitTermination()
    assert spark.read.schema(schema).json(out).count() == 5


def test_drain_chases_until_quiet(spark, tmp_dir):
    src, out, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    os.makedirs(src)
    arriving = [[0, 1], [], [2, 3, 4], [], [], [5]]  # before each run; the last comes after the drain's end
    runs = iter(enumerate(arriving))

    def run():
        k, seqs = next(runs)
        if seqs:
            _write_lines(src, f"{k}.json", [_msg(i) for i in seqs])
        return L.start_dump_json(_stream(spark, src), out, ck)

    found = L.drain_until_quiet(run, quiet_polls=2, pause=0.0)
    assert (found.rows, found.runs, found.quiet) == (5, 5, True)
    schema = TP.live_schema_with_seq()
    assert sorted(r.seq for r in spark.read.schema(schema).json(out).collect()) == [0, 1, 2, 3, 4]
    again = L.drain_until_quiet(run, quiet_polls=1, pause=0.0, timeout=0.0)
    assert (again.rows, again.runs, again.quiet) == (0, 0, False)  # no time, nothing read, nothing lost
    assert L.drain_until_quiet(lambda: L.start_dump_json(_stream(spark, src), out, ck), 1, 0.0).rows == 0
    _write_lines(src, "late.json", [_msg(5)])
    assert L.drain_until_quiet(lambda: L.start_dump_json(_stream(spark, src), out, ck), 1, 0.0).rows == 1


def test_drain_of_an_empty_source_ends(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/src")
    found = L.drain_until_quiet(lambda: L.start_dump_json(_stream(spark, f"{tmp_dir}/src"), f"{tmp_dir}/out", f"{tmp_dir}/ck"), 2, 0.0)
    assert (found.rows, found.runs, found.quiet) == (0, 2, True)


def test_drain_ends_when_its_time_is_up(spark, tmp_dir):
    src, n = f"{tmp_dir}/src", iter(range(1000))

    def run():
        k = next(n)
        _write_lines(src, f"{k}.json", [_msg(k)])
        return L.start_dump_json(_stream(spark, src), f"{tmp_dir}/out", f"{tmp_dir}/ck")

    found = L.drain_until_quiet(run, quiet_polls=1, pause=0.0, timeout=3.0)
    assert not found.quiet and found.rows == found.runs > 0


def test_fallback_only_when_empty(spark):
    schema = TP.live_schema_with_seq()
    empty = spark.createDataFrame([], schema)
    fb = live(spark, SF_SMALL)
    assert TP.empty_source_fallback(empty, fb) is fb
    some = fb.limit(3)
    assert TP.empty_source_fallback(some, fb) is some


@pytest.fixture(scope="module")
def live_files(spark):
    import tempfile

    from pyspark.sql import functions as F

    d = tempfile.mkdtemp(prefix="frostlake-live-")
    lv = live(spark, SF_SMALL)
    lv.repartitionByRange(4, F.col("seq")).write.option("ignoreNullFields", "false").json(f"{d}/src")
    return d, lv


def _run_views(spark, src, checkpoint, **options):
    L.start_live_views(_stream(spark, src), checkpoint, available_now=True, **options).awaitTermination()
    return L.read_live_views(spark, checkpoint, **{k: v for k, v in options.items() if k == "n"})


def _assert_views_equal(views, messages, n=100):
    ok = L.accepted_live(messages)
    assert views["last_n_readings"].collect() == L.last_n_readings(ok, n).collect()
    assert views["live_points"].collect() == L.live_points(ok, 20).collect()
    assert views["latest_reading"].collect() == L.latest_reading(ok).collect()
    assert views["messages_received"].collect() == L.messages_received(ok).collect()
    assert views["live_kpis"].collect() == L.live_kpis(L.latest_reading(ok)).collect()


def test_stream_equals_batch(spark, live_files, tmp_dir):
    d, lv = live_files
    assert L.read_live_views(spark, f"{tmp_dir}/ck") == {}
    _assert_views_equal(_run_views(spark, f"{d}/src", f"{tmp_dir}/ck"), lv)
    # the state is bounded: up to n messages a shard
    newest = spark.read.format("statestore").option("path", f"{tmp_dir}/ck").option("stateVarName", "newest").load()
    assert newest.count() <= SHARDS * 100


def test_restart_from_checkpoint(spark, tmp_dir):
    src, ck = f"{tmp_dir}/src", f"{tmp_dir}/ck"
    _write_lines(src, "a.json", [_msg(i) for i in range(0, 150)])
    first = _run_views(spark, src, ck)
    assert first["messages_received"].collect()[0][0] == 150
    _write_lines(src, "b.json", [_msg(i) for i in range(150, 180)] + [_msg(999, ent=None)])
    views = _run_views(spark, src, ck)
    assert [r.seq for r in views["last_n_readings"].collect()] == list(range(80, 180))
    assert views["messages_received"].collect()[0][0] == 180 and views["latest_reading"].collect()[0].seq == 179
    # nothing new: nothing changes
    again = _run_views(spark, src, ck)
    assert again["messages_received"].collect()[0][0] == 180


def test_batch_that_was_not_committed_is_run_again(spark, tmp_dir):
    """Offsets are logged and the state may be written, but the process ended before the commit."""
    src, ck = f"{tmp_dir}/src", f"{tmp_dir}/ck"
    for k in range(3):
        _write_lines(src, f"{k}.json", [_msg(i) for i in range(k * 60, k * 60 + 60)])
    whole = _run_views(spark, src, ck)
    want = {k: v.collect() for k, v in whole.items()}
    last = max(int(n) for n in os.listdir(f"{ck}/commits") if n.isdigit())
    assert last == 2
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(f"{ck}/commits/{name}"):
            os.remove(f"{ck}/commits/{name}")
    assert L.read_live_views(spark, ck)["messages_received"].collect()[0][0] == 120  # what is committed
    views = _run_views(spark, src, ck)
    assert {k: v.collect() for k, v in views.items()} == want


def test_stopped_query_goes_on(spark, live_files, tmp_dir):
    """Stopped after some batches, and started again: as if it had not been stopped."""
    d, lv = live_files
    q = L.start_live_views(_stream(spark, f"{d}/src"), f"{tmp_dir}/ck", processing_time="0 seconds")
    while q.lastProgress is None and q.exception() is None:
        time.sleep(0.05)
    q.stop()
    _assert_views_equal(_run_views(spark, f"{d}/src", f"{tmp_dir}/ck"), lv)


def test_new_checkpoint_is_a_new_state(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    _write_lines(src, "a.json", [_msg(i) for i in range(30)])
    _run_views(spark, src, f"{tmp_dir}/one")
    views = _run_views(spark, src, f"{tmp_dir}/two", n=7)
    assert views["messages_received"].collect()[0][0] == 30
    assert [r.seq for r in views["last_n_readings"].collect()] == list(range(23, 30))


def test_archive_comes_from_the_same_query(spark, live_files, tmp_dir):
    d, lv = live_files
    views = _run_views(spark, f"{d}/src", f"{tmp_dir}/ck", archive=f"{tmp_dir}/archive")
    _assert_views_equal(views, lv)
    archived = spark.read.schema(lv.schema).json(f"{tmp_dir}/archive").select(lv.columns)
    assert archived.exceptAll(lv).isEmpty() and lv.exceptAll(archived).isEmpty()


def test_struct_arrival_order_like_kafka(spark, tmp_dir):
    """Kafka arrival order is (timestamp, partition, offset); the views accept
    any orderable column, including that struct."""
    import datetime as dt

    from pyspark.sql import functions as F

    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(seconds=i // 3), i % 3, i, 70.0, f"D{i}") for i in range(30)]
    df = spark.createDataFrame(rows, "ts timestamp, p int, o long, Entering_Chilled_Water_Temperature_Sensor double, "
                                     "Device_ID string")
    df = df.select(F.struct("ts", F.col("p").alias("partition"), F.col("o").alias("offset")).alias("seq"),
                   "Entering_Chilled_Water_Temperature_Sensor", "Device_ID")
    for k in (0, 1):
        df.where(F.col("seq.offset").between(20 * k, 20 * k + 19)).coalesce(1).write.parquet(f"{tmp_dir}/src/k={k}")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", "1").parquet(f"{tmp_dir}/src/*")
    L.start_live_views(stream, f"{tmp_dir}/ck", n=5, available_now=True).awaitTermination()
    latest, last = (read_state(spark, f"{tmp_dir}/ck", v) for v in ("latest", "newest"))
    assert [r.seq.offset for r in L.last_n_readings(last, 5).collect()] == [25, 26, 27, 28, 29]
    assert L.latest_reading(latest).collect()[0].Device_ID == "D29"


def test_stream_rejects_bad_messages_and_counts_accepted(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    lines = [_msg(1), "{broken", "[1, 2]", "", _msg(2, ent=None), "42", _msg(3), "null", _msg(4)]
    _write_lines(src, "a.json", lines)
    v = _run_views(spark, src, f"{tmp_dir}/ck", archive=f"{tmp_dir}/archive")
    assert v["messages_received"].collect()[0][0] == 3  # 1, 3, 4: decodable and with a temperature
    assert [r.seq for r in v["last_n_readings"].collect()] == [1, 3, 4]
    assert v["latest_reading"].collect()[0].seq == 4
    archived = spark.read.json(f"{tmp_dir}/archive").select("seq").collect()
    assert sorted(r.seq for r in archived) == [1, 2, 3, 4]  # the archive keeps every decoded message


def test_decode_keeps_records_with_bad_fields(spark):
    from frostlake.sources.topics import accepted, decode_json_values, rejected

    values = [
        '{"Pump_Hours":1234.5,"Device_ID":"a"}', '{"Pump_Hours":1000.0,"Device_ID":"b"}', '{"CO2_Level_PPM":"n/a","Device_ID":"c"}',
        '{"Entering_Chilled_Water_Temperature_Sensor":"70.0","Device_ID":"d"}', '{"Device_ID":"e","Pump_Hours":{"x":1}}', '{"CO2_Level_PPM":"512","Device_ID":"f"}',
        "[1, 2]", "7", '"text"', "null", "{broken", "", None,
    ]
    decoded = decode_json_values(spark.createDataFrame([(v,) for v in values], "value string"))
    got = {r["Device_ID"]: r for r in accepted(decoded).collect()}
    assert sorted(got) == list("abcdef")
    assert [got[k]["Pump_Hours"] for k in "abe"] == [None, 1000, None]
    assert (got["c"]["CO2_Level_PPM"], got["f"]["CO2_Level_PPM"]) == (None, 512)
    assert got["d"]["Entering_Chilled_Water_Temperature_Sensor"] == 70.0
    assert rejected(decoded).count() == 7


def test_a_task_sends_no_more_than_the_newest(spark):
    """Of a task's messages only the newest n of each shard go to the state, and their counts say how many there were."""
    import random

    import pyarrow as pa

    from frostlake.streaming.state import _COUNTS, _SHARD, Newest

    draw = random.Random(5)
    rows = [(k % 3, draw.choice([None, *range(40)]), draw.choice([None, "a", "b"]), k) for k in range(500)]
    schema = pa.schema([(_SHARD, pa.int32()), ("t", pa.int64()), ("u", pa.string()), ("k", pa.int64()), (_COUNTS, pa.int64())])
    batch = lambda part: pa.RecordBatch.from_pylist([dict(zip(schema.names, (*r, 1))) for r in part], schema)
    parts = [rows[i : i + 60] for i in (0, 60, 120, 120, 180, 240, 300, 360, 420, 480)]  # one comes twice
    sent = [r for b in Newest(7, ["t", "u"])(batch(part) for part in parts) for r in b.to_pylist()]
    seen = [r for part in parts for r in part]
    for shard in range(3):
        own = [(r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", at, r[3]) for at, r in enumerate(seen) if r[0] == shard]
        got = [r for r in sent if r[_SHARD] == shard]
        assert sorted(r["k"] for r in got) == sorted(r[-1] for r in sorted(own)[-7:])
        assert sum(r[_COUNTS] for r in got) == len(own)
    assert len(sent) == 21 and list(Newest(7, ["t"])(iter([]))) == []


def test_views_read_few_messages_of_many(spark, tmp_dir):
    """The stateful step gets the newest of each task, not every message; the views are those of all messages."""
    src, ck = f"{tmp_dir}/src", f"{tmp_dir}/ck"
    _write_lines(src, "a.json", [_msg(i) for i in range(2000)])
    q = L.start_live_views(_stream(spark, src), ck, n=5, available_now=True)
    q.awaitTermination()
    assert "MapInArrow" in q._jsq.explainInternal(False)
    views = L.read_live_views(spark, ck, n=5)
    assert [r.seq for r in views["last_n_readings"].collect()] == list(range(1995, 2000))
    assert views["messages_received"].collect()[0][0] == 2000 and views["latest_reading"].collect()[0].seq == 1999
