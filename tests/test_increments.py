"""Gold from day states equals gold from all of silver, whatever the order of refreshes."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import SF_SMALL

from frostlake.operators.gold import GOLD_TABLES, gold_tables
from frostlake.operators.silver import silver
from frostlake.operators.staging import staging
from frostlake.plans.increments import gold_from_states, refresh_days
from frostlake.sinks.files import materialize, write_layer
from frostlake.sources.fixtures import telemetry


@pytest.fixture(scope="module")
def slv(spark):
    stg = staging(telemetry(spark, SF_SMALL))
    # some readings without a day
    odd = stg.limit(5).withColumn("timestamp", stg["timestamp"].substr(1, 0))
    return materialize(silver(stg.unionByName(odd)), "silver")[0]


def rows(df):
    return sorted(str(r) for r in df.collect())


def test_all_tables_after_late_readings_and_replays(spark, slv, tmp_dir):
    root = f"{tmp_dir}/lake"
    with pytest.raises(ValueError):
        gold_from_states(spark, root)
    days = [r["Date"] for r in slv.select("Date").distinct().orderBy("Date").collect()]
    assert None in days
    refresh_days(slv.where("Hour_of_Day < 9"), root)  # the late readings are missing, and so is the day null
    refresh_days(slv, root, days[: len(days) // 2])
    refresh_days(slv, root, days[len(days) // 3 :])
    refresh_days(slv, root, days[:2])  # a replay
    got, want = gold_from_states(spark, root), gold_tables(slv, "direct")
    assert list(got) == list(GOLD_TABLES)
    for name in GOLD_TABLES:
        assert got[name].schema.simpleString() == want[name].schema.simpleString(), name
        assert rows(got[name]) == rows(want[name]), name


def test_emptied_day_and_unfinished_refresh(spark, slv, tmp_dir):
    root = f"{tmp_dir}/lake"
    refresh_days(slv, root)
    gone = slv.where("Date IS NOT NULL").agg({"Date": "min"}).first()[0]
    rest = slv.where(slv["Date"].isNull() | (slv["Date"] != gone))
    refresh_days(rest, root, [gone, dt.date(1999, 1, 1)])
    # a refresh that fails before its list of days is written
    write_layer(slv.limit(3), f"{root}/_gold_states/0000000003/hourly")
    got, want = gold_from_states(spark, root), gold_tables(rest, "direct")
    for name in ("fact_hourly_telemetry", "mart_valve_operations", "dim_status_flags", "fact_fault_events"):
        assert rows(got[name]) == rows(want[name]), name
    refresh_days(slv, root, [gone])
    assert rows(gold_from_states(spark, root)["mart_daily_costs"]) == rows(gold_tables(slv, "direct")["mart_daily_costs"])
