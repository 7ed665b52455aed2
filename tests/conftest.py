from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from frostlake.session import build_session

    ckpt = tempfile.mkdtemp(prefix="frostlake-test-ckpt-")
    s = build_session(
        "local[4]",
        app_name="frostlake-tests",
        shuffle_partitions=8,
        extra_conf={"spark.checkpoint.dir": ckpt},
    )
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="frostlake-test-")


def raw_row(**overrides):
    """One valid raw reading (all text), with overrides."""
    from frostlake.schema import RAW_FIELDS

    base = {f: "1.0" for f in RAW_FIELDS}
    base.update(
        {
            "timestamp": "1704110400000",  # 2024-01-01 12:00:00 UTC
            "Device_ID": "CHILLER_01",
            "Entering_Chilled_Water_Temperature_Sensor": "70.0",
            "Leaving_Chilled_Water_Temperature_Sensor": "41.0",
            "Leaving_Chilled_Water_Temperature_Setpoint": "40.00001525878906",
            "Active_Fault_Code": "0",
            "CO2_Level_PPM": "500",
            "Filter_Pressure_Drop_Pa": "100.0",
            "Pump_Relay_1_Status": "1",
        }
    )
    base.update(overrides)
    return tuple(base[f] for f in RAW_FIELDS)


def raw_df(spark, rows):
    from frostlake.schema import RAW_SCHEMA

    return spark.createDataFrame(rows, RAW_SCHEMA)
