"""D1-D4 (timestamp, date, hour, shift) agree between Spark and the DuckDB
oracle text on edge epochs: negative, sub-second, range bounds, text forms."""

from __future__ import annotations

import duckdb
from conftest import raw_df, raw_row

from frostlake.operators.silver import cast_sensors, silver
from frostlake.plans.oracle import _silver

EPOCHS = [
    "0", "-1", "-999", "-1000", "-1500", "999", "1704067199999", "1704067200000", "1704110399999",
    "253402300799000", "253402300799999", "253402300800000", "-2208988800000", "-2208988799500",
    "-62135596801000",  # a second before year 1: null (year 1 itself cannot be collected into Python)
    "1e3", "1.5e12", "1704067200000.7", "abc", "", None, " 1704067200000", "1704067200000 ",
]


def test_epoch_derivations_same_in_both_engines(spark):
    raw = raw_df(spark, [raw_row(timestamp=e) for e in EPOCHS])
    cols = ["timestamp", "timestamp_formatted", "Date", "Hour_of_Day", "Operational_Shift"]
    got = sorted((tuple(r) for r in silver(raw).select(*cols).collect()), key=repr)
    typed = cast_sensors(raw).toPandas()
    con = duckdb.connect()
    con.register("typed_df", typed)
    con.execute("CREATE TABLE silver_typed AS SELECT * FROM typed_df")
    want = sorted(con.execute(f"SELECT {', '.join(cols)} FROM ({_silver()})").fetchall(), key=repr)
    assert got == want
