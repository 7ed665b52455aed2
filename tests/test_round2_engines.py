"""round2 gives identical doubles in Spark and in the DuckDB oracle text,
including exact binary ties and six-decimal half-way values."""

from __future__ import annotations

import random

import duckdb

from frostlake.functions import round2
from frostlake.plans.oracle import round2 as duck_round2


def _values(n: int = 1000, seed: int = 7) -> list[float]:
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        out.append(rnd.uniform(-1e6, 1e6))
        out.append(rnd.randint(-10**6, 10**6) / 2 ** rnd.randint(1, 12))  # exact binary ties
        out.append(round(rnd.uniform(-500, 500), 6))
        out.append(rnd.randint(-10**8, 10**8) / 1000 + 0.0005)  # x.xxx5 half-way values
    return out + [1.005, 2.675, -2.675, 0.125, -0.125, 0.0, 999999999.995]


def test_round2_same_in_both_engines(spark):
    vals = _values()
    df = spark.createDataFrame(list(enumerate(vals)), "i long, x double")
    got = {r.i: r.y for r in df.select("i", round2("x").alias("y")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t(i BIGINT, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(vals)))
    want = dict(con.execute(f"SELECT i, {duck_round2('x')} FROM t").fetchall())
    assert [(vals[i], got[i], want[i]) for i in got if got[i] != want[i]] == []
