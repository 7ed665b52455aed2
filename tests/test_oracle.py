"""Every registered query against its DuckDB text (the correctness gate), at
sf0.001 so the suite stays quick; scripts/oracle_check.py runs sf0.01."""

from __future__ import annotations

import collections
import datetime as dt
import math

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry
from frostlake.plans import registry

TABLES = ["events", "documents", "benchmark", "pages", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(repr(_norm(r[i])) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


KEYS = sorted(entry.oracle_sql())


def test_every_query_has_an_oracle_or_is_rows_only():
    rows_only = set(registry.queries()) - set(entry.oracle_sql())
    assert rows_only == {"pipeline_run_log", "lake_manifest"}
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    sdf = entry.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(entry.oracle_sql()[key])
    drows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert len(srows) == len(drows)
    assert _bag(sdf.columns, srows) == _bag(rel.columns, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["Date", "total_cost", "total_power"]
    assert df.count() > 0


def test_rows_only_queries_run(spark):
    qs = entry.queries()
    log = qs["pipeline_run_log"](spark, SF_SMALL).collect()
    stages = [r.stage for r in sorted(log, key=lambda r: r.seq)]
    assert [st for st in stages if st in ("raw", "batch", "staging", "silver")] == ["raw", "batch", "staging", "silver"]
    assert stages[-1] == "total"
    files = qs["lake_manifest"](spark, SF_SMALL).collect()
    rel = {r.relative_path.split("/")[0] for r in files}
    assert {"batch", "staging", "silver", "gold"} <= rel
    assert not any(p.relative_path.split("/")[-1].startswith(("_", ".")) for p in files)
    cat = qs["list_tables"](spark, SF_SMALL).collect()
    assert len(cat) == 18 and {"gold_mart_daily_costs", "silver"} <= {r.view_name for r in cat}
