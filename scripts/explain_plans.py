"""Print the physical plans of the main operators over a written lake and
check the properties the design relies on (pushdown, pruning, partial
aggregation, codegen, no unexpected broadcast).

    python scripts/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from frostlake.operators import gold as G  # noqa: E402
from frostlake.operators.staging import staging  # noqa: E402
from frostlake.plans import serving as S  # noqa: E402
from frostlake.plans.conformance import CONFORMANCE  # noqa: E402
from frostlake.plans.medallion import run_pipeline  # noqa: E402
from frostlake.session import build_session  # noqa: E402
from frostlake.sources.fixtures import telemetry  # noqa: E402
from frostlake.sources.lake import read_layer  # noqa: E402


def final_plan_text(df) -> str:
    """The executed (final, post-AQE) plan: run the query, then read it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def partial_rows(df) -> tuple[int, int]:
    """(rows of the partial aggregate, groups) of a one-aggregate query, from the plan's own metrics."""
    groups = len(df.collect())
    node = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(p):
        if p.nodeName() == "AdaptiveSparkPlan":
            return walk(p.executedPlan())
        if p.nodeName().endswith("QueryStage"):
            return walk(p.plan())
        if p.nodeName() == "HashAggregate" and "partial_" in p.toString().splitlines()[0]:
            found.append(int(p.metrics().apply("numOutputRows").value()))
        for i in range(p.children().size()):
            walk(p.children().apply(i))

    walk(node)
    return found[-1], groups


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    lake = tempfile.mkdtemp(prefix="frostlake-plans-")
    run_pipeline(spark, telemetry(spark, sf_dir), lake)
    S.register_lake_views(spark, lake)
    batch = read_layer(spark, lake, "batch")
    silver = read_layer(spark, lake, "silver")
    cases = {
        "staging": staging(batch),
        "mart_daily_costs (direct)": G.gold_table(silver, "mart_daily_costs"),
        "fact_fault_events": G.gold_table(silver, "fact_fault_events"),
        "hourly_partials": G.hourly_partials(silver),
        "dimension_sets": G.dimension_sets(silver),
        "page_table(silver)": S.page_table(silver, 3, 50),
        "sql_left_join_costs_breaches": spark.sql(CONFORMANCE["sql_left_join_costs_breaches"][0]),
    }
    got, groups = partial_rows(G.hourly_partials(silver))
    print(f"hourly_partials over {len(silver.inputFiles())} files: {got} partial rows for {groups} groups ({got / groups:.2f})")
    for name, df in cases.items():
        print(f"\n===== {name}")
        df.explain("formatted")
        text = final_plan_text(df)
        print(
            f"-- final plan: codegen={'*(' in text} partial_agg={'partial_' in text or 'HashAggregate' in text} "
            f"broadcast={'Broadcast' in text} sort_merge={'SortMergeJoin' in text}"
        )
    spark.stop()


if __name__ == "__main__":
    main()
