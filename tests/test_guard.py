"""Free SQL: what may run and what is refused, by the analysed plan."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import functions as F

from frostlake.plans import serving as S
from frostlake.plans.guard import QueryRefused


@pytest.fixture(scope="module")
def views(spark):
    spark.range(2000).withColumn("Limit_X", F.col("id") % 7).createOrReplaceTempView("guarded_a")
    spark.range(5).createOrReplaceTempView("guarded_b")
    return ["guarded_a", "guarded_b"]


ALLOWED = {
    "SELECT count(*) AS n FROM guarded_a;": 1,
    "SELECT * FROM guarded_a JOIN guarded_b USING (id)": 5,
    "WITH x AS (SELECT id FROM guarded_b), y AS (SELECT id FROM x WHERE id > 1) SELECT * FROM y UNION ALL SELECT * FROM x": 8,
    "SELECT id, row_number() OVER (ORDER BY id) AS r, (SELECT max(id) FROM guarded_a) AS m FROM guarded_b WHERE EXISTS (SELECT 1 FROM guarded_a WHERE guarded_a.id = guarded_b.id)": 5,
    "SELECT * FROM guarded_a WHERE id IN (SELECT id FROM guarded_b) ORDER BY id": 5,
    "SELECT explode(sequence(1, 3)) AS x": 3,
    "SELECT * FROM range(4)": 4,
    "VALUES (1, 'java_method'), (2, 'parquet.`/tmp`')": 2,
    "SELECT id AS reflect, 'TRANSFORM' AS t FROM guarded_b -- LIMIT 2": 5,
    "SELECT Limit_X, count(*) AS n FROM guarded_a GROUP BY ROLLUP(Limit_X)": 8,
    "SELECT id FROM guarded_b LATERAL VIEW explode(array(1, 2)) t AS x": 10,
    "SELECT upper(to_json(named_struct('a', id))) AS j, transform(array(id), v -> v + 1) AS t FROM guarded_b": 5,
}


@pytest.mark.parametrize("text", ALLOWED)
def test_queries_over_views_run(spark, views, text):
    assert S.run_sql(spark, text, views=views).count() == ALLOWED[text]


REFUSED = [
    "SELECT java_method('java.lang.System', 'getProperty', 'user.home') AS x",
    "SELECT reflect('java.util.UUID', 'randomUUID') AS x FROM guarded_b",
    "SELECT id FROM guarded_b WHERE length(try_reflect('java.lang.System', 'getenv', 'HOME')) > id",
    "SELECT id, (SELECT java_method('java.lang.Math', 'abs', -1)) AS x FROM guarded_b",
    "WITH c AS (SELECT java_method('java.lang.Math', 'abs', -1) AS x) SELECT * FROM c",
    "SELECT transform(array(1), v -> java_method('java.lang.Math', 'abs', v)) AS x",
    "SELECT id FROM guarded_b ORDER BY reflect('java.lang.Math', 'random')",
    "SELECT added_function(id) AS x FROM guarded_b",
    "SELECT added_python(id) AS x FROM guarded_b",
    "SELECT TRANSFORM (id) USING 'cat' AS (x STRING) FROM guarded_b",
    "SELECT * FROM parquet.`{path}`",
    "SELECT * FROM guarded_b WHERE id IN (SELECT id FROM parquet.`{path}`)",
    "SELECT * FROM text.`/etc/hostname`",
    "SELECT * FROM unlisted_view",
]


@pytest.fixture()
def outside(spark, tmp_dir):
    spark.range(3).write.parquet(f"{tmp_dir}/t")
    spark.range(3).createOrReplaceTempView("unlisted_view")
    spark.udf.register("added_python", lambda x: x, "long")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION added_function(x BIGINT) RETURNS STRING RETURN java_method('java.lang.Math', 'abs', CAST(x AS INT))")
    return f"{tmp_dir}/t"


@pytest.mark.parametrize("text", REFUSED)
def test_what_reaches_outside_the_views_is_refused(spark, views, outside, text):
    with pytest.raises(QueryRefused):
        S.run_sql(spark, text.replace("{path}", outside), views=views)


@pytest.mark.parametrize("text", ["DROP VIEW guarded_b", "CREATE TABLE t AS SELECT 1", "INSERT INTO guarded_b VALUES (1)", "SET x = 1", "SHOW TABLES", "SELECT 1; SELECT 2", ""])
def test_other_statements_do_not_run(spark, views, text):
    with pytest.raises((ParseException, AnalysisException)):
        S.run_sql(spark, text, views=views)
    assert spark.table("guarded_b").count() == 5


def test_the_cap_looks_at_the_last_step(spark, views):
    assert S.run_sql(spark, "SELECT * FROM guarded_a", cap=1000, views=views).count() == 1000
    assert S.run_sql(spark, "SELECT Limit_X FROM guarded_a", cap=1000, views=views).count() == 1000  # a name is no limit
    assert S.run_sql(spark, "SELECT * FROM guarded_a LIMIT 1500", cap=1000, views=views).count() == 1500
    assert S.run_sql(spark, "SELECT * FROM guarded_a ORDER BY id LIMIT 1500", cap=1000, views=views).count() == 1500
    assert S.run_sql(spark, "SELECT * FROM (SELECT * FROM guarded_a LIMIT 1500)", cap=1000, views=views).count() == 1000
    full = S.query_response(spark, None, "SELECT * FROM guarded_a LIMIT 1200")
    assert len(full["data"]) == 1200 and not full["truncated"]
    cut = S.query_response(spark, None, "SELECT * FROM guarded_a")
    assert len(cut["data"]) == 1000 and cut["truncated"]
