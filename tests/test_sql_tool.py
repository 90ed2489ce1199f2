"""Read-only SQL tool: only SELECT / WITH / EXPLAIN, and no DML hidden behind WITH."""

import pytest

from tidewatch.plans.sql_tool import ReadOnlyViolation, read_only_sql


@pytest.fixture()
def view(spark):
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string").createOrReplaceTempView("t_tool")
    return "t_tool"


def test_select_and_with_keep_order(spark, view):
    assert [r["id"] for r in read_only_sql(spark, f"SELECT id FROM {view} ORDER BY id DESC").collect()] == [2, 1]
    assert read_only_sql(spark, f"  with x AS (SELECT * FROM {view}) SELECT count(*) AS n FROM x").first()["n"] == 2


def test_explain_returns_plan(spark, view):
    rows = read_only_sql(spark, f"EXPLAIN SELECT * FROM {view}").collect()
    assert len(rows) == 1 and "plan" in rows[0].asDict()


@pytest.mark.parametrize("q", ["DROP VIEW t_tool", "INSERT INTO t_tool VALUES (3, 'c')", "DELETE FROM t_tool",
                               "CREATE TABLE z AS SELECT 1"])
def test_prefix_guard(spark, view, q):
    with pytest.raises(ReadOnlyViolation):
        read_only_sql(spark, q)


@pytest.mark.parametrize("q", ["WITH x AS (SELECT 1) INSERT INTO t_tool SELECT 3, 'c'",
                               "EXPLAIN INSERT INTO t_tool VALUES (3, 'c')"])
def test_dml_behind_allowed_prefix_is_rejected(spark, view, q):
    with pytest.raises(Exception):
        read_only_sql(spark, q)
    assert spark.table(view).count() == 2


@pytest.mark.parametrize("query", [
    "SELECT reflect('java.lang.System', 'getProperty', 'user.name')",
    "SELECT java_method('java.lang.Math', 'abs', -1)",
    "SELECT x FROM (SELECT try_reflect('java.lang.Math', 'abs', -1) AS x)",
    "SELECT * FROM parquet.`/root/testdata/sf0.001/region.parquet`",
    "WITH a AS (SELECT 1) SELECT * FROM a JOIN json.`/tmp/x` ON true",
    "DELETE FROM articles", "selectall FROM articles", ""])
def test_guard_refuses(spark, query):
    spark.range(3).createOrReplaceTempView("numbers")
    with pytest.raises(Exception) as caught:
        read_only_sql(spark, query)
    assert isinstance(caught.value, (ReadOnlyViolation,)) or "PATH_NOT_FOUND" in str(caught.value)


def test_guard_lets_views_and_ctes_through(spark):
    spark.range(3).createOrReplaceTempView("numbers")
    assert read_only_sql(spark, "WITH a AS (SELECT id FROM numbers) SELECT count(*) AS n FROM a;").first()["n"] == 3
    assert read_only_sql(spark, "EXPLAIN SELECT * FROM numbers").count() == 1
    assert [r[0] for r in read_only_sql(spark, "SELECT\nid FROM numbers ORDER BY id DESC").collect()] == [2, 1, 0]
