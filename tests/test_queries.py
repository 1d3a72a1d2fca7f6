import re

import pytest

import compare
from shelfledger.plans import oracle, registry, warehouse

SF = str(compare.DATA / "sf0.001")
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = compare.connect(SF)
    yield connection
    connection.close()


def test_every_query_has_its_sql():
    assert set(registry.queries()) == set(SQL)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, duck, name):
    names, rows = compare.spark_rows(registry.queries()[name](spark, SF))
    expected_names, expected = compare.sql_rows(duck, SQL[name])
    assert names == expected_names
    assert rows == expected


def test_no_python_in_any_plan(spark):
    for name, query in registry.queries().items():
        plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan, name
        assert "CartesianProduct" not in plan, name
        if name not in ("price_histogram_auto", "stream_accounting"):  # one row on one side
            assert "NestedLoop" not in plan, name


def test_reports_read_only_what_they_need(spark):
    plan = registry.queries()["date_filtered_prices"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(accepted" in plan
    assert "GreaterThanOrEqual(event_time" in plan
    assert "raw_record" not in plan and "failures" not in plan


def test_generated_code_can_be_compiled(spark):
    """The JVM does not compile methods beyond 8000 bytes of bytecode."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        frame = warehouse.decide(spark, SF)[1]
        debug = spark._jvm.org.apache.spark.sql.execution.debug
        module = getattr(getattr(debug, "package$"), "MODULE$")
        text = module.codegenString(frame._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(-?\d+)", text)]
    assert sizes and 0 < max(sizes) < 8000
