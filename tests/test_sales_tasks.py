"""Tasks that hold the sales: as many as the lines ask for."""

from pyspark.sql import functions as F

from tillstar.plans.catalog import RetailTables
from tillstar.sources import star_tables

FOLDER = "/root/testdata/sf0.001"


def sales(spark):
    return star_tables.raw_frame(spark, FOLDER, "raw_transactions")


def test_a_task_holds_a_bounded_number_of_lines(spark, monkeypatch):
    whole = sorted(map(str, sales(spark).collect()))
    monkeypatch.setattr(star_tables, "LINES_PER_TASK", 300)
    spread = sales(spark)
    parts = spread.groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == -(-len(whole) // 300) and max(r["count"] for r in parts) < 2 * 300
    assert sorted(map(str, spread.collect())) == whole


def test_few_lines_are_left_to_the_planner(spark):
    assert star_tables.sales_tasks(star_tables.read_table(spark, FOLDER, "lineitem")) is None


def test_a_fact_joins_the_sales_once(spark):
    """Its digests, receipts and lines are read from the raw sales as they were written."""
    tables = RetailTables(spark, FOLDER)
    whole = sorted(map(str, tables.sales.collect()))
    fact = tables.fact
    for frame in (fact, tables.split.rejected, tables.flagged, tables.keyless_fact):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "l_orderkey" not in plan
    assert sorted(map(str, tables.sales.collect())) == whole
