import io
from contextlib import redirect_stdout

import pytest

from tillstar.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plan(spark):
    seen = {}

    def explain(name):
        if name not in seen:
            with redirect_stdout(io.StringIO()) as out:
                QUERIES[name](spark, SF).explain()
            seen[name] = out.getvalue()
        return seen[name]

    return explain


@pytest.mark.parametrize(
    "name", ["exclude_flagged", "unmatched_products", "unmatched_staff", "validation_log",
             "fk_orphans", "dim_date_upsert"])
def test_absence_is_an_anti_join(plan, name):
    assert "LeftAnti" in plan(name)


@pytest.mark.parametrize("name", ["fact_transactions", "stg_transactions", "validation_log",
                                  "dim_customers", "row_outcomes", "stg_transactions_rejected"])
def test_no_python_no_cross_join_no_whole_table_window(plan, name):
    text = plan(name)
    for node in ("PythonUDF", "ArrowEvalPython", "MapInPandas", "CartesianProduct",
                 "BroadcastNestedLoopJoin"):
        assert node not in text, node
    if name != "dim_customers" and name != "fact_transactions":
        assert "Window" not in text


def test_only_file_sizes_meet_in_one_task(plan):
    """The one window of numbered tables runs over one row per written file."""
    for name in ("dim_customers", "fact_transactions", "dim_products"):
        blocks = plan(name).split("Window ")[1:]
        assert blocks and all("file_rows" in b.split("\n")[0] for b in blocks), name


def test_orders_are_merged_not_broadcast(plan):
    assert "SortMergeJoin [l_orderkey" in plan("raw_transactions")


def test_scans_read_only_needed_columns(plan):
    scans = [line for line in plan("check_range").split("\n") if "ReadSchema" in line]
    lineitem = next(s for s in scans if "lineitem.parquet" in s)
    assert "l_extendedprice" not in lineitem and "l_quantity" in lineitem
    assert not any("p_name" in s for s in scans)


def test_first_row_per_key_is_an_aggregate_after_a_narrow_lookup(plan):
    text = plan("stg_transactions")
    assert "partial_min(struct" in text and "key_digest" in text


def test_the_cube_expands_sums_from_one_scan(plan):
    text = plan("sales_cube")
    assert text.count("Expand") == 1
    assert text.count("lineitem.parquet") == plan("sales_by_category").count("lineitem.parquet")
    assert "HashAggregate(keys=[store_id" in text.split("Expand")[1]


def test_calendar_filters_prune_month_folders(spark):
    df = QUERIES["sales_on_days"](spark, SF)
    with redirect_stdout(io.StringIO()) as out:
        df.explain()
    scan = next(line for line in out.getvalue().split("\n") if "fact_by_month" in line)
    assert "PartitionFilters: [isnotnull(sale_month" in scan and "dynamicpruning" in scan
