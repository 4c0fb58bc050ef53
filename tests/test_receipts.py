"""The layout by receipt: same results without a shuffle of the sales."""

import io
from contextlib import redirect_stdout

import pytest

from conftest import SALES, sale
from tillstar.operators import constraints
from tillstar.operators.fact import without_flagged
from tillstar.sources import receipts


@pytest.fixture
def laid_out(spark, text_frame, tmp_path):
    lines = [sale(receipt_no=f"R{k % 37}" if k % 5 else "hot", product_sold=f"p{k % 3}")
             for k in range(400)] + [sale(receipt_no=None, product_sold="p1")] * 3
    sales = text_frame(SALES, *lines)
    name = f"receipts_{tmp_path.name.replace('-', '_')}"
    return sales, receipts.write_by_receipt(sales, name, str(tmp_path), 4, hot_lines=50)


def rows(df):
    return sorted(map(str, df.collect()))


def plan(df):
    with redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


def test_hot_receipts_and_lines_without_one_stand_apart(laid_out):
    sales, by_receipt = laid_out
    assert {r.receipt_no for r in by_receipt.hot.collect()} == {"hot", None}
    assert rows(by_receipt.bucketed.unionByName(by_receipt.hot)) == rows(sales)


def test_results_equal_those_of_the_plain_table(laid_out, text_frame):
    sales, by_receipt = laid_out
    flagged = text_frame("receipt_no", ("R3",), ("hot",), ("R99",), (None,))
    assert rows(receipts.exclude_flagged(by_receipt, flagged)) == rows(
        without_flagged(sales, flagged).select(*sales.columns))
    assert rows(receipts.repeated_keys(by_receipt, "product_sold")) == rows(
        constraints.repeated_keys(sales, ["receipt_no", "product_sold"]))


def test_bucketed_sales_are_not_shuffled(spark, laid_out, text_frame):
    _, by_receipt = laid_out
    flagged = text_frame("receipt_no", *[(f"R{k}",) for k in range(9)])
    keys = constraints.repeated_keys(by_receipt.bucketed, ["receipt_no", "product_sold"])
    assert "Exchange" not in plan(keys)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(without_flagged(by_receipt.bucketed, flagged))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64m")
    sales_side, flagged_side = text.split("SortMergeJoin")[1].split(":- ")[1].split("+- Sort", 1)
    assert "Exchange" not in sales_side and "Exchange" in text
    assert "Bucketed: true" in sales_side
