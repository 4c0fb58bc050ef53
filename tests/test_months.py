"""Keys that outlast a load, and loads that build touched months again."""

from datetime import date

import pytest

from conftest import SALES, sale
from tillstar import fixed_values as fixed
from tillstar.operators.dimensions import (
    build_dim_date,
    current_rows,
    date_spine,
    extend_dimension,
)
from tillstar.operators.fact import Dimensions, build_fact
from tillstar.operators.integrity import orphan_counts
from tillstar.operators.masters import STAGERS
from tillstar.operators.validation import duplicate_receipts, flagged_receipts
from tillstar.plans.months import MATCHED, MonthlySales

STORES = [("S001", "Accra", "Southern Region"), ("S002", "Tamale", "Northern Region")]
STAFF = [("E1", "Ama Mensah", "Cashier", "S001", "", "020", "45000", "Active"),
         ("E2", "Kofi", "Security", "S002", "", "", "", "Active")]
PRODUCTS = [("P1", "Rice 5kg", "Food", "10.5", "", ""), ("P2", "Oil", "Food", "3", "", "")]


@pytest.fixture
def masters(text_frame):
    def build(stores=STORES, staff=STAFF, products=PRODUCTS):
        lists = dict(stores=stores, staff=staff, products=products)
        return {n: STAGERS[n](text_frame(" ".join(fixed.MASTER_COLUMNS[n]), *lists[n]))
                for n in MATCHED}

    return build


@pytest.fixture
def dates(spark):
    return lambda last=date(2026, 12, 31): build_dim_date(
        date_spine(spark, date(2026, 1, 1), last))


def test_keys_stay_and_new_ones_follow(spark, text_frame, tmp_path):
    def staged(*products):
        return STAGERS["products"](text_frame(" ".join(fixed.MASTER_COLUMNS["products"]), *[
            (p, f"name {p}", "Food", price, "", "") for p, price in products]))

    first = extend_dimension("products", None, staged(("P2", "1"), ("P5", "2"), ("P9", "3")),
                             str(tmp_path / "1"))
    then = staged(("P9", "7"), ("P1", "1"), ("P3", "4"), ("P3", "4"), ("P2", "1"))
    both = extend_dimension("products", first, then, str(tmp_path / "2"))
    rows = {r.product_id: (r.product_key, str(r.unit_price_ghs)) for r in both.collect()}
    assert rows == {"P2": (1, "1.00"), "P5": (2, "2.00"), "P9": (3, "7.00"),
                    "P1": (4, "1.00"), "P3": (5, "4.00")}
    assert {r.product_id for r in current_rows("products", both, then).collect()} == {
        "P1", "P2", "P3", "P9"}
    third = extend_dimension("products", both, then.limit(0), str(tmp_path / "3"))
    assert sorted(third.collect()) == sorted(both.collect())


def add(monthly, text_frame, masters, dates, *lines):
    return monthly.add(text_frame(SALES, *lines), masters, dates)


def rows_of(df):
    return sorted(str({k: v for k, v in r.asDict().items()
                       if k not in ("transaction_key", "sale_month")}) for r in df.collect())


def files(monthly, state):
    fact = monthly.fact(state).select("sale_month", "_metadata.file_path").distinct().collect()
    return {r.sale_month: r.file_path for r in fact}


LOADS = [
    [sale(), sale(receipt_no="R2", timestamp="2026-07-01"), sale(receipt_no="R3"),
     *[sale(receipt_no="R9", product_sold=p, timestamp="2026-08-02") for p in ("Rice 5kg", "Oil")],
     sale(receipt_no="R4", product_sold="Bread", timestamp="2026-09-01"),
     sale(receipt_no="Z1", timestamp="2027-01-05")],
    # A known line again, a new month, and two lines that take R9 over the limit.
    [sale(staff_name="Aba"), sale(receipt_no="R5", timestamp="2026-10-01"),
     *[sale(receipt_no="R9", product_sold=p, timestamp="2026-10-02") for p in ("x", "y")]],
]


def whole_fact(spark, monthly, text_frame, masters, calendar, state, loads):
    """The fact of all kept lines, built at once with the keys of the store."""
    sales = spark.read.parquet(f"{monthly.root}/sales").filter(
        f"load in {tuple([*state.loads, ''])}")
    dims = Dimensions(*[current_rows(n, monthly.dimension(n, state), masters[n]) for n in MATCHED],
                      monthly.dimension("dates", state))
    raw = text_frame(SALES, *[line for lines in loads for line in lines])
    return build_fact(sales, dims, flagged_receipts(duplicate_receipts(raw)))


def test_only_touched_months_are_built_again(spark, text_frame, tmp_path, masters, dates):
    monthly = MonthlySales(spark, str(tmp_path))
    first, touched = add(monthly, text_frame, masters(), dates(), *LOADS[0])
    assert touched == ["2026-06", "2026-07", "2026-08", "2026-09", "2027-01"]
    assert set(first.months) == {"2026-06", "2026-07", "2026-08"}
    before = files(monthly, first)
    second, touched = add(monthly, text_frame, masters(), dates(), *LOADS[1])
    assert touched == ["2026-08", "2026-10"]  # R9 is flagged late and leaves August empty
    assert set(second.months) == {"2026-06", "2026-07", "2026-10"}
    after = files(monthly, second)
    assert {m: after[m] for m in ("2026-06", "2026-07")} == {
        m: before[m] for m in ("2026-06", "2026-07")}
    assert rows_of(monthly.fact()) == rows_of(whole_fact(
        spark, monthly, text_frame, masters(), dates(), second, LOADS))
    assert files(monthly, first) == before  # the earlier state can still be read
    keys = [r.transaction_key for r in monthly.fact().collect()]
    assert len(keys) == len(set(keys)) == 4
    rejected = spark.read.parquet(f"{tmp_path}/rejected").collect()
    assert [(r.receipt_no, r.failed_checks) for r in rejected] == [("R1", "receipt_product_unique")]


def test_changed_masters_and_days_reopen_their_months(spark, text_frame, tmp_path, masters, dates):
    monthly = MonthlySales(spark, str(tmp_path))
    add(monthly, text_frame, masters(), dates(), *LOADS[0])
    bread = [*PRODUCTS, ("P3", "BREAD", "Food", "2", "", "")]
    state, touched = add(monthly, text_frame, masters(products=bread), dates(), sale())
    assert touched == ["2026-09"]
    dearer = [(*p[:3], "4", "", "") if p[0] == "P2" else p for p in bread]
    state, touched = add(monthly, text_frame, masters(products=dearer),
                         dates(date(2027, 12, 31)), sale())
    assert touched == ["2026-08", "2027-01"]
    state, touched = add(
        monthly, text_frame, masters(products=dearer[1:]), dates(), sale(receipt_no="N"))
    assert touched == ["2026-06", "2026-07", "2026-08", "2027-01"]
    now = masters(products=dearer[1:])
    assert rows_of(monthly.fact()) == rows_of(whole_fact(
        spark, monthly, text_frame, now, dates(), state, [LOADS[0]]))
    orphans = orphan_counts(monthly.fact(), {
        "store_key": monthly.dimension("stores"), "staff_key": monthly.dimension("staff"),
        "product_key": monthly.dimension("products"), "date_key": monthly.dimension("dates")})
    assert {r.orphan_count for r in orphans.collect()} == {0}


def test_an_earlier_fact_finds_its_keys_after_masters_were_dropped(
        spark, text_frame, tmp_path, masters, dates):
    monthly = MonthlySales(spark, str(tmp_path))
    first, _ = add(monthly, text_frame, masters(), dates(), *LOADS[0])
    second, _ = add(monthly, text_frame, masters(products=[("P0", "Tea", "Food", "1", "", "")]),
                    dates(), sale(receipt_no="R7", product_sold="Tea"))
    orphans = orphan_counts(monthly.fact(first), {
        "store_key": monthly.dimension("stores", second),
        "staff_key": monthly.dimension("staff", second),
        "product_key": monthly.dimension("products", second),
        "date_key": monthly.dimension("dates", second)})
    assert {r.orphan_count for r in orphans.collect()} == {0}
    assert {r.product_name: r.product_key for r in monthly.fact(second).collect()} == {"Tea": 3}


def test_a_load_that_fails_is_not_published(spark, text_frame, tmp_path, masters, dates):
    monthly = MonthlySales(spark, str(tmp_path))
    state, _ = add(monthly, text_frame, masters(), dates(), *LOADS[0])
    broken = masters()
    broken["staff"] = broken["staff"].selectExpr("*", "1 / 0 as x").drop("x").filter("1 / 0 = 1")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        add(monthly, text_frame, broken, dates(), *LOADS[1])
    assert monthly.published() == state
    again, touched = add(monthly, text_frame, masters(), dates(), *LOADS[1])
    assert touched == ["2026-08", "2026-10"] and again.number == 2
