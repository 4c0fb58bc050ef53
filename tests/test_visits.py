"""Customer visits kept as bitmaps by month equal those of the whole fact."""

import random
from datetime import date

import pytest

from conftest import SALES, sale
from tillstar import fixed_values as fixed
from tillstar.operators.customers import customer_visits
from tillstar.operators.dimensions import build_dim_date, date_spine
from tillstar.operators.masters import STAGERS
from tillstar.operators.visits import NUMBER, customer_receipts, merged_visits, visit_bitmaps
from tillstar.plans.months import MATCHED, MonthlySales
from tillstar.plans.visits import MonthlyVisits

MASTERS = dict(
    stores=[("S001", "Accra", "Southern Region")],
    staff=[("E1", "Ama Mensah", "Cashier", "S001", "", "020", "45000", "Active")],
    products=[("P1", "Rice 5kg", "Food", "10.5", "", ""), ("P2", "Oil", "Food", "3", "", "")])


@pytest.fixture
def shop(spark, text_frame, tmp_path):
    """Takes in lines, and gives the sales and visits with the published state."""
    masters = {n: STAGERS[n](text_frame(" ".join(fixed.MASTER_COLUMNS[n]), *MASTERS[n]))
               for n in MATCHED}
    calendar = build_dim_date(date_spine(spark, date(2026, 1, 1), date(2026, 12, 31)))
    sales = MonthlySales(spark, str(tmp_path))
    return sales, MonthlyVisits(sales), lambda *lines: sales.add(
        text_frame(SALES, *lines), masters, calendar)[0]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_loads_add_up_to_the_whole_fact(shop):
    sales, visits, add = shop
    rng = random.Random(5)
    phones = ["0240000000"] * 4 + [f"02400000{i:02d}" for i in range(9)] + [""]
    states = []
    for load in range(3):
        lines = [sale(receipt_no=f"R{rng.randrange(150)}", customer_phone=rng.choice(phones),
                      product_sold=rng.choice(["Rice 5kg", "Oil"]),
                      timestamp=f"2026-{rng.randint(1 + load, 4 + load):02d}-{rng.randint(1, 28)}")
                 for _ in range(120)]
        states.append(add(*lines))
        assert visits.add() == sorted(m for m, at in states[-1].months.items()
                                      if at == states[-1].load)
        assert rows(visits.customers()) == rows(customer_visits(sales.fact()))
    assert visits.add() == []
    for state in states:  # earlier states can still be read
        assert rows(visits.customers(state)) == rows(customer_visits(sales.fact(state)))
    numbers = visits._known(visits._builds()).collect()
    given = sorted(n[NUMBER] for n in numbers)
    assert given == list(range(1, len({n.receipt_no for n in numbers}) + 1))


def test_a_receipt_of_two_months_is_one_visit_and_a_flagged_one_none(shop):
    sales, visits, add = shop
    add(sale(receipt_no="R1"), sale(receipt_no="R9", product_sold="Oil", timestamp="2026-07-01"))
    visits.add()
    assert rows(visits.customers()) == [("0244000001", date(2026, 6, 5), 2)]
    add(sale(receipt_no="R1", product_sold="Oil", timestamp="2026-08-01"))
    visits.add()
    assert rows(visits.customers()) == [("0244000001", date(2026, 6, 5), 2)]
    add(*[sale(receipt_no="R9", product_sold=p, timestamp="2026-09-01") for p in "abc"])
    visits.add()
    assert rows(visits.customers()) == [("0244000001", date(2026, 6, 5), 1)]


def test_states_that_were_passed_over_are_caught_up(shop):
    sales, visits, add = shop
    add(sale(receipt_no="R1"))
    add(sale(receipt_no="R2", timestamp="2026-07-01", customer_phone="0244000002"))
    with pytest.raises(LookupError, match="no visits of 2026-0"):
        visits.customers()
    assert visits.add() == ["2026-06", "2026-07"]
    assert rows(visits.customers()) == [
        ("0244000001", date(2026, 6, 5), 1), ("0244000002", date(2026, 7, 1), 1)]


def test_bitmaps_keep_far_numbers_and_missing_receipts(spark):
    fact = spark.createDataFrame(
        [("m1", "a", "r1", date(2026, 1, 3)), ("m2", "a", "r1", date(2026, 2, 1)),
         ("m2", "a", "r2", date(2026, 2, 1)), ("m1", "a", "r3", date(2026, 1, 2)),
         ("m1", "b", None, date(2026, 1, 5)), ("m1", None, "r4", date(2026, 1, 1)),
         ("m1", "", "r4", date(2026, 1, 1))],
        "part string, customer_phone string, receipt_no string, transaction_date date")
    numbers = spark.createDataFrame(
        [("r1", 1), ("r2", 32768), ("r3", 32769), ("r4", 5_000_000_000)],
        f"receipt_no string, {NUMBER} bigint")
    bitmaps = visit_bitmaps(customer_receipts(fact, "part"), numbers, "part")
    assert sorted((r.part, r.customer_phone, r.bucket or 0) for r in bitmaps.collect()) == [
        ("m1", "a", 1), ("m1", "a", 2), ("m1", "b", 0), ("m2", "a", 1)]
    expected = [("a", date(2026, 1, 2), 3), ("b", date(2026, 1, 5), 0)]
    assert rows(merged_visits(bitmaps)) == rows(customer_visits(fact)) == expected
    assert rows(merged_visits(bitmaps.limit(0))) == []


def test_only_the_new_months_of_the_fact_are_read(shop, spark):
    sales, visits, add = shop
    add(sale(receipt_no="R1"))
    visits.add()
    add(sale(receipt_no="R2", timestamp="2026-07-01"))
    visits.add()
    read = {r.path.split("sale_month=")[1][:7]: r.path.split("build=")[1][:6] for r in
            visits.bitmaps().select("_metadata.file_path").toDF("path").collect()}
    assert read == {"2026-06": "000001", "2026-07": "000002"}
