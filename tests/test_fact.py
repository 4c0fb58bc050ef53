from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillstar.operators import integrity
from tillstar.operators.customers import build_dim_customers, customer_visits, top_customers
from tillstar.operators.dimensions import (
    append_dates,
    build_dim_date,
    build_dimension,
    date_spine,
    spine_of_years,
)
from tillstar.operators.fact import Dimensions, build_fact
from tillstar.operators.keys import read_numbered, with_dense_key
from tillstar.operators.reports import (
    fact_rows_by_store,
    sales_by_category,
    sales_by_store_month,
    top_store_for_product,
    top_store_per_week,
)
from tillstar.session import scratch_path

STAGED = "transaction_date timestamp_ntz, store_id string, staff_name string, receipt_no string," \
    " customer_phone string, product_sold string, quantity int, payment_method string," \
    " source_sheet string"


@pytest.fixture(scope="module")
def dims(spark):
    stores = spark.createDataFrame(
        [(1, "S001"), (2, " S002 ")], "store_key bigint, store_id string")
    staff = spark.createDataFrame(
        [(1, "Ama Mensah", "S001"), (2, "Kofi", "S002"), (3, "Esi", "S002"), (4, "esi ", "S002")],
        "staff_key bigint, full_name string, store_id string")
    products = spark.createDataFrame(
        [(1, "Rice 5kg", "Food", Decimal("10.50")), (2, "Oil", "Food", Decimal("3.00")),
         (3, " oil", "Home", Decimal("4.00"))],
        "product_key bigint, product_name string, category string, unit_price_ghs decimal(10,2)")
    dates = build_dim_date(date_spine(spark, date(2026, 1, 1), date(2026, 12, 31)))
    return Dimensions(stores, staff, products, dates)


def staged(spark, *rows):
    base = dict(transaction_date=datetime(2026, 3, 2, 9), store_id="S001",
                staff_name="Ama Mensah", receipt_no="R1", customer_phone="0244",
                product_sold="Rice 5kg", quantity=2, payment_method="Cash",
                source_sheet="SalesLog_S001")
    names = list(base)
    return spark.createDataFrame(
        [tuple({**base, **r}[n] for n in names) for r in rows], STAGED)


LINES = [
    dict(),
    dict(receipt_no="R2", product_sold=" RICE 5KG ", staff_name=" ama mensah"),
    dict(receipt_no="R3", product_sold="Oil"),                           # two products of that name
    dict(receipt_no="R4", product_sold="Bread"),                         # unknown product
    dict(receipt_no="R5", store_id="S002"),                              # staff of another store
    dict(receipt_no="R6", store_id="S009"),                              # unknown store
    dict(receipt_no="R7", transaction_date=datetime(2027, 1, 1)),        # outside the calendar
    dict(receipt_no="R8"),                                               # flagged
    dict(receipt_no=None, customer_phone="  "),                          # never flagged
    dict(receipt_no="R9", store_id="S002", staff_name="ESI"),            # two staff of that name
]


@pytest.fixture(scope="module")
def flagged(spark):
    return spark.createDataFrame([("R8",), (None,)], "receipt_no string")


@pytest.fixture(scope="module")
def sales(spark):
    return staged(spark, *LINES)


@pytest.fixture(scope="module")
def fact(sales, dims, flagged):
    return build_fact(sales, dims, flagged)


def test_fact_rows(fact):
    rows = fact.collect()
    assert sorted((r["receipt_no"] or "-", r["product_key"], r["staff_key"]) for r in rows) == [
        ("-", 1, 1), ("R1", 1, 1), ("R2", 1, 1), ("R3", 2, 1), ("R3", 3, 1), ("R9", 1, 3),
        ("R9", 1, 4)]
    by_receipt = {r["receipt_no"]: r for r in rows}
    assert by_receipt["R1"]["total_amount_ghs"] == Decimal("21.00")
    assert by_receipt["R2"]["product_name"] == "Rice 5kg"
    assert by_receipt["R2"]["staff_name"] == " ama mensah"
    assert by_receipt[None]["customer_phone"] is None
    assert by_receipt["R1"]["date_key"] == 61


def test_every_line_has_one_outcome(spark, sales, dims, flagged, fact, tmp_path):
    rejected = spark.createDataFrame([(3,), (1,)], "copies bigint")
    rows = integrity.row_outcomes(sales, rejected, flagged, dims, str(tmp_path)).collect()
    assert {r["outcome"]: (r["source_rows"], r["fact_rows"]) for r in rows} == {
        "quarantined": (4, 0), "flagged_receipt": (1, 0), "no_product": (1, 0),
        "no_store": (1, 0), "no_staff": (1, 0), "no_date": (1, 0), "in_fact": (5, 7)}
    assert sum(r["source_rows"] for r in rows) == len(LINES) + 4
    assert sum(r["fact_rows"] for r in rows) == fact.count()


def test_orphans_are_found(spark, fact, dims):
    known = {"store_key": dims.stores, "staff_key": dims.staff,
             "product_key": dims.products, "date_key": dims.dates}
    assert [tuple(r) for r in integrity.orphan_counts(fact, known).collect()] == [
        ("no_matching_date", 0), ("no_matching_product", 0), ("no_matching_staff", 0),
        ("no_matching_store", 0)]
    broken = fact.withColumn("store_key", F.when(F.col("receipt_no") == "R1", F.lit(None))
                             .otherwise(F.col("store_key") + 100))
    broken = broken.withColumn("date_key", F.lit(9999))
    counts = dict(tuple(r) for r in integrity.orphan_counts(broken, known).collect())
    assert counts == {"no_matching_date": 7, "no_matching_product": 0, "no_matching_staff": 0,
                      "no_matching_store": 7}
    keys = integrity.orphan_keys(broken, dims.stores, "store_key").collect()
    assert {r["store_key"]: r["fact_rows"] for r in keys} == {None: 1, 101: 4, 102: 2}


def test_customers(spark):
    rows = [("0244", datetime(2026, 3, 2), "R1"), ("0244", datetime(2026, 3, 1), "R1"),
            ("0244", datetime(2026, 4, 1), "R2"), ("0200", datetime(2026, 5, 1), "R3"),
            ("", datetime(2026, 1, 1), "R4"), (None, datetime(2026, 1, 1), "R5")]
    fact = spark.createDataFrame(
        rows, "customer_phone string, transaction_date timestamp_ntz, receipt_no string")
    built = build_dim_customers(fact, scratch_path(spark, "customers"))
    assert sorted(tuple(r) for r in built.collect()) == [
        (1, "0200", date(2026, 5, 1), 1), (2, "0244", date(2026, 3, 1), 2)]
    assert [r[0] for r in top_customers(customer_visits(fact), 1).collect()] == ["0244"]


def test_dense_keys_follow_the_order(spark):
    n = 5000
    df = spark.range(n).select(
        F.concat(F.lit("k"), F.lpad((F.col("id") * 7919 % n).cast("string"), 6, "0")).alias("k")
    ).repartition(7)
    rows = with_dense_key(df, "key", scratch_path(spark, "ordered"), ["k"]).collect()
    assert [r["k"] for r in sorted(rows, key=lambda r: r["key"])] == sorted(r["k"] for r in rows)
    assert sorted(r["key"] for r in rows) == list(range(1, n + 1))


def test_dense_keys_without_order_over_many_files(spark):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "100")
    try:
        keyed = with_dense_key(spark.range(0, 2000, 1, 12), "key", scratch_path(spark, "files"))
        assert sorted(r["key"] for r in keyed.collect()) == list(range(1, 2001))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")


def test_dense_keys_of_nothing(spark):
    empty = spark.createDataFrame([], "k string")
    assert with_dense_key(empty, "key", scratch_path(spark, "none"), ["k"]).count() == 0


def test_dimension_is_restarted_and_ordered(spark):
    staged = spark.createDataFrame(
        [("S2", "b", "r"), ("S10", "c", "r"), ("S1", "a", "r")],
        "store_id string, city string, region string")
    dim = build_dimension("stores", staged, scratch_path(spark, "stores"))
    assert sorted((r["store_key"], r["store_id"]) for r in dim.collect()) == [
        (1, "S1"), (2, "S10"), (3, "S2")]


def test_calendar(spark):
    dates = build_dim_date(date_spine(spark, date(2024, 2, 28), date(2024, 3, 3)))
    rows = [tuple(r) for r in dates.orderBy("date_key").collect()]
    assert rows[1] == (2, date(2024, 2, 29), "Thursday ", 29, 2, "February ", 1, 2024, False)
    assert [r[-1] for r in rows] == [False, False, False, True, True]
    assert len(rows) == 5


def test_calendar_keeps_known_days(spark):
    first = build_dim_date(date_spine(spark, date(2026, 1, 3), date(2026, 1, 5)))
    longer = build_dim_date(date_spine(spark, date(2026, 1, 1), date(2026, 1, 7)))
    merged = {r["full_date"].day: r["date_key"] for r in append_dates(first, longer).collect()}
    assert {d: merged[d] for d in (3, 4, 5)} == {3: 1, 4: 2, 5: 3}
    assert len(set(merged.values())) == 7 and set(merged) == set(range(1, 8))
    assert append_dates(first, first).count() == 3


def test_spine_of_years(spark):
    sales = spark.createDataFrame(
        [(datetime(2023, 5, 1),), (datetime(2025, 2, 1),)], "t timestamp_ntz")
    rows = spine_of_years(sales, "t").collect()
    assert (rows[0]["full_date"], rows[-1]["full_date"]) == (date(2023, 1, 1), date(2025, 12, 31))
    assert [r["date_key"] for r in rows] == list(range(1, len(rows) + 1))
    within = sales.filter("t > '2025-01-01'")
    assert spine_of_years(within, "t").count() == 365
    assert spine_of_years(sales.filter("false"), "t").count() == 0


def test_reports(fact, dims):
    assert {tuple(r) for r in fact_rows_by_store(fact).collect()} == {("S001", 5), ("S002", 2)}
    assert tuple(top_store_for_product(fact, "RICE", date(2026, 3, 2)).head()) == ("S001", 6)
    assert top_store_for_product(fact, "rice", date(2026, 3, 3)).count() == 0
    assert [tuple(r) for r in top_store_per_week(fact, "rice").collect()] == [
        (date(2026, 3, 2), "S001", 6)]
    assert {tuple(r) for r in sales_by_category(fact).collect()} == {
        ("Food", 6, 12, Decimal("111.00")), ("Home", 1, 2, Decimal("8.00"))}
    assert {tuple(r)[:5] for r in sales_by_store_month(fact, dims.dates).collect()} == {
        ("S001", 2026, 3, 5, 10), ("S002", 2026, 3, 2, 4)}


def test_dense_keys_with_misleading_file_names(spark, tmp_path):
    """The random id of a written file may look like a part number anywhere."""
    path = str(tmp_path / "rows")
    spark.range(20).repartition(2).sortWithinPartitions("id").write.option(
        "maxRecordsPerFile", 3).parquet(path)
    ids = ("c1-2-3-4-c83913586154", "a-c7-b-c8-c9", "0-c99999999999-1-2-3")
    for n, file in enumerate(sorted((tmp_path / "rows").glob("part-*.parquet"))):
        task, part = file.name[:10], file.name[file.name.rindex("-c"):]
        file.rename(file.with_name(f"{task}-{ids[n % 3]}{part}"))
    for crc in (tmp_path / "rows").glob(".*.crc"):
        crc.unlink()
    keys = [r["k"] for r in read_numbered(spark, path, "k").collect()]
    assert sorted(keys) == list(range(1, 21))


def test_dense_keys_refuse_other_files(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "rows"))
    file = next((tmp_path / "rows").glob("part-*.parquet"))
    file.rename(file.with_name("other.parquet"))
    with pytest.raises(Exception, match="not a written part file"):
        read_numbered(spark, str(tmp_path / "rows"), "k").collect()


def test_traced_lines_are_counted_while_the_fact_is_made(spark):
    """Names shared by several masters fan out; each line is counted once all the same."""
    from pyspark.sql import Observation

    from tillstar.operators.integrity import observed_fact, row_outcomes
    from tillstar.session import scratch_path
    from tillstar.sources import star_tables
    from tillstar.operators.fact import Dimensions, build_fact, trace_lines
    from tillstar.operators.sales import split_sales

    folder = "/root/testdata/sf0.001"
    raw = lambda n: star_tables.raw_frame(spark, folder, f"raw_{n}")
    split = split_sales(raw("transactions"), scratch_path(spark, "lines"))
    products = raw("products").selectExpr(
        "product_id", "product_name", "category", "try_cast(unit_price_ghs as decimal(10,2))"
        " as unit_price_ghs", "1L as product_key")
    staff = raw("staff").selectExpr("*", "1L as staff_key")
    dims = Dimensions(
        raw("stores").selectExpr("*", "1L as store_key"),
        staff.unionByName(staff.filter("staff_id < 'E00004'")),
        products.unionByName(products.filter("product_id < 'P000050'")),
        spark.sql("select date'1995-01-01' + cast(id as int) as full_date, id as date_key"
                  " from range(900)"))
    flagged = raw("transactions").groupBy("receipt_no").count().filter("count > 5").select(
        "receipt_no")
    observation = Observation()
    fact = observed_fact(trace_lines(split.kept, dims, flagged), observation)
    found = sorted(map(str, fact.collect()))
    assert found == sorted(map(str, build_fact(split.kept, dims, flagged).collect()))
    rows = row_outcomes(split.kept, split.rejected, flagged, dims, scratch_path(spark, "o"))
    expected = {r.outcome: r.source_rows for r in rows.collect() if r.outcome != "quarantined"}
    assert {o: observation.get[o] for o in expected} == expected
    assert observation.get["fact_rows"] == len(found) > expected["in_fact"] > 0
    assert expected["no_date"] > 0 and expected["flagged_receipt"] > 0
