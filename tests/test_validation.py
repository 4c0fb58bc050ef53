from conftest import SALES, sale
from tillstar import fixed_values as fixed
from tillstar.operators import validation as v


def lines(text_frame):
    rows = [sale(receipt_no="R3", product_sold=p) for p in "abc"]
    rows += [sale(receipt_no="R4", product_sold=p) for p in "abcd"]
    rows += [sale(receipt_no="R4", store_id="S002", source_sheet="SalesLog_S002")]
    rows += [sale(receipt_no="")] * 5 + [sale(receipt_no=None)] * 4
    rows += [sale(receipt_no="R8", product_sold=""), sale(receipt_no="R9", product_sold=None)]
    rows += [sale(receipt_no="R10", staff_name="", product_sold="   ")]
    rows += [sale(receipt_no="R11", staff_name=" AMA mensah", product_sold="rice 5KG ")]
    rows += [sale(receipt_no="R12", staff_name="Nobody")] * 2
    return text_frame(SALES, *rows)


def masters(text_frame):
    products = text_frame("product_name", ("Rice 5kg ",), ("A",), ("b",), (None,))
    return products, text_frame("full_name", ("Ama Mensah",), ("Kofi",))


def test_duplicates_are_counted_per_store_and_sheet(text_frame):
    found = v.duplicate_receipts(lines(text_frame))
    assert {(r["store_id"], r["raw_value"]) for r in found.collect()} == {
        ("S001", "R4"), ("S001", ""), ("S001", None)}
    assert v.duplicate_receipts(lines(text_frame), 4).count() == 1


def test_unmatched_names(text_frame):
    products, staff = masters(text_frame)
    sales = lines(text_frame)
    assert {r["raw_value"] for r in v.unmatched_products(sales, products).collect()} == {
        "c", "d", "   "}
    assert [r["raw_value"] for r in v.unmatched_staff(sales, staff).collect()] == ["Nobody"]


def test_one_pass_log_equals_the_three_checks(text_frame):
    products, staff = masters(text_frame)
    sales = lines(text_frame)
    log = v.validation_log(sales, products, staff)
    apart = (
        v.duplicate_receipts(sales).unionByName(v.unmatched_products(sales, products))
        .unionByName(v.unmatched_staff(sales, staff))
    )
    key = str
    assert sorted(map(key, log.collect())) == sorted(map(key, apart.collect()))
    assert {r[0]: r[1] for r in v.findings_per_check(log).collect()} == {
        fixed.DUPLICATE_RECEIPT: 3, fixed.UNMATCHED_PRODUCT: 3, fixed.UNMATCHED_STAFF: 1}
    assert v.findings_of(log, fixed.UNMATCHED_STAFF).columns == [
        "store_id", "source_sheet", "raw_value"]


def test_flagged_receipt_of_one_store_counts_everywhere(text_frame):
    flagged = v.flagged_receipts(v.duplicate_receipts(lines(text_frame)))
    assert {r[0] for r in flagged.collect()} == {"R4", "", None}
