import random
from collections import Counter

import pytest

from conftest import SALES, sale
from tillstar import fixed_values as fixed
from tillstar.operators import constraints as c
from tillstar.operators import masters
from tillstar.operators.sales import line_findings, split_sales
from tillstar.session import scratch_path


def test_null_passes_all_but_not_null(spark):
    df = spark.createDataFrame([(None, None), (7, "x")], "n int, d string")
    found = c.violations(df, [c.in_range("n", 1, 5), c.in_domain("d", ["a"]), c.positive("n"),
                              c.not_null("n")])
    assert sorted(tuple(r) for r in found.collect()) == sorted([
        ("n_not_null", None), ("n_range", "7"), ("d_domain", "x")],)


def test_passing_and_failing_partition_the_rows(spark):
    df = spark.createDataFrame([(i,) for i in (0, 1, 5, 6, None)], "n int")
    checks = [c.in_range("n", 1, 5), c.not_null("n")]
    assert sorted(r[0] for r in c.passing(df, checks).collect()) == [1, 5]
    assert {r["n"]: r["failed_checks"] for r in c.failing(df, checks).collect()} == {
        0: "n_range", 6: "n_range", None: "n_not_null"}


def test_repeated_keys_treat_nulls_as_different(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert [tuple(r) for r in c.repeated_keys(df, ["k"]).collect()] == [("a", 2)]


def test_check_counts_of_a_key_and_row_checks(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 0), (" a ", -1), ("b", None), ("", 2), ("  ", 3), (None, 0)],
        "k string, n int")
    found = c.check_counts("t", df, "k", [c.positive("n")])
    expected = {("t", "k_not_null", 7, 3), ("t", "k_unique", 7, 2), ("t", "n_positive", 7, 3)}
    assert {tuple(r) for r in found.collect()} == expected
    empty = c.check_counts("t", df.limit(0), "k", [c.positive("n")])
    assert {tuple(r) for r in empty.collect()} == {(t, n, 0, 0) for t, n, _, _ in expected}


def brute_force_first(rows):
    """key = first two cells, order = the rest."""
    groups = {}
    for row in rows:
        groups.setdefault(row[:2], []).append(row)
    kept, surplus = [], Counter()
    for key, members in groups.items():
        first = min(members, key=lambda r: tuple((x is not None, x or "") for x in r[2:]))
        kept.append(first)
        surplus.update(members)
        surplus[first] -= 1
    return sorted(kept, key=repr), {k: n for k, n in surplus.items() if n}


@pytest.mark.parametrize("seed", range(3))
def test_first_per_key_equals_brute_force_under_skew(spark, seed):
    rng = random.Random(seed)
    rows = [("", "hot", rng.choice("abc"), rng.choice(["x", "y", None])) for _ in range(300)]
    rows += [(f"r{rng.randrange(400)}", rng.choice("pq"), rng.choice("abc"), rng.choice("xy"))
             for _ in range(600)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k1 string, k2 string, o1 string, o2 string").repartition(5)
    split = c.first_per_key(df, ["k1", "k2"], ["o1", "o2"], scratch_path(spark, "unique"))
    kept = sorted((tuple(r) for r in split.kept.collect()), key=repr)
    surplus = {tuple(r)[:4]: r["copies"] for r in split.surplus.collect()}
    assert (kept, surplus) == brute_force_first(rows)


def test_policies(spark):
    df = spark.createDataFrame(
        [("S1", "Acc", "Southern Region"), ("S1", "Bcc", "Southern Region"),
         ("S2", "Ccc", "Elsewhere")], "store_id string, city string, region string")
    args = (df, "staging.stores", masters.master_checks("stores"), ["store_id"])
    assert c.enforce(*args, "report", "").count() == 3
    kept = c.enforce(*args, "quarantine", scratch_path(spark, "q"))
    assert [tuple(r) for r in kept.collect()] == [("S1", "Acc", "Southern Region")]
    with pytest.raises(c.ConstraintViolation, match="region_domain.*store_id_unique"):
        c.enforce(*args, "fail", "")
    sound = df.filter("city = 'Acc'")
    assert c.enforce(sound, *args[1:], "fail", "").count() == 1


def test_price_that_does_not_fit_breaks_the_load(text_frame):
    raw = text_frame(" ".join(fixed.MASTER_COLUMNS["products"]),
                     ("P1", "Rice", "Food", "12345678901", "", ""))
    with pytest.raises(c.ConstraintViolation, match="unit_price_ghs_not_null"):
        c.enforce(masters.stage_products(raw), "staging.products",
                  masters.master_checks("products"), ["product_id"], "fail", "")


def split(spark, text_frame, *lines):
    return split_sales(text_frame(SALES, *lines), scratch_path(spark, "lines"))


def test_sales_lines_are_typed_and_rejected(spark, text_frame):
    out = split(
        spark, text_frame,
        sale(receipt_no="R1", customer_phone="  "),
        sale(receipt_no="R2", quantity="6"),
        sale(receipt_no="R3", quantity="0", payment_method="cash"),
        sale(receipt_no="R4", quantity="two"),
        sale(receipt_no="R5", timestamp="soon"),
        sale(receipt_no=None),
        sale(receipt_no=" R6 ", quantity="5"),
    )
    kept = {r["receipt_no"]: r for r in out.kept.collect()}
    assert set(kept) == {"R1", " R6 "}
    assert kept["R1"]["customer_phone"] is None and kept["R1"]["quantity"] == 2
    assert {r["receipt_no"]: r["failed_checks"] for r in out.rejected.collect()} == {
        "R2": "quantity_range", "R3": "quantity_range,payment_method_domain",
        "R4": "quantity_not_null", "R5": "transaction_date_not_null",
        None: "receipt_no_not_null"}
    found = {(r["check_name"], r["raw_value"]) for r in line_findings(out.rejected).collect()}
    assert ("quantity_not_null", "two") in found
    assert ("transaction_date_not_null", "soon") in found
    assert ("payment_method_domain", "cash") in found


def test_repeated_line_keeps_one_row_and_counts_the_rest(spark, text_frame):
    out = split(
        spark, text_frame,
        sale(), sale(), sale(),                      # reloaded twice
        sale(timestamp="2026-06-04 09:00:00"),       # the first in order
        sale(product_sold="Oil"),
        sale(quantity="9"),                          # broken by itself, never a rival
    )
    assert sorted((r["product_sold"], r["transaction_date"].day) for r in out.kept.collect()) == [
        ("Oil", 5), ("Rice 5kg", 4)]
    copies = {r["failed_checks"]: r["copies"] for r in out.rejected.collect()}
    assert copies == {"receipt_product_unique": 3, "quantity_range": 1}
    findings = [r for r in line_findings(out.rejected).collect()
                if r["check_name"] == "receipt_product_unique"]
    assert [(r["raw_value"], r["copies"]) for r in findings] == [("R1|Rice 5kg", 3)]


def test_rows_with_a_null_key_are_kept(spark, tmp_path):
    rows = spark.createDataFrame(
        [(None, "p", 1), (None, "p", 2), ("r", "p", 3), ("r", "p", 4)],
        "receipt string, product string, n int")
    split = c.first_per_key(rows, ["receipt", "product"], ["n"], str(tmp_path / "repeated"))
    assert sorted(r["n"] for r in split.kept.collect()) == [1, 2, 3]
    assert [(r["n"], r["copies"]) for r in split.surplus.collect()] == [(4, 1)]
