from datetime import date
from decimal import Decimal

from tillstar import fixed_values as fixed
from tillstar.operators import masters


def frame(text_frame, name, *rows):
    return text_frame(" ".join(fixed.MASTER_COLUMNS[name]), *rows)


def test_blank_key_is_tested_before_trimming(text_frame):
    raw = frame(text_frame, "stores", (" S1 ", " Accra ", "Southern Region "),
                ("", "x", "y"), (None, "x", "y"), ("   ", "x", "y"))
    assert sorted(tuple(r) for r in masters.stage_stores(raw).collect()) == [
        ("", "x", "y"), ("S1", "Accra", "Southern Region")]


def test_staff(text_frame):
    raw = frame(
        text_frame, "staff",
        ("E1", " Ama ", " Cashier", "S1 ", "Accra", "  ", "45000.5", "Active "),
        ("E2", "Kofi", "cashier", "S1", "", "", "", "Active"),
        ("E3", "Esi", "Security", "S1", "", "020", "2020-01-01", "Inactive"),
        ("E4", "Yaw", "Security", "S1", "", "", "", "On Leave"),
    )
    assert sorted(tuple(r) for r in masters.stage_staff(raw).collect()) == [
        ("E1", "Ama", "Cashier", "S1", None, date(2023, 3, 15), "Active"),
        ("E3", "Esi", "Security", "S1", "020", None, "Inactive")]


def test_managers(text_frame):
    raw = frame(
        text_frame, "managers",
        ("M1", "Ama", "Store Manager", "S1", "", "a@example.com", "44000", " "),
        ("M2", "Kofi", "Owner", "S1", "", "", "", ""),
    )
    assert [tuple(r) for r in masters.stage_managers(raw).collect()] == [
        ("M1", "Ama", "Store Manager", "S1", None, "a@example.com", date(2020, 6, 18), None)]


def test_products(text_frame):
    raw = frame(
        text_frame, "products",
        ("P1", " Rice ", "Food", " 5.505 ", "2026-01-01", ""),
        ("P2", "Oil", "Food", "n/a", "", ""),
        ("P3", "Salt", "Food", "", "", ""),
        ("P4", "Soap", "Home", "-1", "", ""),
        ("", "Milk", "Food", "1", "", ""),
    )
    assert [tuple(r) for r in masters.stage_products(raw).collect()] == [
        ("P1", "Rice", "Food", Decimal("5.51"), None, None)]
