from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tillstar.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", **{
        "spark.master": "local[8]",
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def text_frame(spark):
    """A frame of text columns from rows."""
    def build(columns: str, *rows: tuple):
        return spark.createDataFrame(
            [tuple(r) for r in rows], ", ".join(f"{c} string" for c in columns.split()))

    return build


SALES = "timestamp store_id staff_name receipt_no customer_phone product_sold quantity " \
    "payment_method source_sheet"


def sale(**cells) -> tuple:
    """A valid raw sales line with some cells replaced."""
    line = dict(timestamp="2026-06-05 10:00:00", store_id="S001", staff_name="Ama Mensah",
                receipt_no="R1", customer_phone="0244000001", product_sold="Rice 5kg",
                quantity="2", payment_method="Cash", source_sheet="SalesLog_S001")
    line.update(cells)
    return tuple(line[c] for c in SALES.split())
