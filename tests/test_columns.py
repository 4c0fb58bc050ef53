from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillstar import functions as fx


def values(text_frame, build, *texts):
    df = text_frame("x i", *[(t, f"{i:03d}") for i, t in enumerate(texts)])
    return [r[0] for r in df.orderBy("i").select(build("x")).collect()]


def test_trim_strips_spaces_only(text_frame):
    assert values(text_frame, fx.trimmed, "  a ", "\ta", " a ", None) == [
        "a", "\ta", " a ", None]


def test_norm_key_keeps_inner_spaces(text_frame):
    assert values(text_frame, fx.norm_key, " Rice  5KG ", "RICE") == ["rice  5kg", "rice"]


def test_blank_to_null(text_frame):
    assert values(text_frame, fx.blank_to_null, "", "   ", " x ", None) == [None, None, "x", None]


@pytest.mark.parametrize("text, ok", [
    ("12", True), (" 12.50 ", True), ("12.", False), (".5", False), ("-1", False), ("+1", False),
    ("1,000", False), ("1e3", False), ("12\n", False), ("", False), ("n/a", False),
])
def test_number_text(text_frame, text, ok):
    assert values(text_frame, fx.is_number_text, text) == [ok]


def test_serial_dates_round_half_to_even(text_frame):
    assert values(text_frame, fx.parse_serial_date,
                  "45000", "45000.5", "45001.5", " 45000.7 ", "0", "2020-01-15", "", None) == [
        date(2023, 3, 15), date(2023, 3, 15), date(2023, 3, 17), date(2023, 3, 16),
        date(1899, 12, 30), None, None, None]


def test_serial_date_beyond_integers_is_null(text_frame):
    assert values(text_frame, fx.parse_serial_date, "99999999999999") == [None]


def test_price_rounds_half_away_from_zero(text_frame):
    assert values(text_frame, fx.parse_price, "2.345", " 2.5 ", "12345678.99", "1234567890", "n/a"
                  ) == [Decimal("2.35"), Decimal("2.50"), Decimal("12345678.99"), None, None]


def test_counts(text_frame):
    assert values(text_frame, fx.parse_count, "3", " 3 ", "2.5", "two", "", "99999999999", None
                  ) == [3, 3, None, None, None, None, None]


def test_timestamps(text_frame):
    assert values(text_frame, fx.parse_timestamp,
                  "2026-06-05 14:03:22", "6/5/2026 14:03:22", "6/5/2026 4:03", "06/05/2026",
                  "2026-06-05", "2024-02-29 00:00:00", "2026", "13/45/2026 10:00:00",
                  "yesterday", "", None) == [
        datetime(2026, 6, 5, 14, 3, 22), datetime(2026, 6, 5, 14, 3, 22),
        datetime(2026, 6, 5, 4, 3), datetime(2026, 6, 5), datetime(2026, 6, 5),
        datetime(2024, 2, 29), None, None, None, None, None]


def test_slashed_timestamps_ignore_the_session_zone(spark, text_frame):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:  # 02:30 does not exist there on that day
        assert values(text_frame, fx.parse_timestamp, "3/8/2026 2:30:00") == [
            datetime(2026, 3, 8, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_money_is_two_decimals(spark):
    df = spark.createDataFrame([(5, Decimal("99.99"))], "q int, p decimal(10,2)")
    out = df.select(fx.money("q", "p").alias("m"))
    assert out.schema["m"].dataType.simpleString() == "decimal(10,2)"
    assert out.head()[0] == Decimal("499.95")


def test_money_overflow_raises(spark):
    df = spark.createDataFrame([(5, Decimal("99999999.99"))], "q int, p decimal(10,2)")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        df.select(fx.money("q", "p").alias("m")).filter(F.col("m") > 0).collect()
