from tillstar.functions.columns import (
    blank_to_null,
    is_number_text,
    money,
    norm_key,
    parse_count,
    parse_price,
    parse_serial_date,
    parse_timestamp,
    trimmed,
)

__all__ = [
    "blank_to_null",
    "is_number_text",
    "money",
    "norm_key",
    "parse_count",
    "parse_price",
    "parse_serial_date",
    "parse_timestamp",
    "trimmed",
]
