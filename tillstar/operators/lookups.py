"""Rows that a join will not need, left out before they are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap for each of its keys, and in all: with more keys than that allows for
#: more rows without a match are shuffled, and the join drops them.
BITS_PER_KEY, MOST_BITS = 16, 1 << 29
#: Bits of one page of it, as Spark's bitmap functions have them.
PAGE_BITS = 8 * 4096


def maybe_among(rows: DataFrame, hashed: Column, hashes: DataFrame) -> DataFrame:
    """``rows`` without most of those whose 64-bit ``hashed`` is not in the one column ``hashes``.

    All others stay, and so do those that share a bit of the bitmap with one of ``hashes``,
    about one in BITS_PER_KEY: a join decides. ``hashes`` is read twice; its bitmap, two
    bytes a key and MOST_BITS at most, is broadcast, so ``rows`` stay where they are.
    """
    pages = -(-min(hashes.count() * BITS_PER_KEY, MOST_BITS) // PAGE_BITS)

    def place(value: Column) -> Column:
        return F.pmod(value, F.lit(max(1, pages) * PAGE_BITS)) + 1

    held = place(F.col(hashes.columns[0]))
    bitmap = hashes.select(
        F.bitmap_bucket_number(held).alias("_page"), F.bitmap_bit_position(held).alias("_bit"),
    ).groupBy("_page").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    at = place(hashed)
    bit = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("_bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10)
    is_set = F.getbit(byte.cast("bigint"), (bit % 8).cast("int")) == 1
    return rows.join(
        F.broadcast(bitmap), (F.bitmap_bucket_number(at) == F.col("_page")) & is_set
    ).select(*rows.columns)
