"""Streams that know earlier lines by their state."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SALES, sale
from tillstar.operators.lookups import maybe_among
from tillstar.operators.validation import duplicate_receipts
from tillstar.sources import star_tables
from tillstar.streaming import state

FIRST = datetime(2026, 1, 1)


@pytest.fixture
def deliveries(spark, tmp_path):
    """Calls a stream function after each delivery of (line, day) pairs."""
    schema = ", ".join(f"{c} string" for c in SALES.split()) + ", delivered_on timestamp"

    def deliver(take_in, *batches):
        for lines in batches:
            rows = [(*line, FIRST + timedelta(days=day)) for line, day in lines]
            df = spark.createDataFrame(rows, schema)
            df.write.mode("append").parquet(str(tmp_path / "in"))
            arriving = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
            take_in(arriving, str(tmp_path / "out"))
        return str(tmp_path / "out"), spark.read.parquet(str(tmp_path / "in"))

    return deliver


def dedup(raw, out):
    state.ingest_deduplicated(raw, out, "35 days")


def test_each_delivered_line_has_one_outcome(spark, deliveries):
    r = lambda n, **cells: sale(receipt_no=n, **cells)
    out, _ = deliveries(
        dedup,
        [(r("A"), 0), (r("A"), 0), (r("A", staff_name="Zoe"), 0), (r("B", quantity="9"), 0)],
        [(r("A"), 20), (r("D"), 20), (r("A", product_sold="Oil"), 20)],
        [(r("D", staff_name="Aba"), 40), (r("E"), 40)],
        [(r("F"), 60), (r("late"), 0), (r("E"), 60), (r("slow"), 26), (r("A"), 1),
         (r("late and not"), 0), (r("late and not"), 60)])
    rows = state.outcomes(spark, out).collect()
    found = sorted((x.receipt_no, x.product_sold, x.failed_checks, x.copies) for x in rows)
    known, late, kept = "receipt_product_unique", "delivered_too_late", ""
    assert found == sorted([
        ("A", "Rice 5kg", kept, 1), ("A", "Rice 5kg", known, 1), ("A", "Rice 5kg", known, 1),
        ("A", "Rice 5kg", known, 1), ("A", "Rice 5kg", known, 1), ("A", "Oil", kept, 1),
        ("B", "Rice 5kg", "quantity_range", 1), ("D", "Rice 5kg", kept, 1),
        ("D", "Rice 5kg", known, 1), ("E", "Rice 5kg", kept, 1), ("E", "Rice 5kg", known, 1),
        ("F", "Rice 5kg", kept, 1), ("late", "Rice 5kg", late, 1), ("slow", "Rice 5kg", kept, 1),
        ("late and not", "Rice 5kg", kept, 1), ("late and not", "Rice 5kg", known, 1)])
    assert sum(x.copies for x in rows) == 4 + 3 + 2 + 7
    kept_d = [x for x in rows if x.receipt_no == "D" and not x.failed_checks]
    assert kept_d[0].staff_name == "Ama Mensah"  # the earlier delivery stays


def test_a_hot_key_reaches_the_state_once_per_batch(spark, deliveries):
    out, _ = deliveries(dedup, [(sale(quantity=str(k % 5 + 1)), 0) for k in range(500)],
                        [(sale(), 1)] * 300)
    candidates = spark.read.parquet(f"{out}/candidates")
    assert sorted(r.batch for r in candidates.collect()) == [0, 1]
    rows = state.outcomes(spark, out).collect()
    assert sum(r.copies for r in rows) == 800
    assert [r.quantity for r in rows if not r.failed_checks] == ["1"]


def test_nothing_new_changes_nothing(spark, deliveries):
    out, lines = deliveries(dedup, [(sale(), 0), (sale(receipt_no="R2"), 0)])
    before = sorted(map(str, state.outcomes(spark, out).collect()))
    path = lines.inputFiles()[0].rsplit("/", 1)[0]
    dedup(spark.readStream.schema(lines.schema).parquet(path), out)
    assert sorted(map(str, state.outcomes(spark, out).collect())) == before


def test_a_receipt_crosses_the_limit_once(spark, deliveries):
    r = lambda n, times, day: [(sale(receipt_no=n), day)] * times
    out, lines = deliveries(
        state.flag_receipts, r("A", 2, 0) + r("B", 4, 0) + [(sale(receipt_no=None), 0)] * 5,
        r("A", 2, 1) + r("B", 3, 1) + r("C", 3, 1), r("A", 9, 2) + r("D", 1, 2))
    found = state.found_receipts(spark, out).collect()
    assert sorted((str(f.raw_value), f.batch) for f in found) == [("A", 1), ("B", 0), ("None", 0)]
    whole = duplicate_receipts(lines.drop("delivered_on"))
    assert sorted(map(str, whole.collect())) == sorted(
        map(str, state.found_receipts(spark, out).drop("batch").collect()))
    assert {f.receipt_no for f in state.flagged_so_far(spark, out).collect()} == {"A", "B", None}


def test_keys_are_held_outside_the_heap(spark, deliveries):
    """Keys of all lines, and counts of all receipts, would outgrow the executors' heap."""
    setting = "spark.sql.streaming.stateStore.providerClass"
    out, _ = deliveries(dedup, [(sale(), 0)], [(sale(), 20)])
    flags, _ = deliveries(lambda raw, to: state.flag_receipts(raw, f"{to}/flags"), [(sale(), 40)])
    for folder in (f"{out}/checkpoints/keys", f"{flags}/flags/checkpoints/counts"):
        assert "RocksDBStateStoreProvider" in spark.read.text(f"{folder}/offsets/0").agg(
            F.concat_ws(" ", F.collect_list("value"))).head()[0]
    assert spark.conf.get(setting, None) is None


def test_deliveries_are_those_of_the_sql_from_one_join(spark):
    folder = "/root/testdata/sf0.001"
    sales = star_tables.raw_frame(spark, folder, "raw_transactions")
    sql = spark.sql(star_tables.DELIVERIES_SQL, raw_transactions=sales)
    found = star_tables.deliveries(spark, folder)
    assert sorted(map(str, found.collect())) == sorted(map(str, sql.withColumn(
        "delivered_on", F.date_add(F.lit("2026-01-01").cast("date"), "delivered_day")
        .cast("timestamp")).drop("delivered_day").collect()))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey") and plan.count("Join") == 3


def test_only_lines_that_may_be_lost_are_shuffled(spark):
    rows = spark.range(20_000).selectExpr("id", "string(id) text")
    wanted = spark.range(0, 40_000, 100).select(F.xxhash64("id").alias("hash"))
    left = [r.id for r in maybe_among(rows, F.xxhash64("id"), wanted).collect()]
    assert len(left) == len(set(left)) and set(range(0, 20_000, 100)) <= set(left)
    assert len(left) < 20_000 / 8
    assert maybe_among(rows, F.xxhash64("id"), wanted.limit(0)).collect() == []
