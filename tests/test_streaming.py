import pytest
from pyspark.sql import functions as F

from conftest import SALES, sale
from tillstar.operators.fact import Dimensions, build_fact
from tillstar.operators.sales import split_sales
from tillstar.session import scratch_path
from tillstar.sources import star_tables
from tillstar.sources.landed import Source
from tillstar.streaming.ingest import enrich_sales, ingest_sales, stream_sales

HEADER = ["Timestamp", "Staff Name", "Receipt No.", "Product Sold", "Quantity", "Payment Method"]


def land(root, sheet, name, *rows):
    folder = root / sheet
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([",".join(HEADER), *rows]) + "\n")


def row(receipt, product="Rice", quantity=1, day=5):
    return f"2026-06-{day:02d} 10:00:00,Ama,{receipt},{product},{quantity},Cash"


def test_growing_files_add_each_line_once(spark, tmp_path):
    landing, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    sources = [Source("S001", "SalesLog_S001"), Source("S002", "SalesLog_S002")]

    def take_in():
        ingest_sales(stream_sales(spark, str(landing), HEADER, sources), out, mark)
        kept = spark.read.parquet(f"{out}/sales").select("store_id", "receipt_no", "product_sold")
        return sorted(tuple(r) for r in kept.collect())

    land(landing, "SalesLog_S001", "d1.csv", row("R1"), row("R1"), row("R2", quantity=9))
    land(landing, "SalesLog_S002", "d1.csv", row("R3"))
    first = [("S001", "R1", "Rice"), ("S002", "R3", "Rice")]
    assert take_in() == first
    assert take_in() == first                                  # nothing new
    land(landing, "SalesLog_S001", "again.csv", row("R1"), row("R1"), row("R2", quantity=9))
    assert take_in() == first                                  # delivered again
    land(landing, "SalesLog_S001", "d2.csv", row("R1", "Oil", day=6), row("R4", day=6),
         row("R3", day=6))
    assert take_in() == sorted(
        [*first, ("S001", "R1", "Oil"), ("S001", "R4", "Rice")])
    rejected = spark.read.parquet(f"{out}/rejected")
    assert {(r["failed_checks"], r["copies"]) for r in rejected.collect()} == {
        ("receipt_product_unique", 1), ("quantity_range", 1)}
    arrived = 4 + 3 + 3
    kept = spark.read.parquet(f"{out}/sales").count()
    assert kept + rejected.agg(F.sum("copies")).head()[0] == arrived


def test_stream_stops_at_a_folder_without_a_source(spark, tmp_path):
    land(tmp_path / "in", "SalesLog S9", "d1.csv", row("R1"))
    known = [Source("S009", "SalesLog S9")]
    arriving = stream_sales(spark, str(tmp_path / "in"), HEADER, known)
    ingest_sales(arriving, str(tmp_path / "out"), str(tmp_path / "mark"))
    assert spark.read.parquet(str(tmp_path / "out" / "sales")).head()["store_id"] == "S009"
    arriving = stream_sales(spark, str(tmp_path / "in"), HEADER, [Source("S1", "SalesLog S1")])
    with pytest.raises(Exception, match="no source is registered"):
        ingest_sales(arriving, str(tmp_path / "out2"), str(tmp_path / "mark2"))


def test_one_batch_equals_the_full_refresh(spark, tmp_path, text_frame):
    lines = [sale(receipt_no=f"R{i % 7}", product_sold="Rice" if i % 2 else "Oil",
                  quantity=str(i % 6 + 1), timestamp=f"2026-06-{i % 5 + 1:02d}")
             for i in range(40)]
    raw = text_frame(SALES, *lines)
    raw.write.parquet(str(tmp_path / "raw"))
    arriving = spark.readStream.schema(raw.schema).parquet(str(tmp_path / "raw"))
    ingest_sales(arriving, str(tmp_path / "out"), str(tmp_path / "mark"))
    split = split_sales(raw, scratch_path(spark, "lines"))
    stored = spark.read.parquet(str(tmp_path / "out" / "sales")).drop("batch")
    assert sorted(map(str, stored.collect())) == sorted(map(str, split.kept.collect()))


def test_enriched_stream_equals_the_fact(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    sales = star_tables.raw_frame(spark, folder, "raw_transactions")
    kept = split_sales(sales, scratch_path(spark, "lines")).kept
    kept.repartition(3).write.parquet(str(tmp_path / "sales"))
    dims = Dimensions(
        star_tables.raw_frame(spark, folder, "raw_stores").withColumn("store_key", F.lit(1)),
        star_tables.raw_frame(spark, folder, "raw_staff").withColumn("staff_key", F.lit(1)),
        star_tables.raw_frame(spark, folder, "raw_products").selectExpr(
            "1 as product_key", "product_name", "category",
            "try_cast(unit_price_ghs as decimal(10,2)) as unit_price_ghs"),
        spark.sql("select date'1998-01-01' + cast(id as int) as full_date, id as date_key"
                  " from range(365)"),
    )
    flagged = sales.groupBy("receipt_no").count().filter("count > 30").select("receipt_no")
    arriving = spark.readStream.schema(kept.schema).option("maxFilesPerTrigger", 1).parquet(
        str(tmp_path / "sales"))
    enrich_sales(arriving, dims, flagged, str(tmp_path / "fact"), str(tmp_path / "mark"))
    streamed = spark.read.parquet(str(tmp_path / "fact"))
    batch = build_fact(kept, dims, flagged)
    assert batch.count() > 0
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect()))
