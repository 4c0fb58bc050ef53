import gzip
import json

import pytest

from tillstar.sources import landed
from tillstar.sources.landed import Source

HEADER = "Timestamp,Store ID,Staff Name,Receipt No.,Customer Phone Number (Optional)," \
    "Product Sold,Quantity,Payment Method"


def land(root, sheet, *lines, name="part-0.csv"):
    folder = root / sheet
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(f"{line}\n" for line in lines))


def sources(*ids):
    return [Source(i, f"SalesLog_{i}") for i in ids]


def test_header_names():
    assert landed.normalise_headers([" Receipt No. ", "Till Number", "quantity", "Quantity"]) == [
        "receipt_no", "till_number", "quantity", "quantity"]


def test_eleven_default_sources():
    names = [s.sheet_name for s in landed.default_sources()]
    assert (len(names), names[0], names[-1]) == (11, "SalesLog_S001", "SalesLog_S011")


def test_sources_with_different_headers(spark, tmp_path):
    land(tmp_path, "SalesLog_S001", HEADER,
         "2026-06-05 10:00:00,WRONG,Ama,R1,0244,Rice,2,Cash",
         '2026-06-05 11:00:00,S001,"Mensah, Ama",R2,,Rice,1,Card',
         "2026-06-05 12:00:00,S001,Ama,R3")                         # a short row
    land(tmp_path, "SalesLog_S002",                                   # reordered, one unknown
         "Quantity,Timestamp,Staff Name,Till Number,Receipt No.",
         "3,2026-06-05 09:00:00,Kofi,T1,R1")
    land(tmp_path, "SalesLog_S003", "Quantity,Quantity,Receipt No.", "1,2,R1")  # the last wins
    land(tmp_path, "SalesLog_S004", HEADER)                           # no data rows
    land(tmp_path, "SalesLog_S005")                                   # not even a header
    land(tmp_path, "SalesLog_S999", HEADER, "x,x,x,R1,x,x,1,Cash")    # not registered
    known = sources("S001", "S002", "S003", "S004", "S005", "S006")
    sales = landed.read_sales(spark, str(tmp_path), known)
    rows = {(r["store_id"], r["receipt_no"]): r for r in sales.collect()}
    assert set(rows) == {("S001", "R1"), ("S001", "R2"), ("S001", "R3"), ("S002", "R1"),
                         ("S003", "R1")}
    assert rows["S001", "R2"]["staff_name"] == "Mensah, Ama"
    assert rows["S001", "R2"]["customer_phone"] == ""
    assert rows["S001", "R3"]["payment_method"] == "" == rows["S001", "R3"]["quantity"]
    assert rows["S002", "R1"]["quantity"] == "3"
    assert rows["S002", "R1"]["timestamp"] == "2026-06-05 09:00:00"
    assert rows["S002", "R1"]["source_sheet"] == "SalesLog_S002"
    assert rows["S003", "R1"]["quantity"] == "2"
    counts = landed.source_row_counts(sales, landed.registry_frame(spark, known))
    assert {r["store_id"]: r["row_count"] for r in counts.collect()} == {
        "S001": 3, "S002": 1, "S003": 1, "S004": 0, "S005": 0, "S006": 0}


def test_file_with_another_header_in_a_source_stops_the_load(spark, tmp_path):
    land(tmp_path, "SalesLog_S001", "Receipt No.,Quantity", "R1,1")
    land(tmp_path, "SalesLog_S001", "Quantity,Receipt No.", "2,R2", name="part-1.csv")
    with pytest.raises(Exception, match="(?i)header"):
        landed.read_sales(spark, str(tmp_path), sources("S001")).collect()


def test_no_landed_sources_give_an_empty_table(spark, tmp_path):
    land(tmp_path, "SalesLog_S001")
    assert landed.read_sales(spark, str(tmp_path), sources("S001")).count() == 0


def test_json_sales(spark, tmp_path):
    land(tmp_path, "SalesLog_S001", json.dumps({"receipt_no": "R1", "quantity": 2}),
         name="part-0.json")
    row = landed.read_sales_json(spark, str(tmp_path), sources("S001")).head()
    assert (row["store_id"], row["receipt_no"], row["quantity"], row["staff_name"]) == (
        "S001", "R1", "2", "")


def test_master_text_is_kept(spark, tmp_path):
    land(tmp_path, "staff", "full_name,staff_id,phone_number,shoe_size", "Ama,007,0244,5.50")
    row = landed.read_master(spark, str(tmp_path / "staff"), "staff").head()
    assert (row["staff_id"], row["phone_number"], row["role"]) == ("007", "0244", "")
    assert "shoe_size" not in row.asDict()


def test_master_with_another_header_stops_the_load(spark, tmp_path):
    land(tmp_path, "stores", "store_id,store_name", "S001,Kumasi")
    land(tmp_path, "stores", "store_name,store_id", "Accra,S002", name="part-1.csv")
    with pytest.raises(Exception, match="(?i)header"):
        landed.read_master(spark, str(tmp_path / "stores"), "stores").collect()


def test_master_without_a_header_is_empty(spark, tmp_path):
    land(tmp_path, "stores")
    assert landed.read_master(spark, str(tmp_path / "stores"), "stores").count() == 0


def test_quotes_and_line_breaks_in_cells(spark, tmp_path):
    land(tmp_path, "SalesLog_S001", "Receipt No.,Product Sold,Quantity",
         'R1,"Pipe 5"" x, long",2', 'R2,"two\nlines",1')
    rows = {r["receipt_no"]: r for r in landed.read_sales(
        spark, str(tmp_path), sources("S001")).collect()}
    assert set(rows) == {"R1", "R2"}
    assert (rows["R1"]["product_sold"], rows["R1"]["quantity"]) == ('Pipe 5" x, long', "2")
    assert (rows["R2"]["product_sold"], rows["R2"]["quantity"]) == ("two\nlines", "1")


@pytest.mark.parametrize("sheet", ["Sales Log 1", "Sales+Log", "Sales%20Log", "Verkäufe"])
def test_any_sheet_name_is_stamped(spark, tmp_path, sheet):
    land(tmp_path, sheet, "Receipt No.,Quantity", "R1,1", "R2,2")
    sales = landed.read_sales(spark, str(tmp_path), [Source("S001", sheet)])
    assert {(r["store_id"], r["source_sheet"], r["receipt_no"]) for r in sales.collect()} == {
        ("S001", sheet, "R1"), ("S001", sheet, "R2")}


def test_repeated_header_cells_are_compared_too(spark, tmp_path):
    land(tmp_path, "SalesLog_S001", "Quantity,Quantity,Receipt No.", "1,2,R1")
    land(tmp_path, "SalesLog_S001", "Receipt No.,Quantity,Quantity", "R2,1,2", name="part-1.csv")
    with pytest.raises(ValueError, match="another header"):
        landed.read_sales(spark, str(tmp_path), sources("S001"))


def test_compressed_files_are_read_and_other_types_stop_the_load(spark, tmp_path):
    (tmp_path / "SalesLog_S001").mkdir()
    with gzip.open(tmp_path / "SalesLog_S001" / "part-0.csv.gz", "wt") as out:
        out.write("Receipt No.,Quantity\nR1,1\n")
    assert landed.read_sales(spark, str(tmp_path), sources("S001")).count() == 1
    land(tmp_path, "SalesLog_S001", "Receipt No.", "R2", name="part-1.tsv")
    with pytest.raises(ValueError, match="another type"):
        landed.read_sales(spark, str(tmp_path), sources("S001"))


def test_a_header_further_down_does_not_count(spark, tmp_path):
    land(tmp_path, "SalesLog_S001", "Quantity,Quantity,Receipt No.", "1,2,R1")
    land(tmp_path, "SalesLog_S001", "Receipt No.,Quantity,Quantity", "R2,1,2",
         "Quantity,Quantity,Receipt No.", name="part-1.csv")
    with pytest.raises(ValueError, match="another header"):
        landed.read_sales(spark, str(tmp_path), sources("S001"))


def test_folders_without_a_source_are_reported(spark, tmp_path, caplog):
    land(tmp_path, "SalesLog_S001", HEADER)
    land(tmp_path, "SalesLog_S777", HEADER, "x,x,x,R1,x,x,1,Cash")
    landed.read_sales(spark, str(tmp_path), sources("S001", "S002"))
    assert "SalesLog_S777 has no registered source" in caplog.text
    assert "SalesLog_S002 delivered no file" in caplog.text
