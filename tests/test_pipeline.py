from datetime import date

import pytest

from conftest import SALES, sale
from tillstar import fixed_values as fixed
from tillstar.config import WarehouseConfig
from tillstar.operators.constraints import ConstraintViolation
from tillstar.plans.gate import QualityGateError, quality_gate
from tillstar.plans.pipeline import RowAccountError, _check_accounts, run_landed, run_pipeline
from tillstar.schemas import SCHEMAS, business_columns
from tillstar.sources.layers import Layers
from tillstar.sources.landed import Source

STORES = [("S001", "Accra", "Southern Region"), ("S002", "Tamale", "Northern Region")]
STAFF = [("E1", "Ama Mensah", "Cashier", "S001", "", "020", "45000", "Active"),
         ("E2", "Kofi", "Security", "S002", "", "", "", "Active")]
MANAGERS = [("M1", "Esi", "Store Manager", "S001", "", "", "44000", "")]
PRODUCTS = [("P1", "Rice 5kg", "Food", "10.5", "", ""), ("P2", "Oil", "Food", "3", "", "")]
LINES = [
    sale(), sale(product_sold="oil"), sale(receipt_no="R2", customer_phone=""),
    sale(receipt_no="R3", quantity="9"), sale(receipt_no="R3"), sale(receipt_no="R3"),
    sale(receipt_no="R4", product_sold="Bread"), sale(receipt_no="R5", staff_name="Nobody"),
    *[sale(receipt_no="R6", product_sold=f"x{i}") for i in range(4)],
    sale(receipt_no="R7", timestamp="2027-01-01"),
    sale(receipt_no="R8", store_id="S002", staff_name="KOFI ", source_sheet="SalesLog_S002",
         timestamp="12/31/2026 23:59:59"),
]


@pytest.fixture
def raw(text_frame):
    def build(**changed):
        rows = dict(stores=STORES, staff=STAFF, managers=MANAGERS, products=PRODUCTS)
        rows.update(changed)
        frames = {n: text_frame(" ".join(fixed.MASTER_COLUMNS[n]), *r) if r
                  else text_frame(" ".join(fixed.MASTER_COLUMNS[n]), *STORES[:0])
                  for n, r in rows.items() if n != "transactions"}
        frames["transactions"] = text_frame(SALES, *rows.get("transactions", LINES))
        return frames

    return build


def contents(layers, table, run, columns=None):
    df = layers.read(table, run)
    return sorted(map(str, df.select(*(columns or business_columns(table))).collect()))


def test_full_refresh(spark, raw, tmp_path):
    layers = Layers(spark, str(tmp_path))
    result = run_pipeline(spark, raw(), str(tmp_path))
    rows = {r[2]: r[3] for r in result.metrics.rows}
    assert rows["raw.transactions"] == len(LINES)
    assert rows["staging.transactions"] == len(LINES) - 2
    assert rows["audit.validation_log"] == 7
    assert rows["marts.dim_date"] == 365
    assert rows["marts.fact_transactions"] == 5
    assert result.metrics.summary() == {
        "raw.transactions": len(LINES), "staging tables": len(LINES) - 2 + 7,
        "audit findings": 7, "fact_transactions": 5, "dim_customers": 1}
    assert result.findings == {"duplicate_receipt_no": 1, "unmatched_product_name": 5,
                               "unmatched_staff_name": 1}
    assert set(result.orphans.values()) == {0}
    assert result.outcomes == {"quarantined": 2, "flagged_receipt": 4, "no_product": 1,
                               "no_store": 0, "no_staff": 1, "no_date": 1, "in_fact": 5}
    customers = layers.read("marts.dim_customers").collect()
    assert [tuple(r) for r in customers] == [(1, "0244000001", date(2026, 6, 5), 3)]
    fact = layers.read_by_month("marts.fact_transactions")
    assert {r["sale_month"] for r in fact.collect()} == {"2026-06", "2026-12"}
    log = layers.read("audit.constraint_log").collect()
    assert sorted((r["check_name"], r["copies"]) for r in log) == [
        ("quantity_range", 1), ("receipt_product_unique", 1)]
    metrics = spark.read.parquet(f"{tmp_path}/metrics")
    assert metrics.count() == len(result.metrics.rows)
    for table, schema in SCHEMAS.items():
        stored = spark.read.parquet(result.run.path(table))
        assert {f.name: f.dataType for f in schema}.items() <= {
            f.name: f.dataType for f in stored.schema}.items(), table
        assert layers.read(table).columns == schema.names


def test_second_run_gives_the_same_tables(spark, raw, tmp_path):
    layers = Layers(spark, str(tmp_path))
    first = run_pipeline(spark, raw(), str(tmp_path)).run
    shuffled = raw(transactions=LINES[::-1])
    second = run_pipeline(spark, shuffled, str(tmp_path)).run
    assert layers.published() == second != first
    for table in SCHEMAS:
        columns = [c for c in business_columns(table) if c != "transaction_key"]
        assert contents(layers, table, first, columns) == contents(layers, table, second, columns)
    keys = [r[0] for r in layers.read("marts.fact_transactions").select("transaction_key")
            .collect()]
    assert sorted(keys) == list(range(1, 6))


def test_empty_master_keeps_the_last_load_and_sales_are_replaced(spark, raw, tmp_path):
    layers = Layers(spark, str(tmp_path))
    run_pipeline(spark, raw(), str(tmp_path))
    frames = raw(transactions=[sale()])
    frames["products"] = frames["products"].filter("false")
    result = run_pipeline(spark, frames, str(tmp_path))
    assert layers.read("raw.products").count() == 2
    assert layers.read("raw.transactions").count() == 1
    assert result.outcomes["in_fact"] == 1


def test_calendar_keeps_its_keys_across_runs(spark, raw, tmp_path):
    layers = Layers(spark, str(tmp_path))
    run_pipeline(spark, raw(), str(tmp_path))
    before = {r["full_date"]: r["date_key"] for r in layers.read("marts.dim_date").collect()}
    longer = WarehouseConfig(spine_start=date(2025, 12, 1), spine_end=date(2027, 1, 31))
    result = run_pipeline(spark, raw(), str(tmp_path), longer)
    after = {r["full_date"]: r["date_key"] for r in layers.read("marts.dim_date").collect()}
    assert len(after) == 365 + 31 + 31 == len(set(after.values()))
    assert before.items() <= after.items()
    assert result.outcomes["no_date"] == 0


def test_broken_master_stops_the_run_unpublished(spark, raw, tmp_path):
    layers = Layers(spark, str(tmp_path))
    good = run_pipeline(spark, raw(), str(tmp_path)).run
    offshore = raw(stores=[*STORES, ("S003", "Rig", "Offshore Region")])
    with pytest.raises(ConstraintViolation, match="region_domain"):
        run_pipeline(spark, offshore, str(tmp_path))
    assert layers.published() == good
    moved = run_pipeline(spark, offshore, str(tmp_path),
                         WarehouseConfig(constraint_policy="quarantine"))
    assert layers.read("marts.dim_stores").count() == 2
    findings = layers.read("audit.constraint_log", moved.run).filter("table_name='staging.stores'")
    assert [(r["check_name"], r["store_id"], r["raw_value"]) for r in findings.collect()] == [
        ("region_domain", "S003", "Offshore Region")]
    run_pipeline(spark, offshore, str(tmp_path), WarehouseConfig(constraint_policy="report"))
    assert layers.read("marts.dim_stores").count() == 3


def test_gate_can_stop_the_run(spark, raw, tmp_path):
    with pytest.raises(QualityGateError, match="duplicate_receipt_no"):
        run_pipeline(spark, raw(), str(tmp_path), WarehouseConfig(gate_policy="fail"))
    assert Layers(spark, str(tmp_path)).published() is None
    with pytest.raises(FileNotFoundError):
        Layers(spark, str(tmp_path)).read("marts.dim_stores")


def test_gate_warns_by_default(caplog):
    assert quality_gate("orphans", {"a": 0}, "fail")
    assert not quality_gate("orphans", {"a": 2}, "warn")
    assert "orphans" in caplog.text


def test_lost_rows_fail_loudly():
    class Metrics:
        def rows_of(self, table):
            return {"raw.transactions": 10, "marts.fact_transactions": 0}[table]

    with pytest.raises(RowAccountError, match="fact rows expected"):
        _check_accounts(Metrics(), {"in_fact": (10, 10)})
    with pytest.raises(RowAccountError, match="do not sum"):
        _check_accounts(Metrics(), {"in_fact": (9, 0)})


def test_landed_files_to_star_schema(spark, tmp_path):
    masters = dict(stores=STORES, staff=STAFF, managers=MANAGERS, products=PRODUCTS)
    for name, rows in masters.items():
        folder = tmp_path / "landing" / "masters" / name
        folder.mkdir(parents=True)
        lines = [",".join(fixed.MASTER_COLUMNS[name])] + [",".join(r) for r in rows]
        (folder / "list.csv").write_text("\n".join(lines) + "\n")
    for store in ("S001", "S002"):
        folder = tmp_path / "landing" / "sales" / f"SalesLog_{store}"
        folder.mkdir(parents=True)
        lines = [",".join(fixed.SALES_HEADERS)] + [
            ",".join(c or "" for c in line[:8]) for line in LINES if line[1] == store]
        (folder / "day1.csv").write_text("\n".join(lines) + "\n")
    result = run_landed(spark, str(tmp_path / "landing"), str(tmp_path / "house"), sources=[
        Source("S001", "SalesLog_S001"), Source("S002", "SalesLog_S002")])
    assert result.outcomes["in_fact"] == 5
