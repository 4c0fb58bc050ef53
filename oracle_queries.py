"""The same results in plain SQL for DuckDB, one statement per registered query."""

from __future__ import annotations

import re

from tillstar.fixed_values import MASTER_COLUMNS
from tillstar.sources.star_tables import (
    ABSENT_SHEET,
    DELIVERIES_SQL,
    EMPTY_SHEET,
    RAW_SQL,
    SECOND_LOAD,
    TABLES,
)

_RAW = {name: sql.format(**{t: t for t in TABLES}) for name, sql in RAW_SQL.items()}

_NUMBER = r"regexp_full_match(trim({0}, ' '), '[0-9]+(\.[0-9]+)?')"
_NORM = "trim(lower({0}), ' ')"
_SERIAL = (
    "case when " + _NUMBER + " then date '1899-12-30'"
    " + cast(cast(trim({0}, ' ') as double) as integer) end"
)
_BLANK = "nullif(trim({0}, ' '), '')"
_LINE = "timestamp, store_id, staff_name, receipt_no, customer_phone, product_sold, quantity," \
    " payment_method, source_sheet"
_ORDER = "timestamp, store_id, staff_name, quantity, payment_method, customer_phone, source_sheet"

_CTES = {
    **_RAW,
    "stg_stores": """
select trim(store_id, ' ') as store_id, trim(city, ' ') as city, trim(region, ' ') as region
from raw_stores where store_id is not null and store_id <> ''
""",
    "stg_staff": f"""
select trim(staff_id, ' ') as staff_id, trim(full_name, ' ') as full_name,
 trim(role, ' ') as role, trim(store_id, ' ') as store_id,
 {_BLANK.format('phone_number')} as phone_number,
 {_SERIAL.format('date_hired')} as date_hired,
 trim(employment_status, ' ') as employment_status
from raw_staff where staff_id is not null and staff_id <> ''
 and trim(role, ' ') in ('Cashier', 'Sales Associate', 'Stock Clerk', 'Security')
 and trim(employment_status, ' ') in ('Active', 'Inactive')
""",
    "stg_managers": f"""
select trim(manager_id, ' ') as manager_id, trim(full_name, ' ') as full_name,
 trim(role, ' ') as role, trim(store_id, ' ') as store_id,
 {_BLANK.format('phone_number')} as phone_number, {_BLANK.format('email')} as email,
 {_SERIAL.format('date_appointed')} as date_appointed,
 {_BLANK.format('reports_to')} as reports_to
from raw_managers where manager_id is not null and manager_id <> ''
 and trim(role, ' ') in ('Store Manager', 'Assistant Store Manager', 'Regional Manager')
""",
    "stg_products": f"""
select trim(product_id, ' ') as product_id, trim(product_name, ' ') as product_name,
 trim(category, ' ') as category,
 cast(trim(unit_price_ghs, ' ') as decimal(10,2)) as unit_price_ghs,
 cast(null as date) as last_updated, {_BLANK.format('updated_by')} as updated_by
from raw_products where product_id is not null and product_id <> ''
 and unit_price_ghs is not null and unit_price_ghs <> '' and {_NUMBER.format('unit_price_ghs')}
""",
    "parsed": """
select *, try_cast(timestamp as timestamp) as transaction_date,
 try_cast(quantity as integer) as units from raw_transactions
""",
    "judged": """
select *, concat_ws(',',
 case when transaction_date is null then 'transaction_date_not_null' end,
 case when store_id is null then 'store_id_not_null' end,
 case when staff_name is null then 'staff_name_not_null' end,
 case when receipt_no is null then 'receipt_no_not_null' end,
 case when product_sold is null then 'product_sold_not_null' end,
 case when units is null then 'quantity_not_null' end,
 case when payment_method is null then 'payment_method_not_null' end,
 case when source_sheet is null then 'source_sheet_not_null' end,
 case when units not between 1 and 5 then 'quantity_range' end,
 case when payment_method not in ('Cash', 'Card', 'Transfer') then 'payment_method_domain' end
) as failed_checks from parsed
""",
    "ranked": f"""
select *, row_number() over (partition by receipt_no, product_sold order by {_ORDER}) as place
from judged where failed_checks = ''
""",
    "stg_transactions": f"""
select transaction_date, store_id, staff_name, receipt_no,
 {_BLANK.format('customer_phone')} as customer_phone, product_sold, units as quantity,
 payment_method, source_sheet from ranked where place = 1
""",
    "surplus": f"""
select {_LINE}, count(*) as copies from ranked where place > 1 group by {_LINE}
""",
    "rejected": f"""
select {_LINE}, failed_checks, cast(1 as bigint) as copies from judged where failed_checks <> ''
union all select {_LINE}, 'receipt_product_unique', copies from surplus
""",
    "duplicates": """
select 'raw.transactions' as table_name, 'duplicate_receipt_no' as check_name, store_id,
 source_sheet, receipt_no as raw_value
from raw_transactions group by receipt_no, store_id, source_sheet having count(*) > 3
""",
    "lost_products": f"""
select distinct 'raw.transactions' as table_name, 'unmatched_product_name' as check_name,
 t.store_id, t.source_sheet, t.product_sold as raw_value
from raw_transactions t left join raw_products p
 on {_NORM.format('t.product_sold')} = {_NORM.format('p.product_name')}
where p.product_name is null and t.product_sold is not null and t.product_sold <> ''
""",
    "lost_staff": f"""
select distinct 'raw.transactions' as table_name, 'unmatched_staff_name' as check_name,
 t.store_id, t.source_sheet, t.staff_name as raw_value
from raw_transactions t left join raw_staff s
 on {_NORM.format('t.staff_name')} = {_NORM.format('s.full_name')}
where s.full_name is null and t.staff_name is not null and t.staff_name <> ''
""",
    "all_findings": """
select * from duplicates union all select * from lost_products union all select * from lost_staff
""",
    "d_stores": """
select row_number() over (order by store_id) as store_key, store_id, city, region from stg_stores
""",
    "d_staff": """
select row_number() over (order by staff_id) as staff_key, staff_id, full_name, role, store_id,
 phone_number, date_hired, employment_status from stg_staff
""",
    "d_managers": """
select row_number() over (order by manager_id) as manager_key, manager_id, full_name, role,
 store_id, phone_number, email, date_appointed, reports_to from stg_managers
""",
    "d_products": """
select row_number() over (order by product_id) as product_key, product_id, product_name,
 category, unit_price_ghs from stg_products
""",
    "d_date": """
select row_number() over (order by d) as date_key, cast(d as date) as full_date,
 rpad(dayname(d), 9, ' ') as day_of_week, day(d) as day_num, month(d) as month_num,
 rpad(monthname(d), 9, ' ') as month_name, quarter(d) as quarter, year(d) as year,
 dayofweek(d) in (0, 6) as is_weekend
from (select unnest(generate_series(date_trunc('year', first), date_trunc('year', last)
   + interval 1 year - interval 1 day, interval 1 day)) as d
  from (select cast(min(o_orderdate) as timestamp) as first,
    cast(max(o_orderdate) as timestamp) as last from orders))
""",
    "fact": f"""
select t.receipt_no, t.transaction_date, t.store_id, t.staff_name,
 {_BLANK.format('t.customer_phone')} as customer_phone, p.product_name, p.category, t.quantity,
 p.unit_price_ghs, cast(t.quantity * p.unit_price_ghs as decimal(10,2)) as total_amount_ghs,
 t.payment_method, t.source_sheet, s.store_key, e.staff_key, p.product_key, d.date_key
from stg_transactions t
 join d_products p on {_NORM.format('t.product_sold')} = {_NORM.format('p.product_name')}
 join d_stores s on trim(t.store_id, ' ') = trim(s.store_id, ' ')
 join d_staff e on {_NORM.format('t.staff_name')} = {_NORM.format('e.full_name')}
  and trim(t.store_id, ' ') = trim(e.store_id, ' ')
 join d_date d on cast(t.transaction_date as date) = d.full_date
where not exists (select 1 from duplicates v where v.raw_value = t.receipt_no)
""",
    "visits": """
select customer_phone, min(cast(transaction_date as date)) as first_seen_date,
 count(distinct receipt_no) as total_visits
from fact where customer_phone is not null and customer_phone <> '' group by customer_phone
""",
    "kept_stores": "select * from d_stores where region <> 'Offshore Region'",
    "kept_staff": "select * from d_staff where employment_status = 'Active'",
    "kept_products": "select * from d_products where category <> 'PROMO'",
    "kept_dates": "select * from d_date where year < 1999",
}


_MONTH = "strftime(transaction_date, '%Y-%m')"
_SECOND = f"substr(timestamp, 1, 7) in {SECOND_LOAD}"
_CTES |= {
    "deliveries": DELIVERIES_SQL.format(raw_transactions="raw_transactions"),
    "parsed_d": _CTES["parsed"].replace("raw_transactions", "deliveries"),
    "judged_d": _CTES["judged"].replace("from parsed", "from parsed_d"),
    "ranked_d": f"""
select *, row_number() over (partition by receipt_no, product_sold, delivery
 order by delivered_day desc, {_ORDER}) as place from judged_d where failed_checks = ''
""",
    "kept_d": """
select * from (select *, row_number() over (partition by receipt_no, product_sold
  order by delivery) as first_place from ranked_d
 where place = 1 and not (delivery = 4 and delivered_day = 0)) x where first_place = 1
""",
    "ranked_l": f"""
select *, row_number() over (partition by receipt_no, product_sold
 order by {_SECOND}, {_ORDER}) as place from judged where failed_checks = ''
""",
    "stg_l": f"""
select transaction_date, store_id, staff_name, receipt_no,
 {_BLANK.format('customer_phone')} as customer_phone, product_sold, units as quantity,
 payment_method, source_sheet, {_SECOND} as is_second from ranked_l where place = 1
""",
    "fact_l": _CTES["fact"].replace("stg_transactions", "stg_l"),
    "visits_l": _CTES["visits"].replace("from fact", "from fact_l"),
    "flagged_first": f"""
select receipt_no from raw_transactions where not ({_SECOND})
group by receipt_no, store_id, source_sheet having count(*) > 3
""",
    "rebuilt_l": f"""
select distinct {_MONTH} as month from stg_l where is_second or receipt_no in (
 select raw_value from duplicates where raw_value not in (select receipt_no from flagged_first))
""",
}


def _lasting(name: str, table: str, business_id: str) -> str:
    number = f"cast(regexp_extract({business_id}, '[0-9]+') as int)"
    return f"""
select '{name}' as dimension, business_id, row_number() over (order by not is_first,
  business_id) as surrogate_key, is_current
from (select {business_id} as business_id, bool_or({number} % 10 <> 3) as is_first,
  bool_or({number} % 7 <> 2) as is_current from {table} group by {business_id})
where is_first or is_current"""


def _orphans(stores: str, staff: str, products: str, dates: str) -> str:
    return " union all ".join(
        f"select '{check}' as check_name, count(*) as orphan_count from fact f"
        f" left join {table} d on f.{key} = d.{key} where d.{key} is null"
        for check, table, key in [
            ("no_matching_store", stores, "store_key"),
            ("no_matching_staff", staff, "staff_key"),
            ("no_matching_product", products, "product_key"),
            ("no_matching_date", dates, "date_key"),
        ]
    )


def _orphan_keys(table: str, key: str) -> str:
    return (
        f"select f.{key}, count(*) as fact_rows from fact f left join {table} d"
        f" on f.{key} = d.{key} where d.{key} is null group by f.{key}"
    )


def _counts(tables: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{name}' as table_name, count(*) as rows from {source}"
        for name, source in tables.items()
    )


_STAGED = {f"staging.{n}": f"stg_{n}" for n in ("stores", "staff", "managers", "products")}
_PRICE = "case when " + _NUMBER + " then cast(trim({0}, ' ') as decimal(10,2)) end"


def _check_counts(layer: str, name: str, source: str, price: str) -> str:
    key = MASTER_COLUMNS[name][0]
    value = f"nullif(trim({key}, ' '), '')"
    failed = {
        f"{key}_not_null": f"count(*) - count({value})",
        f"{key}_unique": f"count({value}) - count(distinct {value})",
    }
    if name == "products":
        failed["unit_price_ghs_positive"] = f"count(*) filter (where {price} <= 0)"
    return " union all ".join(
        f"select '{layer}.{name}' as table_name, '{check}' as check_name,"
        f" count(*) as rows_checked, {rows} as failed_rows from {source}"
        for check, rows in failed.items())


_REGISTRY = """(
 select 'S' || lpad(cast(n_nationkey as string), 3, '0') as store_id from nation
 union all select 'S9' || lpad(cast(count(*) as string), 2, '0') from nation)"""
_WEEK = "transaction_date >= timestamp '1998-03-02' and transaction_date < timestamp '1998-03-09'"
_MEASURES = "count(*) as sales_lines, cast(sum(quantity) as bigint) as units_sold," \
    " cast(sum(total_amount_ghs) as decimal(28,2)) as revenue_ghs"

_FINAL = {
    "raw_transactions": "select * from raw_transactions",
    "raw_products": "select * from raw_products",
    "raw_staff": "select * from raw_staff",
    "raw_managers": "select * from raw_managers",
    "raw_stores": "select * from raw_stores",
    "raw_default_fill": "select timestamp, staff_name, receipt_no, customer_phone, product_sold,"
        " quantity, '' as payment_method from raw_transactions",
    "raw_stamp_source": "select receipt_no, product_sold, store_id, source_sheet"
        " from raw_transactions",
    "source_row_counts": f"""
select r.store_id, 'SalesLog_' || r.store_id as sheet_name, count(t.source_sheet) as row_count
from {_REGISTRY} r left join raw_transactions t on t.source_sheet = 'SalesLog_' || r.store_id
group by r.store_id""",
    "landed_sales": "select * from raw_transactions",
    "landed_source_counts": f"""
select store_id, source_sheet as sheet_name, count(*) as row_count from raw_transactions
group by all union all select 'S998', '{EMPTY_SHEET}', 0
union all select 'S999', '{ABSENT_SHEET}', 0""",
    "landed_masters": " union all ".join(
        f"select '{name}' as list_name, {columns[0]} as row_id,"
        f" md5(concat_ws('|', {', '.join(columns)})) as cells_md5 from raw_{name}"
        for name, columns in MASTER_COLUMNS.items()),
    "dim_date_upsert": "select * from d_date",
    "blank_to_null": f"select receipt_no, {_BLANK.format('customer_phone')} as customer_phone"
        " from raw_transactions",
    "filter_blank_key": "select receipt_no, product_sold from raw_transactions"
        " where product_sold is not null and product_sold <> ''",
    "filter_domain": "select staff_id, trim(role, ' ') as role, employment_status from raw_staff"
        " where trim(role, ' ') in ('Cashier', 'Sales Associate', 'Stock Clerk', 'Security')"
        " and trim(employment_status, ' ') in ('Active', 'Inactive')",
    "filter_numeric_text": "select product_id, unit_price_ghs from raw_products"
        f" where {_NUMBER.format('unit_price_ghs')}",
    "serial_to_date": "select staff_id, date_hired,"
        f" {_SERIAL.format('date_hired')} as hired_on from raw_staff",
    "price_cast": "select p_partkey,"
        " cast(cast(cast(p_retailprice as decimal(10,2)) as string) as decimal(10,2)) as price,"
        " cast(cast(cast(p_retailprice as decimal(10,2)) * 0.125 as string) as decimal(10,2))"
        " as price_eighth from part",
    "stg_stores": "select * from stg_stores",
    "stg_staff": "select * from stg_staff",
    "stg_managers": "select * from stg_managers",
    "stg_products": "select * from stg_products",
    "stg_transactions": "select * from stg_transactions",
    "stg_transactions_rejected": "select * from rejected",
    "check_not_null": "select product_id, 'unit_price_ghs_not_null' as check_name,"
        " unit_price_ghs as raw_value from raw_products"
        " where try_cast(trim(unit_price_ghs, ' ') as decimal(10,2)) is null",
    "check_range": "select store_id, 'units_range' as check_name, cast(units as string) as"
        " raw_value, count(*) as violations from parsed where units not between 1 and 5"
        " group by store_id, units",
    "check_domain": """
select 'staging.stores' as table_name, 'region_domain' as check_name, region as raw_value,
 count(*) as violations from stg_stores
 where region not in ('Southern Region', 'Middle Belt Region', 'Northern Region') group by region
union all select 'raw.staff', 'role_domain', trim(role, ' '), count(*) from raw_staff
 where trim(role, ' ') not in ('Cashier', 'Sales Associate', 'Stock Clerk', 'Security')
 group by trim(role, ' ')
union all select 'raw.staff', 'employment_status_domain', employment_status, count(*)
 from raw_staff where employment_status not in ('Active', 'Inactive') group by employment_status
union all select 'raw.managers', 'role_domain', trim(role, ' '), count(*) from raw_managers
 where trim(role, ' ') not in ('Store Manager', 'Assistant Store Manager', 'Regional Manager')
 group by trim(role, ' ')
union all select 'raw.transactions', 'payment_method_domain', payment_method, count(*)
 from raw_transactions where payment_method not in ('Cash', 'Card', 'Transfer')
 group by payment_method""",
    "check_positive": "select c_custkey, 'balance_positive' as check_name,"
        " cast(cast(c_acctbal as decimal(10,2)) as string) as raw_value from customer"
        " where cast(c_acctbal as decimal(10,2)) <= 0",
    "check_unique_key": "select receipt_no, count(*) as copies from raw_transactions"
        " group by receipt_no having count(*) > 1",
    "check_counts": " union all ".join(
        _check_counts(layer, name, source, price)
        for name in ("stores", "staff", "managers", "products")
        for layer, source, price in (
            ("raw", f"raw_{name}", _PRICE.format("unit_price_ghs")),
            ("staging", f"stg_{name}", "unit_price_ghs"))),
    "check_unique_composite": f"""
select {_LINE}, count(*) as copies from (
 select *, row_number() over (partition by receipt_no, product_sold order by {_ORDER}) as place
 from raw_transactions) x where place > 1 group by {_LINE}""",
    "constraint_findings": """
select 'staging.transactions' as table_name, v.check_name, store_id, source_sheet, v.raw_value,
 cast(1 as bigint) as copies
from judged, lateral (
 select 'transaction_date_not_null' as check_name, timestamp as raw_value
  where transaction_date is null
 union all select 'quantity_not_null', quantity where units is null
 union all select 'quantity_range', quantity where units not between 1 and 5
 union all select 'payment_method_domain', payment_method
  where payment_method not in ('Cash', 'Card', 'Transfer')) v
union all select 'staging.transactions', 'receipt_product_unique', store_id, source_sheet,
 receipt_no || '|' || product_sold, copies from surplus""",
    "duplicate_receipts": "select * from duplicates",
    "unmatched_products": "select * from lost_products",
    "unmatched_staff": "select * from lost_staff",
    "validation_log": "select * from all_findings",
    "audit_summary": "select check_name, count(*) as findings from all_findings"
        " group by check_name order by findings desc, check_name",
    "audit_detail": "select store_id, source_sheet, raw_value from all_findings"
        " where check_name = 'unmatched_product_name'",
    "dim_stores": "select * from d_stores",
    "dim_staff": "select * from d_staff",
    "dim_managers": "select * from d_managers",
    "dim_products": "select * from d_products",
    "dim_date": "select * from d_date",
    "dim_customers": "select row_number() over (order by customer_phone) as customer_key, *"
        " from visits",
    "join_product": "select t.receipt_no, t.product_sold, t.quantity, p.product_key,"
        " p.product_name, p.unit_price_ghs from stg_transactions t join d_products p"
        f" on {_NORM.format('t.product_sold')} = {_NORM.format('p.product_name')}",
    "join_store": "select t.receipt_no, t.product_sold, t.quantity, t.store_id, s.store_key"
        " from stg_transactions t join d_stores s"
        " on trim(t.store_id, ' ') = trim(s.store_id, ' ')",
    "join_staff": "select t.receipt_no, t.product_sold, t.quantity, t.store_id, t.staff_name,"
        " e.staff_key from stg_transactions t join d_staff e"
        f" on {_NORM.format('t.staff_name')} = {_NORM.format('e.full_name')}"
        " and trim(t.store_id, ' ') = trim(e.store_id, ' ')",
    "join_date": "select t.receipt_no, t.product_sold, t.quantity, t.transaction_date, d.date_key"
        " from stg_transactions t join d_date d"
        " on cast(t.transaction_date as date) = d.full_date",
    "exclude_flagged": "select receipt_no, product_sold, quantity, store_id"
        " from stg_transactions t where not exists"
        " (select 1 from duplicates v where v.raw_value = t.receipt_no)",
    "repeated_keys_by_receipt": "select receipt_no, product_sold, count(*) as copies"
        " from raw_transactions where receipt_no is not null and product_sold is not null"
        " group by receipt_no, product_sold having count(*) > 1",
    "fact_transactions": "select * from fact",
    "fact_key_density": "select count(*) as fact_rows, cast(1 as bigint) as first_key,"
        " count(*) as last_key, count(*) as different_keys from fact",
    "fk_store": _orphan_keys("kept_stores", "store_key"),
    "fk_staff": _orphan_keys("kept_staff", "staff_key"),
    "fk_product": _orphan_keys("kept_products", "product_key"),
    "fk_date": _orphan_keys("kept_dates", "date_key"),
    "fk_orphans": _orphans("d_stores", "d_staff", "d_products", "d_date"),
    "fk_orphans_injected":
        _orphans("kept_stores", "kept_staff", "kept_products", "kept_dates"),
    "row_outcomes": f"""
select o.outcome, cast(coalesce(sum(x.n), 0) as bigint) as source_rows,
 cast(coalesce(sum(x.fact_n), 0) as bigint) as fact_rows
from (values ('quarantined'), ('flagged_receipt'), ('no_product'), ('no_store'), ('no_staff'),
 ('no_date'), ('in_fact')) o(outcome)
left join (
 select 'quarantined' as outcome, copies as n, 0 as fact_n from rejected
 union all
 select case
   when exists (select 1 from duplicates v where v.raw_value = t.receipt_no)
    then 'flagged_receipt'
   when not exists (select 1 from stg_products p
    where {_NORM.format('t.product_sold')} = {_NORM.format('p.product_name')}) then 'no_product'
   when not exists (select 1 from stg_stores s
    where trim(t.store_id, ' ') = trim(s.store_id, ' ')) then 'no_store'
   when not exists (select 1 from stg_staff e
    where {_NORM.format('t.staff_name')} = {_NORM.format('e.full_name')}
     and trim(t.store_id, ' ') = trim(e.store_id, ' ')) then 'no_staff'
   when not exists (select 1 from d_date d
    where cast(t.transaction_date as date) = d.full_date) then 'no_date'
   else 'in_fact' end, 1, 0 from stg_transactions t
 union all select 'in_fact', 0, count(*) from fact
) x on x.outcome = o.outcome group by o.outcome""",
    "staging_counts": _counts(_STAGED),
    "dim_counts": _counts({"dim_stores": "stg_stores", "dim_staff": "stg_staff",
                           "dim_managers": "stg_managers", "dim_products": "stg_products",
                           "dim_date": "d_date"}),
    "fact_rows_by_store": "select store_id, count(*) as transaction_rows from fact"
        " group by store_id order by store_id",
    "top_customers": "select * from visits order by total_visits desc, customer_phone limit 5",
    "run_summary": _counts({
        "raw.transactions": "raw_transactions",
        **{f"raw.{n}": f"raw_{n}" for n in ("stores", "staff", "managers", "products")},
        **_STAGED,
        "staging.transactions": "stg_transactions",
        "audit.validation_log": "all_findings",
        "marts.dim_date": "d_date",
        "marts.fact_transactions": "fact",
        "marts.dim_customers": "visits",
    }),
    "top_store_for_product": "select store_id, cast(sum(quantity) as bigint) as units_sold"
        f" from fact where lower(product_name) like '%ring%' and {_WEEK}"
        " group by store_id order by units_sold desc, store_id limit 1",
    "top_store_per_week": """
select week_start, store_id, units_sold from (
 select *, row_number() over (partition by week_start order by units_sold desc, store_id) as place
 from (select cast(date_trunc('week', transaction_date) as date) as week_start, store_id,
   cast(sum(quantity) as bigint) as units_sold
  from fact where lower(product_name) like '%ring%' group by 1, 2) w) r
where place = 1""",
    "sales_by_store_month": "select f.store_id, d.year, d.month_num, " + _MEASURES +
        " from fact f join d_date d on f.date_key = d.date_key"
        " group by f.store_id, d.year, d.month_num",
    "sales_cube": f"""
select store_id, month, category, cast(grouping_id(store_id, month, category) as int) as level,
 {_MEASURES} from (select *, {_MONTH} as month from fact)
group by grouping sets ((store_id, month, category), (store_id, month), (store_id, category),
 (month, category), (store_id), (month), (category), ())""",
    "sales_on_days": f"select f.store_id, {_MEASURES} from fact f join d_date d"
        " on f.date_key = d.date_key where d.quarter = 2 and d.is_weekend group by f.store_id",
    "lasting_keys": " union all ".join(
        _lasting(name, f"stg_{name}", f"{one}_id") for name, one in
        (("stores", "store"), ("staff", "staff"), ("managers", "manager"),
         ("products", "product"))),
    "incremental_fact": f"select *, {_MONTH} in (select month from rebuilt_l) as rebuilt"
        " from fact_l",
    "incremental_customers": "select * from visits_l",
    "full_refresh": _counts({
        **{f"raw.{n}": f"raw_{n}"
           for n in ("transactions", "stores", "staff", "managers", "products")},
        **_STAGED,
        "staging.transactions": "stg_transactions",
        "staging.transactions_rejected": "rejected",
        "audit.validation_log": "all_findings",
        "audit.constraint_log": "constraint_rows",
        **{f"marts.dim_{n}": f"stg_{n}" for n in ("stores", "staff", "managers", "products")},
        "marts.dim_date": "d_date",
        "marts.fact_transactions": "fact",
        "marts.dim_customers": "visits",
    }),
    "stream_dedup": f"""
select {_LINE}, '' as failed_checks, cast(1 as bigint) as copies from kept_d
union all select {_LINE}, case when exists (select 1 from kept_d k where
   k.receipt_no = r.receipt_no and k.product_sold = r.product_sold) then 'receipt_product_unique'
  else 'delivered_too_late' end, 1 from ranked_d r where place = 1 and not exists (
   select 1 from kept_d k where k.receipt_no = r.receipt_no
   and k.product_sold = r.product_sold and k.delivery = r.delivery)
union all select {_LINE}, 'receipt_product_unique', count(*) from ranked_d where place > 1
 group by {_LINE}, delivery, delivered_day
union all select {_LINE}, failed_checks, 1 from judged_d where failed_checks <> ''""",
    "stream_flagged": """
select 'raw.transactions' as table_name, 'duplicate_receipt_no' as check_name, store_id,
 source_sheet, receipt_no as raw_value, cast(min(delivery) as int) as delivery from (
 select *, sum(n) over (partition by store_id, source_sheet, receipt_no order by delivery) as lines
 from (select store_id, source_sheet, receipt_no, delivery, count(*) as n
  from deliveries group by all)) where lines > 3 group by all""",
    "stream_ingest": "select * from stg_transactions",
    "stream_fact": "select * from fact",
    "sales_by_category": f"select category, {_MEASURES} from fact group by category",
}


_FINAL["exclude_flagged_by_receipt"] = _FINAL["exclude_flagged"]
_CTES["constraint_rows"] = _FINAL["constraint_findings"] + """
union all select 'staging.stores', 'region_domain', store_id, null, region, 1 from stg_stores
where region not in ('Southern Region', 'Middle Belt Region', 'Northern Region')"""


def _needed(sql: str) -> list[str]:
    """The common tables a statement reads, directly or through others, in order."""
    found: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in (n for n in _CTES if n in words and n not in found):
            found.add(name)
            todo.append(_CTES[name])
    return [name for name in _CTES if name in found]


def oracle_queries() -> dict[str, str]:
    statements = {}
    for name, final in _FINAL.items():
        ctes = ",\n".join(f"{n} as ({_CTES[n].strip()})" for n in _needed(final))
        statements[name] = f"with {ctes}\n{final.strip()}" if ctes else final.strip()
    return statements
