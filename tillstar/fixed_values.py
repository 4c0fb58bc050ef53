"""Fixed values.

These must equal what the source sheets and the business rules use; they are
data, not logic, and are stated here once for the whole package.
"""

# Sales sheet header -> raw column.
SALES_HEADERS = {
    "Timestamp": "timestamp",
    "Store ID": "store_id",
    "Staff Name": "staff_name",
    "Receipt No.": "receipt_no",
    "Customer Phone Number (Optional)": "customer_phone",
    "Product Sold": "product_sold",
    "Quantity": "quantity",
    "Payment Method": "payment_method",
}

# Columns taken from a sales sheet; the store id and the sheet
# name come from the source registry, never from the sheet.
SALES_SHEET_COLUMNS = (
    "timestamp",
    "staff_name",
    "receipt_no",
    "customer_phone",
    "product_sold",
    "quantity",
    "payment_method",
)

# Columns of the four master lists.
MASTER_COLUMNS = {
    "products": (
        "product_id", "product_name", "category",
        "unit_price_ghs", "last_updated", "updated_by",
    ),
    "staff": (
        "staff_id", "full_name", "role", "store_id",
        "store_city", "phone_number", "date_hired", "employment_status",
    ),
    "managers": (
        "manager_id", "full_name", "role", "store_id",
        "phone_number", "email", "date_appointed", "reports_to",
    ),
    "stores": ("store_id", "city", "region"),
}

# Allowed domains.
PAYMENT_METHODS = ("Cash", "Card", "Transfer")
STAFF_ROLES = ("Cashier", "Sales Associate", "Stock Clerk", "Security")
EMPLOYMENT_STATUSES = ("Active", "Inactive")
MANAGER_ROLES = ("Store Manager", "Assistant Store Manager", "Regional Manager")
REGIONS = ("Southern Region", "Middle Belt Region", "Northern Region")

# Limits, patterns and formats.
QUANTITY_RANGE = (1, 5)
RECEIPT_REPEAT_LIMIT = 3
NUMBER_PATTERN = r"\A[0-9]+(\.[0-9]+)?\z"
SERIAL_DATE_EPOCH = "1899-12-30"
STORE_COUNT = 11
SPINE_START = "2026-01-01"
SPINE_END = "2026-12-31"

# Names of the data-quality checks.
DUPLICATE_RECEIPT = "duplicate_receipt_no"
UNMATCHED_PRODUCT = "unmatched_product_name"
UNMATCHED_STAFF = "unmatched_staff_name"
ORPHAN_CHECKS = {
    "no_matching_store": "store_key",
    "no_matching_staff": "staff_key",
    "no_matching_product": "product_key",
    "no_matching_date": "date_key",
}
