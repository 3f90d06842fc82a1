"""Column layouts of the retail lakehouse.

Fixed values: the column names and types below are the tables' contract with
the people who query them, so they are spelled out rather than derived.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# Files as they land, in ingest order (the header row names the columns).
LANDING = {
    "customer": (
        "customer_id string, customer_name string, gender string, age int, "
        "email string, phone_number string, city string, loyalty_tier string"
    ),
    "employee": (
        "employee_id string, employee_code string, store_id string, store_name string, "
        "effective_from date, effective_to date, is_current boolean, is_primary boolean"
    ),
    "product": (
        "product_id string, product_name string, supplier_id string, "
        "supplier_name string, return_policy string, warranty string"
    ),
    "store": "store_id string, store_name string, city string",
    "supplier": "supplier_id string, supplier_name string",
    "sales_raw": (
        "sale_id string, sale_ts timestamp, customer_id string, product_id string, "
        "store_id string, employee_id string, quantity int, unit_price double, "
        "coupon_code string, discount_percent double, mode string"
    ),
}

AUDIT = "source_file string, imported_date timestamp"

# Where the bronze table stores another type than the file is read with, the
# table's type wins.
BRONZE_TYPES = {
    "employee": {"effective_from": "timestamp", "effective_to": "timestamp"},
    "sales_raw": {"unit_price": "decimal(10,2)", "discount_percent": "decimal(5,2)"},
}

SILVER = {
    "customer_clean": f"{LANDING['customer']}, {AUDIT}",
    "product_clean": f"{LANDING['product']}, {AUDIT}",
    "store_clean": f"{LANDING['store']}, {AUDIT}",
    "supplier_clean": f"{LANDING['supplier']}, {AUDIT}",
    "employee_clean_history": f"{LANDING['employee']}, change_hash string, {AUDIT}",
    "sales_clean": f"{LANDING['sales_raw']}, {AUDIT}",
}

GOLD = {
    "dim_customer": (
        f"customer_sk bigint, {LANDING['customer']}, effective_from timestamp, "
        "effective_to timestamp, is_current boolean, hashdiff string"
    ),
    "dim_employee": (
        "employee_sk string, employee_id string, employee_code string, store_id string, "
        "store_name string, effective_from timestamp, effective_to timestamp, "
        f"is_current boolean, is_primary boolean, {AUDIT}"
    ),
    "dim_product": f"product_sk bigint, {LANDING['product']}, updated_at timestamp",
    "dim_store": f"store_sk bigint, {LANDING['store']}, updated_at timestamp",
    "dim_supplier": f"supplier_sk bigint, {LANDING['supplier']}, updated_at timestamp",
    "dim_date": (
        "date_sk int, full_date date, day int, month int, year int, quarter int, "
        "day_name string, month_name string, is_weekend boolean"
    ),
    "fact_sales": (
        "sale_id string, date_sk int, customer_sk bigint, employee_sk string, "
        "product_sk bigint, store_sk bigint, quantity int, unit_price decimal(18,2), "
        "discount_amt decimal(18,2), gross_amt decimal(18,2), net_amt decimal(18,2), "
        "load_ts timestamp"
    ),
}

# Columns that tables keep for the loads; readers of a layer do not get them.
HIDDEN = "_"
LOAD = "_load"  # number of the load that last wrote the row
BUCKET = "_bucket"  # partition: hash of the key
SOURCE_HASH = "_source_hash"  # of the silver values a fact row was made from

# Compression of the files of tables and of what loads write out on the way.
CODEC = "zstd"

# Tables that are merged by key in place: dealt into buckets of it.
BUCKET_KEYS = {
    ("silver", "customer_clean"): "customer_id",
    ("silver", "product_clean"): "product_id",
    ("silver", "sales_clean"): "sale_id",
    ("gold", "fact_sales"): "sale_id",
}

# Silver tables whose rows carry the number of their load.
LOADED = ("customer_clean", "product_clean", "store_clean", "supplier_clean", "sales_clean")

# Open-ended validity.
OPEN_DATE = "9999-12-31"
OPEN_CUSTOMER_TS = "9999-12-31 23:59:59"
OPEN_EMPLOYEE_TS = "9999-12-31 00:00:00"

# Days the shipped calendar covers.
CALENDAR_FIRST_DAY = "2015-01-01"
CALENDAR_LAST_DAY = "2035-12-31"


def struct(columns: str) -> StructType:
    return StructType.fromDDL(columns)


def landing_schema(entity: str) -> StructType:
    return struct(LANDING[entity])


def bronze_schema(entity: str) -> StructType:
    """Landing columns in their stored types, then the audit columns."""
    stored = BRONZE_TYPES.get(entity, {})
    columns = [
        f"{f.name} {stored.get(f.name, f.dataType.simpleString())}"
        for f in landing_schema(entity)
    ]
    return struct(", ".join([*columns, AUDIT]))
