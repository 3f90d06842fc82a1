"""Bronze to silver: column rules per entity and row validity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from stratalake.functions import (
    hashdiff,
    norm_key,
    norm_lower,
    norm_phone,
    norm_title,
    norm_upper,
    parse_bool,
)
from stratalake.schemas import HIDDEN, OPEN_DATE

Rule = Callable[[str], Column]


def _keep(name: str) -> Column:
    return F.col(name)


def _as(type_name: str) -> Rule:
    return lambda name: F.col(name).try_cast(type_name)


CUSTOMER_RULES: dict[str, Rule] = {
    "customer_id": norm_key,
    "customer_name": norm_title,
    "gender": norm_upper,
    "age": _as("int"),
    "email": norm_lower,
    "phone_number": norm_phone,
    "city": norm_title,
    "loyalty_tier": norm_title,
}

PRODUCT_RULES: dict[str, Rule] = {
    "product_id": norm_key,
    "product_name": norm_title,
    "supplier_id": norm_key,
    "supplier_name": norm_title,
    "return_policy": norm_key,
    "warranty": norm_key,
}

STORE_RULES: dict[str, Rule] = {
    "store_id": norm_key,
    "store_name": norm_title,
    "city": norm_title,
}

SUPPLIER_RULES: dict[str, Rule] = {
    "supplier_id": norm_key,
    "supplier_name": norm_title,
}

EMPLOYEE_RULES: dict[str, Rule] = {
    "employee_id": norm_key,
    "employee_code": norm_key,
    "store_id": norm_key,
    "store_name": norm_title,
    "effective_from": _as("date"),
    "effective_to": lambda name: F.coalesce(_as("date")(name), F.lit(OPEN_DATE).cast("date")),
    "is_current": parse_bool,
    "is_primary": parse_bool,
}

# The fingerprint covers the values as delivered, before trimming.
EMPLOYEE_FINGERPRINT = ("employee_code", "store_id", "store_name", "is_primary")

SALES_RULES: dict[str, Rule] = {
    "sale_id": norm_key,
    "sale_ts": _as("timestamp"),
    "customer_id": norm_key,
    "product_id": norm_key,
    "store_id": norm_key,
    "employee_id": norm_key,
    "quantity": _as("int"),
    "unit_price": _as("double"),
    "coupon_code": norm_key,
    "discount_percent": _as("double"),
    "mode": norm_lower,
}

AUDIT_RULES: dict[str, Rule] = {"source_file": _keep, "imported_date": _keep}


def apply_rules(rows: DataFrame, rules: dict[str, Rule]) -> DataFrame:
    """One projection: every rule's column under its own name, then the audit columns.

    Columns that no rule knows come last, as they are: files may have gained them.
    """
    both = {**rules, **AUDIT_RULES}
    gained = [c for c in rows.columns if c not in both and not c.startswith(HIDDEN)]
    return rows.select(*(rule(name).alias(name) for name, rule in both.items()), *gained)


def clean_customer(bronze: DataFrame) -> DataFrame:
    return apply_rules(bronze, CUSTOMER_RULES)


def clean_product(bronze: DataFrame) -> DataFrame:
    return apply_rules(bronze, PRODUCT_RULES)


def clean_store(bronze: DataFrame) -> DataFrame:
    return apply_rules(bronze, STORE_RULES)


def clean_supplier(bronze: DataFrame) -> DataFrame:
    return apply_rules(bronze, SUPPLIER_RULES)


def clean_employee_history(bronze: DataFrame) -> DataFrame:
    """Typed employee versions with a change fingerprint; rows without id are left out."""
    rules = {
        **EMPLOYEE_RULES,
        "change_hash": lambda _: hashdiff(EMPLOYEE_FINGERPRINT, sep="|"),
    }
    return apply_rules(bronze.filter(F.col("employee_id").isNotNull()), rules)


def clean_sales(bronze: DataFrame) -> DataFrame:
    """Typed sale lines; a line needs an id, a positive quantity and a price of zero or more."""
    return apply_rules(bronze, SALES_RULES).filter(
        F.col("sale_id").isNotNull() & (F.col("quantity") > 0) & (F.col("unit_price") >= 0)
    )
