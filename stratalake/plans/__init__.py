from .bronze import ingest_all, run_bronze
from .gold import (
    customer_snapshot,
    employee_snapshot,
    load_dim_customer,
    load_dim_employee,
    load_dim_type_1,
    run_gold,
)
from .silver import load_silver_entity, run_silver, sales_upsert_latest

__all__ = [
    "customer_snapshot",
    "employee_snapshot",
    "ingest_all",
    "load_dim_customer",
    "load_dim_employee",
    "load_dim_type_1",
    "load_silver_entity",
    "run_bronze",
    "run_gold",
    "run_silver",
    "sales_upsert_latest",
]
