from .analysis import employee_coverage, fact_distinct_attributed, layer_counts, raw_file_distinct
from .calendar import calendar_between, dim_date
from .clean import (
    clean_customer,
    clean_employee_history,
    clean_product,
    clean_sales,
    clean_store,
    clean_supplier,
)
from .dedupe import dedupe_latest
from .facts import fact_sales
from .history import history_apply, history_close, history_insert
from .keys import assign_surrogate_keys, hash_surrogate_key, max_surrogate_key
from .merge import (
    append_rows,
    check_unique_source,
    insert_missing,
    merge_latest,
    merge_sorted,
    merge_update,
    merge_upsert,
    new_keys,
)
from .scd import (
    current_rows,
    scd1_apply,
    scd1_update,
    scd2_apply,
    scd2_changes,
    scd2_close,
)
from .table_merge import upsert_table

__all__ = [name for name in dir() if not name.startswith("_")]
