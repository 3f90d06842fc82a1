"""The same queries as DuckDB SQL, written independently of the operators.

Loads are replayed set by set: deliveries, cleaning, dedupe by a window over
all rows, joins on whole keys. Nothing here knows about staging, range
numbering or delivery days.
"""

from __future__ import annotations

from checks.feeds import (
    BALANCE_SPLIT,
    CUSTOMERS_SPLIT,
    EMPLOYEES_SPLIT,
    FIRST_DAY,
    GOLD_SPEND,
    PRODUCTS_SPLIT,
    SALES_SPLIT,
    SILVER_SPEND,
)
from checks.queries import CORRECTION_TIME, FIRST_LOAD, INGEST_TIME, SECOND_LOAD

OPEN_CUSTOMER = "9999-12-31 23:59:59"
OPEN_EMPLOYEE = "9999-12-31 00:00:00"


def title(text: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({text}), ' '), "
        "lambda w: upper(w[1]) || w[2:]), ' ')"
    )


def between(column: str, since: str | None, until: str | None) -> str:
    low = f"{column} >= TIMESTAMP '{since}'" if since else "true"
    high = f"{column} < TIMESTAMP '{until}'" if until else "true"
    return f"{low} AND {high}"


# --- feeds --------------------------------------------------------------------


def customer_feed(since: str | None = None, until: str | None = None) -> str:
    kind = "LEFT JOIN" if since is None and until is None else "JOIN"
    last_order = f"coalesce(last_order, TIMESTAMP '{FIRST_DAY}')"
    return f"""
    SELECT ' ' || c_custkey AS customer_id, lower(c_name) || '  ' AS customer_name,
           lower(c_mktsegment) || ' ' AS gender, c_nationkey + 18 AS age,
           ' ' || c_name || '@Example.COM' AS email,
           '+977-98 (' || c_custkey || ')' AS phone_number,
           lower(n_name) || ' TOWN' AS city,
           CASE WHEN spend >= {GOLD_SPEND} THEN 'GOLD'
                WHEN spend >= {SILVER_SPEND} THEN 'SILVER' ELSE 'BRONZE' END AS loyalty_tier,
           'customers_' || year({last_order}) || '.csv' AS source_file,
           {last_order} AS imported_date
    FROM customer
    {kind} (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spend,
                 max(o_orderdate) AS last_order
          FROM orders WHERE {between('o_orderdate', since, until)} GROUP BY o_custkey)
      ON c_custkey = o_custkey
    JOIN nation ON c_nationkey = n_nationkey"""


def product_feed(since: str | None = None, until: str | None = None) -> str:
    return f"""
    SELECT l_partkey || ' ' AS product_id, ' ' || upper(p_name) AS product_name,
           ' ' || l_suppkey AS supplier_id, lower(s_name) AS supplier_name,
           l_returnflag || ' ' AS return_policy, ' ' || p_type AS warranty,
           'products_' || l_linestatus || '.csv' AS source_file, l_shipdate AS imported_date
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    WHERE {between('l_shipdate', since, until)}"""


def store_feed(below: int | None = None) -> str:
    return f"""
    SELECT ' ' || n_nationkey AS store_id, lower(n_name) || ' ' || r_name AS store_name,
           upper(s_name) || ' ' AS city, 'stores.csv' AS source_file,
           TIMESTAMP '2024-01-01' AS imported_date
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    WHERE {f's_acctbal < {below}' if below is not None else 'true'}"""


def supplier_feed(below: int | None = None) -> str:
    name = "upper(s_name)" if below is not None else "lower(s_name) || ' ltd'"
    return f"""
    SELECT s_suppkey || ' ' AS supplier_id, {name} AS supplier_name,
           'suppliers.csv' AS source_file, TIMESTAMP '2024-01-01' AS imported_date
    FROM supplier WHERE {f's_acctbal < {below}' if below is not None else 'true'}"""


def employee_feed(since: str | None = None, until: str | None = None) -> str:
    return f"""
    SELECT ' ' || user_id AS employee_id, 'Emp-' || user_id AS employee_code,
           event_type || ' ' AS store_id, upper(event_type) || ' store' AS store_name,
           day AS effective_from,
           lead(day) OVER (PARTITION BY user_id ORDER BY day) - 1 AS effective_to,
           lead(day) OVER (PARTITION BY user_id ORDER BY day) IS NULL AS is_current,
           lead(day) OVER (PARTITION BY user_id ORDER BY day) IS NULL AS is_primary,
           'employees.csv' AS source_file, ts AS imported_date
    FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY day) AS before
          FROM (SELECT user_id, CAST(ts AS DATE) AS day, max(ts) AS ts,
                       arg_max(event_type, ts) AS event_type
                FROM events WHERE {between('ts', since, until)} GROUP BY ALL))
    WHERE before IS NULL OR before <> event_type"""


def sales_feed(since: str | None = None, until: str | None = None) -> str:
    return f"""
    SELECT l_orderkey || '-' || l_linenumber AS sale_id, o_orderdate AS sale_ts,
           ' ' || o_custkey AS customer_id, l_partkey || ' ' AS product_id,
           CAST(s_nationkey AS VARCHAR) AS store_id, CAST(o_custkey AS VARCHAR) AS employee_id,
           CAST(l_quantity AS INTEGER) AS quantity,
           CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_price,
           ' ' || o_orderpriority AS coupon_code,
           CAST(l_discount * 100 AS DECIMAL(5,2)) AS discount_percent,
           ' ' || l_returnflag AS mode, 'sales_' || l_linestatus || '.csv' AS source_file,
           l_shipdate AS imported_date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
    WHERE {between('l_shipdate', since, until)}"""


def returns_feed() -> str:
    return """
    SELECT CASE WHEN l_discount > 0.01 THEN l_orderkey || '-' || l_linenumber END AS sale_id, o_orderdate AS sale_ts,
           ' ' || o_custkey AS customer_id, l_partkey || ' ' AS product_id,
           CAST(s_nationkey AS VARCHAR) AS store_id, CAST(o_custkey AS VARCHAR) AS employee_id,
           CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity WHEN s_acctbal < 0 THEN 0 ELSE l_quantity END AS INTEGER)
             AS quantity,
           CAST(CASE WHEN l_discount < 0.09 THEN l_extendedprice * sign(s_acctbal + 500) END AS DECIMAL(10,2)) AS unit_price,
           o_orderpriority AS coupon_code, CAST(l_discount * 100 AS DECIMAL(5,2)) AS discount_percent,
           l_returnflag AS mode, 'till_' || l_linestatus || '.csv' AS source_file, l_shipdate AS imported_date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey"""


def unnamed_customers() -> str:
    return f"""
    SELECT * REPLACE (CASE WHEN CAST(trim(customer_id) AS BIGINT) NOT IN
                                (SELECT c_custkey FROM customer WHERE c_acctbal < 0) THEN customer_id END AS customer_id)
    FROM ({customer_feed()})"""


# --- cleaning -----------------------------------------------------------------


def cleaned(feed: str, trimmed: str = "", titled: str = "", **others: str) -> str:
    """``feed`` with text columns normalised and ``others`` replaced, in the feed's layout."""
    new = {c: f"trim({c})" for c in trimmed.split()}
    new |= {c: title(f"trim({c})") for c in titled.split()}
    new |= others
    return f"SELECT * REPLACE ({', '.join(f'{sql} AS {c}' for c, sql in new.items())}) FROM ({feed})"


def clean_customer(feed: str) -> str:
    return cleaned(
        feed,
        trimmed="customer_id",
        titled="customer_name city loyalty_tier",
        gender="upper(trim(gender))",
        email="lower(trim(email))",
        phone_number="regexp_replace(phone_number, '[^0-9+]', '', 'g')",
    )


def clean_product(feed: str) -> str:
    return cleaned(
        feed, "product_id supplier_id return_policy warranty", "product_name supplier_name"
    )


def clean_store(feed: str) -> str:
    return cleaned(feed, "store_id", "store_name city")


def clean_supplier(feed: str) -> str:
    return cleaned(feed, "supplier_id", "supplier_name")


def clean_employee(feed: str) -> str:
    hashed = f"""
    SELECT * EXCLUDE (source_file, imported_date),
           sha256(concat_ws('|', employee_code, store_id, store_name, is_primary)) AS change_hash,
           source_file, imported_date
    FROM ({feed})"""
    return cleaned(
        hashed,
        "employee_id employee_code store_id",
        "store_name",
        effective_to="coalesce(effective_to, DATE '9999-12-31')",
    )


def clean_sales(feed: str) -> str:
    lines = cleaned(
        feed,
        "sale_id customer_id product_id store_id employee_id coupon_code",
        unit_price="CAST(unit_price AS DOUBLE)",
        discount_percent="CAST(discount_percent AS DOUBLE)",
        mode="lower(trim(mode))",
    )
    return f"SELECT * FROM ({lines}) WHERE sale_id IS NOT NULL AND quantity > 0 AND unit_price >= 0"


def latest(rows: str, key: str, ties: str, order: str = "imported_date DESC, source_file DESC") -> str:
    """Newest row per key; ``ties`` lists the remaining columns in layout order."""
    ties_desc = ", ".join(f"{c.strip()} DESC" for c in ties.split(","))
    return f"""
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}, {ties_desc}) AS rn
      FROM ({rows})) WHERE rn = 1"""


CUSTOMER_TIES = "customer_name, gender, age, email, phone_number, city, loyalty_tier"
PRODUCT_TIES = "product_name, supplier_id, supplier_name, return_policy, warranty"
STORE_TIES = "store_name, city"
SUPPLIER_TIES = "supplier_name"
SALES_TIES = (
    "sale_ts, customer_id, product_id, store_id, employee_id, quantity, unit_price, "
    "coupon_code, discount_percent, mode"
)

CUSTOMERS = {
    1: clean_customer(customer_feed(until=CUSTOMERS_SPLIT)),
    2: clean_customer(customer_feed(since=CUSTOMERS_SPLIT)),
}
EMPLOYEES = {
    1: clean_employee(employee_feed(until=EMPLOYEES_SPLIT)),
    2: clean_employee(employee_feed(since=EMPLOYEES_SPLIT)),
}
DELIVERIES = {
    "customer": {n: latest(sql, "customer_id", CUSTOMER_TIES) for n, sql in CUSTOMERS.items()},
    "product": {
        1: latest(clean_product(product_feed(until=PRODUCTS_SPLIT)), "product_id", PRODUCT_TIES),
        2: latest(clean_product(product_feed(since=PRODUCTS_SPLIT)), "product_id", PRODUCT_TIES),
    },
    "store": {
        1: latest(clean_store(store_feed(BALANCE_SPLIT)), "store_id", STORE_TIES),
        2: latest(clean_store(store_feed()), "store_id", STORE_TIES),
    },
    "supplier": {
        1: latest(clean_supplier(supplier_feed(BALANCE_SPLIT)), "supplier_id", SUPPLIER_TIES),
        2: latest(clean_supplier(supplier_feed()), "supplier_id", SUPPLIER_TIES),
    },
}


def upserted(entity: str) -> str:
    """Silver table after both deliveries: all of the second, and the first's other keys."""
    first, second = DELIVERIES[entity][1], DELIVERIES[entity][2]
    key = f"{entity}_id"
    return f"""
    SELECT * FROM ({second}) UNION ALL
    SELECT * FROM ({first}) WHERE {key} NOT IN (SELECT {key} FROM ({second}))"""


# --- history ------------------------------------------------------------------

HISTORY_COLUMNS = (
    "employee_id, employee_code, store_id, store_name, effective_from, effective_to, "
    "is_current, is_primary, change_hash, source_file, imported_date"
)
HISTORY = f"""
    WITH delivered_1 AS MATERIALIZED ({EMPLOYEES[1]}),
    delivered_2 AS MATERIALIZED ({EMPLOYEES[2]}),
    loaded_1 AS MATERIALIZED (SELECT * REPLACE (true AS is_current) FROM delivered_1),
    starts AS (
      SELECT t.employee_id, t.effective_from, t.change_hash, min(s.effective_from) AS next_start,
             arg_min(s.imported_date, s.effective_from) AS next_import
      FROM loaded_1 t JOIN delivered_2 s ON s.employee_id = t.employee_id
       AND s.effective_from BETWEEN t.effective_from AND t.effective_to
       AND s.change_hash <> t.change_hash
      GROUP BY ALL),
    closed_1 AS MATERIALIZED (
      SELECT t.employee_id, employee_code, store_id, store_name, effective_from,
             coalesce(CAST(next_start - 1 AS DATE), effective_to) AS effective_to,
             next_start IS NULL AS is_current, is_primary, change_hash, source_file,
             greatest(imported_date, next_import) AS imported_date
      FROM loaded_1 t LEFT JOIN starts USING (employee_id, effective_from, change_hash)),
    added_2 AS MATERIALIZED (
      SELECT * REPLACE (true AS is_current) FROM delivered_2
      WHERE (employee_id, effective_from, change_hash) NOT IN
            (SELECT (employee_id, effective_from, change_hash) FROM loaded_1)),
    loaded_2 AS MATERIALIZED (
      SELECT {HISTORY_COLUMNS} FROM closed_1 UNION ALL SELECT {HISTORY_COLUMNS} FROM added_2)
"""


def history(of: str) -> str:
    return f"""{HISTORY} SELECT * REPLACE (
      strftime(effective_from, '%Y-%m-%d') AS effective_from,
      strftime(effective_to, '%Y-%m-%d') AS effective_to) FROM {of}"""


# --- dimensions ---------------------------------------------------------------


def fingerprinted(customers: str) -> str:
    return f"""
    SELECT customer_id, customer_name, gender, age, email, phone_number, city, loyalty_tier,
           sha256(concat_ws('||', customer_name, gender, age, email, phone_number, city,
                            loyalty_tier)) AS hashdiff
    FROM ({customers})"""


DIM_CUSTOMER_CTES = f"""
    customers_1 AS MATERIALIZED ({fingerprinted(CUSTOMERS[1])}),
    customers_2 AS MATERIALIZED ({fingerprinted(CUSTOMERS[2])}),
    dim_customer_1 AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY customer_id) AS customer_sk, *,
             TIMESTAMP '{FIRST_LOAD}' AS effective_from,
             TIMESTAMP '{OPEN_CUSTOMER}' AS effective_to, true AS is_current
      FROM customers_1),
    customer_changes AS MATERIALIZED (
      SELECT * FROM customers_2
      WHERE (customer_id, hashdiff) NOT IN (SELECT (customer_id, hashdiff) FROM dim_customer_1)),
    dim_customer_closed AS MATERIALIZED (
      SELECT * REPLACE (
        CASE WHEN customer_id IN (SELECT customer_id FROM customer_changes)
             THEN TIMESTAMP '{SECOND_LOAD}' ELSE effective_to END AS effective_to,
        customer_id NOT IN (SELECT customer_id FROM customer_changes) AS is_current)
      FROM dim_customer_1),
    dim_customer AS MATERIALIZED (
      SELECT * FROM dim_customer_closed UNION ALL BY NAME
      SELECT (SELECT max(customer_sk) FROM dim_customer_1)
               + row_number() OVER (ORDER BY customer_id) AS customer_sk, *,
             TIMESTAMP '{SECOND_LOAD}' AS effective_from,
             TIMESTAMP '{OPEN_CUSTOMER}' AS effective_to, true AS is_current
      FROM customer_changes)"""


def employee_snapshot(history_table: str) -> str:
    ties = (
        "employee_code, store_id, store_name, effective_to, is_current, is_primary, change_hash, source_file"
    )
    return f"""
    SELECT employee_id, employee_code, store_id, store_name, source_file, imported_date
    FROM ({latest(f'SELECT * FROM {history_table}', 'employee_id', ties, 'imported_date DESC, effective_from DESC')})"""


def opened_employees(rows: str, load: str) -> str:
    return f"""
      SELECT sha256(employee_id || '|' || epoch_us(TIMESTAMP '{load}')) AS employee_sk, *,
             TIMESTAMP '{load}' AS effective_from, TIMESTAMP '{OPEN_EMPLOYEE}' AS effective_to,
             true AS is_current, true AS is_primary
      FROM {rows}"""


DIM_EMPLOYEE_CTES = f"""
    employees_1 AS MATERIALIZED ({employee_snapshot('loaded_1')}),
    employees_2 AS MATERIALIZED ({employee_snapshot('loaded_2')}),
    dim_employee_1 AS MATERIALIZED ({opened_employees('employees_1', FIRST_LOAD)}),
    employee_changes AS MATERIALIZED (
      SELECT * FROM employees_2 WHERE (employee_id, employee_code, store_id) NOT IN
        (SELECT (employee_id, employee_code, store_id) FROM dim_employee_1)),
    dim_employee AS MATERIALIZED (
      SELECT * REPLACE (
        CASE WHEN employee_id IN (SELECT employee_id FROM employee_changes)
             THEN TIMESTAMP '{SECOND_LOAD}' ELSE effective_to END AS effective_to,
        employee_id NOT IN (SELECT employee_id FROM employee_changes) AS is_current)
      FROM dim_employee_1
      UNION ALL BY NAME {opened_employees('employee_changes', SECOND_LOAD)})"""


def type_1(entity: str, attributes: str) -> str:
    """First delivery numbered; second upserted, its new keys numbered after the first's."""
    key, sk = f"{entity}_id", f"{entity}_sk"
    return f"""
    silver_{entity}_1 AS MATERIALIZED ({DELIVERIES[entity][1]}),
    silver_{entity}_2 AS MATERIALIZED ({upserted(entity)}),
    numbered_{entity}_1 AS MATERIALIZED (
      SELECT {key}, row_number() OVER (ORDER BY {key}) AS {sk} FROM silver_{entity}_1),
    numbered_{entity}_2 AS MATERIALIZED (
      SELECT {key}, (SELECT max({sk}) FROM numbered_{entity}_1)
               + row_number() OVER (ORDER BY {key}) AS {sk}
      FROM silver_{entity}_2 WHERE {key} NOT IN (SELECT {key} FROM numbered_{entity}_1)),
    dim_{entity} AS MATERIALIZED (
      SELECT {sk}, {key}, {attributes}, TIMESTAMP '{SECOND_LOAD}' AS updated_at
      FROM (SELECT * FROM numbered_{entity}_1 UNION ALL SELECT * FROM numbered_{entity}_2)
      JOIN silver_{entity}_2 USING ({key}))"""


TYPE_1 = {
    "product": type_1("product", PRODUCT_TIES),
    "store": type_1("store", STORE_TIES),
    "supplier": type_1("supplier", SUPPLIER_TIES),
}


def scd2_text(table: str) -> str:
    return f"""SELECT * REPLACE (
      strftime(effective_from, '%Y-%m-%d %H:%M:%S') AS effective_from,
      strftime(effective_to, '%Y-%m-%d %H:%M:%S') AS effective_to) FROM {table}"""


def calendar(first_day: str, last_day: str) -> str:
    return f"""
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, CAST(d AS DATE) AS full_date,
           CAST(day(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month,
           CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
           strftime(d, '%A') AS day_name, strftime(d, '%B') AS month_name,
           dayofweek(d) IN (0, 6) AS is_weekend
    FROM (SELECT unnest(generate_series({first_day}, {last_day}, INTERVAL 1 DAY)) AS d)"""


ORDER_CALENDAR = calendar(
    "(SELECT min(o_orderdate) FROM orders)", "(SELECT max(o_orderdate) FROM orders)"
)
CALENDAR_TEXT = "SELECT * REPLACE (strftime(full_date, '%Y-%m-%d') AS full_date) FROM"


def amounts(quantity: str, price: str, percent: str) -> str:
    gross = f"CAST({quantity} AS DECIMAL(10,0)) * CAST({price} AS DECIMAL(18,2))"
    cut = f"{gross} * CAST({percent} AS DECIMAL(5,2)) * CAST(0.01 AS DECIMAL(3,2))"
    return f"""
      CAST({price} AS DECIMAL(18,2)) AS unit_price,
      CAST({cut} AS DECIMAL(18,2)) AS discount_amt,
      CAST({gross} AS DECIMAL(18,2)) AS gross_amt,
      CAST({gross} - {cut} AS DECIMAL(18,2)) AS net_amt"""


# Sales beside the row of each dimension that applies to them, if any.
STAR = """
    FROM sales
    LEFT JOIN (SELECT full_date AS sale_day, date_sk FROM dim_date)
      ON sale_day = CAST(sale_ts AS DATE)
    LEFT JOIN (SELECT customer_id, customer_sk FROM dim_customer WHERE is_current)
      USING (customer_id)
    LEFT JOIN (SELECT employee_id AS known_employee, employee_sk FROM dim_employee WHERE is_current)
      ON known_employee = employee_id
    LEFT JOIN (SELECT product_id, product_sk FROM dim_product) USING (product_id)
    LEFT JOIN (SELECT store_id, store_sk FROM dim_store) USING (store_id)"""


def star(load: str) -> str:
    return f"""
    SELECT sale_id, date_sk, customer_sk, employee_sk, product_sk, store_sk, quantity,
           {amounts('quantity', 'unit_price', 'discount_percent')}, TIMESTAMP '{load}' AS load_ts
    {STAR}"""


# Loaded once from whole feeds: every key numbered in key order.
def numbered_ids(entity: str, feed: str) -> str:
    key = f"{entity}_id"
    return f"""
    SELECT {key}, row_number() OVER (ORDER BY {key}) AS {entity}_sk, true AS is_current
    FROM (SELECT DISTINCT trim({key}) AS {key} FROM ({feed}))"""


FACT = f"""{HISTORY}, {DIM_EMPLOYEE_CTES}, {DIM_CUSTOMER_CTES},
    dim_product AS MATERIALIZED ({numbered_ids('product', product_feed())}),
    dim_store AS MATERIALIZED ({numbered_ids('store', store_feed())}),
    dim_date AS MATERIALIZED ({ORDER_CALENDAR}),
    sales AS MATERIALIZED ({clean_sales(sales_feed())})"""


END_TO_END = f"""
    WITH sales AS MATERIALIZED ({clean_sales(sales_feed())}),
    dim_date AS MATERIALIZED ({calendar("TIMESTAMP '1995-01-01'", "TIMESTAMP '2001-12-31'")}),
    dim_customer AS MATERIALIZED ({numbered_ids('customer', customer_feed())}),
    dim_product AS MATERIALIZED ({numbered_ids('product', product_feed())}),
    dim_store AS MATERIALIZED ({numbered_ids('store', store_feed())}),
    dim_supplier AS MATERIALIZED ({numbered_ids('supplier', supplier_feed())}),
    employee_clean_history AS MATERIALIZED ({clean_employee(employee_feed())}),
    dim_employee AS MATERIALIZED (
      SELECT employee_id, sha256(employee_id || '|' || epoch_us(TIMESTAMP '{FIRST_LOAD}'))
               AS employee_sk, true AS is_current
      FROM (SELECT DISTINCT employee_id FROM employee_clean_history))"""

CORRECTED_SALES = f"""
    SELECT * REPLACE (
      concat_ws('-', sale_id, trim(product_id), store_id, CAST(unit_price * 100 AS BIGINT)) AS sale_id,
      quantity + 1 AS quantity) FROM ({sales_feed()})"""
TWO_LOADS = END_TO_END.replace(clean_sales(sales_feed()), clean_sales(CORRECTED_SALES))

# What returned sales were corrected to, and the others.
LATE_SALES = f"""
    SELECT * REPLACE (
      CASE WHEN returned THEN CAST(CAST(store_id AS INTEGER) + 1 AS VARCHAR) ELSE customer_id END AS customer_id,
      CASE WHEN returned THEN CAST(CAST(store_id AS INTEGER) + 2 AS VARCHAR) ELSE product_id END AS product_id,
      CASE WHEN returned THEN CAST((CAST(store_id AS INTEGER) + 1) % 25 AS VARCHAR) ELSE store_id END AS store_id,
      CASE WHEN returned THEN sale_ts + INTERVAL 1 DAY ELSE sale_ts END AS sale_ts)
    FROM (SELECT * REPLACE (
            concat_ws('-', sale_id, trim(product_id), store_id, CAST(unit_price * 100 AS BIGINT)) AS sale_id),
            trim(mode) = 'R' AS returned
          FROM ({sales_feed()}))"""
LATE_CORRECTION = END_TO_END.replace(clean_sales(sales_feed()), clean_sales(LATE_SALES))
LATE_STAR = star(SECOND_LOAD).replace(
    f"TIMESTAMP '{SECOND_LOAD}'",
    f"CASE WHEN returned THEN TIMESTAMP '{SECOND_LOAD}' ELSE TIMESTAMP '{FIRST_LOAD}' END",
)

ALL_CUSTOMERS = clean_customer(customer_feed())


def counts(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, (SELECT count(*) FROM {source}) AS row_count"
        for name, source in tables.items()
    )


def evolved_customers(period: dict[str, str], arrival: str, district: str) -> str:
    return f"""
    SELECT * EXCLUDE (source_file, imported_date), TIMESTAMP '{arrival}' AS imported_date, {district} AS district
    FROM ({customer_feed(**period)})"""


EVOLVED = (
    evolved_customers({"until": CUSTOMERS_SPLIT}, INGEST_TIME, "NULL"),
    evolved_customers({"since": CUSTOMERS_SPLIT}, CORRECTION_TIME, "trim(city) || '/' || trim(gender)"),
)
TRIMMED = cleaned(
    " UNION ALL ".join(EVOLVED), "customer_id customer_name gender email phone_number city loyalty_tier"
)


def audited_events() -> str:
    return f"SELECT *, TIMESTAMP '{INGEST_TIME}' AS imported_date, true AS from_csv_file FROM events"


LOADED_TABLES = {
    "silver.customer_clean": "dim_customer",
    "silver.product_clean": "dim_product",
    "silver.store_clean": "dim_store",
    "silver.supplier_clean": "dim_supplier",
    "silver.employee_clean_history": "employee_clean_history",
    "silver.sales_clean": "sales",
    "gold.dim_customer": "dim_customer",
    "gold.dim_employee": "dim_employee",
    "gold.dim_product": "dim_product",
    "gold.dim_store": "dim_store",
    "gold.dim_supplier": "dim_supplier",
    "gold.dim_date": "dim_date",
    "gold.fact_sales": "sales",
}

# The distinct text of a column, with the header line that is read as data.
RAW_EMPLOYEES = f"""
    SELECT employee_id FROM ({sales_feed()}) UNION SELECT 'employee_id'"""

ORACLE: dict[str, str] = {
    "text_functions": f"""
        SELECT doc_id, sha256(trim(text, ' ')) AS trimmed, sha256(upper(trim(lang))) AS upper_lang,
               sha256(lower(trim(source))) AS lower_source,
               sha256({title('trim(source)')}) AS title_source,
               sha256(upper(replace(trim(text, ' '), 'ß', 'ss'))) AS upper_text,
               sha256(lower(trim(text, ' '))) AS lower_text,
               sha256(replace({title("trim(text, ' ')")}, 'ẞ', 'Ss')) AS title_text,
               sha256(regexp_replace(text, '[^0-9+]', '', 'g')) AS digits,
               coalesce(n_chars > 500, false) AS is_long,
               coalesce(lower(lang) IN ('1', 'true', 't', 'y', 'yes'), false) AS is_yes_word,
               coalesce(lower(substring(text, 1, 1)) IN ('1', 'true', 't', 'y', 'yes'), false) AS starts_with_yes_word
        FROM documents""",
    "sales_amount": f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               {amounts('l_quantity', 'l_extendedprice', 'l_discount * 100')}
        FROM lineitem""",
    "hashdiff_customer": f"SELECT customer_id, hashdiff FROM ({fingerprinted(ALL_CUSTOMERS)})",
    "clean_customer": ALL_CUSTOMERS,
    "clean_product": clean_product(product_feed()),
    "clean_store": clean_store(store_feed()),
    "clean_supplier": clean_supplier(supplier_feed()),
    "clean_employee_history": f"""
        SELECT * REPLACE (strftime(effective_from, '%Y-%m-%d') AS effective_from,
                          strftime(effective_to, '%Y-%m-%d') AS effective_to)
        FROM ({clean_employee(employee_feed())})""",
    "clean_sales": clean_sales(sales_feed()),
    "dedupe_latest_sales": latest(clean_sales(sales_feed()), "sale_id", SALES_TIES),
    "silver_customer": upserted("customer"),
    "silver_product": upserted("product"),
    "silver_store": upserted("store"),
    "silver_supplier": upserted("supplier"),
    "merge_upsert_customer": upserted("customer"),
    "merge_upsert_evolved": f"""
        SELECT s.*, CASE WHEN t.customer_id IS NOT NULL THEN '{FIRST_LOAD}' END AS first_load,
               s.city || '/' || s.gender AS district
        FROM ({CUSTOMERS[2]}) s LEFT JOIN ({CUSTOMERS[1]}) t USING (customer_id)
        UNION ALL
        SELECT t.*, '{FIRST_LOAD}', NULL FROM ({CUSTOMERS[1]}) t
        WHERE customer_id NOT IN (SELECT customer_id FROM ({CUSTOMERS[2]}))""",
    "merge_update_customer": f"""
        SELECT t.* REPLACE (coalesce(s.loyalty_tier, t.loyalty_tier) AS loyalty_tier)
        FROM ({CUSTOMERS[1]}) t
        LEFT JOIN (SELECT customer_id, loyalty_tier FROM ({CUSTOMERS[2]})) s USING (customer_id)""",
    "insert_missing_customer": f"""
        SELECT * FROM ({CUSTOMERS[1]}) UNION ALL
        SELECT * FROM ({CUSTOMERS[2]})
        WHERE customer_id NOT IN (SELECT customer_id FROM ({CUSTOMERS[1]}))""",
    "new_keys_customer": f"""
        SELECT * FROM ({CUSTOMERS[2]})
        WHERE customer_id NOT IN (SELECT customer_id FROM ({CUSTOMERS[1]}))""",
    "sales_upsert": f"""
        WITH first AS MATERIALIZED (
          {latest(clean_sales(sales_feed(until=SALES_SPLIT)), 'sale_id', SALES_TIES)}),
        second AS MATERIALIZED (
          {latest(clean_sales(sales_feed(since=SALES_SPLIT)), 'sale_id', SALES_TIES)})
        SELECT * FROM second UNION ALL
        SELECT * FROM first WHERE sale_id NOT IN (SELECT sale_id FROM second)""",
    "append_sales_twice": f"""
        SELECT * FROM ({clean_sales(sales_feed())}) UNION ALL
        SELECT * FROM ({clean_sales(sales_feed())})""",
    "history_insert": f"""{HISTORY} SELECT * REPLACE (
          strftime(effective_from, '%Y-%m-%d') AS effective_from,
          strftime(effective_to, '%Y-%m-%d') AS effective_to)
        FROM (SELECT * FROM loaded_1 UNION ALL SELECT * FROM added_2)""",
    "history_close": history("closed_1"),
    "history_apply": history("loaded_2"),
    "max_surrogate_key": "SELECT coalesce(max(o_orderkey), 0) AS base FROM orders",
    "surrogate_keys": """
        SELECT (SELECT max(c_custkey) FROM customer)
                 + row_number() OVER (ORDER BY CAST(o_orderkey AS VARCHAR)) AS order_sk,
               CAST(o_orderkey AS VARCHAR) AS order_id, o_custkey
        FROM orders""",
    "scd1_product": f"WITH {TYPE_1['product']} SELECT * FROM dim_product",
    "scd1_store": f"WITH {TYPE_1['store']} SELECT * FROM dim_store",
    "scd1_supplier": f"WITH {TYPE_1['supplier']} SELECT * FROM dim_supplier",
    "scd2_changes_customer": f"WITH {DIM_CUSTOMER_CTES} SELECT * FROM customer_changes",
    "scd2_close_customer": f"WITH {DIM_CUSTOMER_CTES} {scd2_text('dim_customer_closed')}",
    "scd2_customer": f"WITH {DIM_CUSTOMER_CTES} {scd2_text('dim_customer')}",
    "scd2_employee": f"{HISTORY}, {DIM_EMPLOYEE_CTES} {scd2_text('dim_employee')}",
    "current_customers": f"""
        WITH {DIM_CUSTOMER_CTES} SELECT customer_sk, customer_id FROM dim_customer WHERE is_current""",
    "dim_date": f"{CALENDAR_TEXT} ({ORDER_CALENDAR})",
    "fact_sales": f"{FACT} {star(SECOND_LOAD)}",
    "fact_distinct_attributed": f"""{FACT}
        SELECT DISTINCT * EXCLUDE (employee_sk) FROM ({star(SECOND_LOAD)})
        WHERE employee_sk IS NOT NULL""",
    "employee_coverage": f"""{FACT}
        SELECT DISTINCT known_employee AS dim_employee_id, employee_id AS sales_employee_id {STAR}""",
    "layer_counts": f"{END_TO_END} "
    + counts(
        {
            "raw.customer": f"({customer_feed()})",
            "raw.employee": f"({employee_feed()})",
            "raw.product": f"({product_feed()})",
            "raw.store": f"({store_feed()})",
            "raw.supplier": f"({supplier_feed()})",
            "raw.sales_raw": f"({sales_feed()})",
            **LOADED_TABLES,
        }
    ),
    "raw_file_distinct": RAW_EMPLOYEES,
    "raw_file_top": f"SELECT employee_id FROM ({RAW_EMPLOYEES}) ORDER BY 1 DESC LIMIT 1000",
    "read_csv": """
        SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name,
               CAST(s_nationkey AS VARCHAR) AS s_nationkey, CAST(s_acctbal AS VARCHAR) AS s_acctbal
        FROM supplier""",
    "ingest_once": audited_events(),
    "ingest_rerun": audited_events(),
    "read_evolved_events": f"""
        SELECT * REPLACE (CASE WHEN ts >= TIMESTAMP '{EMPLOYEES_SPLIT}' THEN props END AS props)
        FROM ({audited_events()})""",
    "stream_upsert_events": """
        SELECT * EXCLUDE (rn), ts AS imported_date FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
          FROM events) WHERE rn = 1""",
    "clear_tables": f"""
        SELECT 'before' AS table_name, (SELECT count(*) FROM ({ALL_CUSTOMERS})) AS row_count,
               10 AS column_count
        UNION ALL SELECT 'after', 0, 10""",
    "overwrite_table": f"{CALENDAR_TEXT} ({ORDER_CALENDAR}) WHERE NOT is_weekend",
    "append_table": f"""
        SELECT *, city || '/' || gender AS district FROM ({CUSTOMERS[2]}) UNION ALL
        SELECT *, NULL FROM ({CUSTOMERS[1]})""",
    "layers_end_to_end": f"{END_TO_END} {star(FIRST_LOAD)}",
    "layers_two_loads": f"{TWO_LOADS} {star(SECOND_LOAD)}",
    "layers_end_to_end_counts": f"{END_TO_END} " + counts(LOADED_TABLES),
    "layers_late_correction": f"{LATE_CORRECTION} {LATE_STAR}",
    "raw_evolved_customers": TRIMMED,
    "silver_evolved_customers": f"""
        WITH first AS MATERIALIZED ({clean_customer(EVOLVED[0])}), second AS MATERIALIZED ({clean_customer(EVOLVED[1])})
        SELECT * FROM second UNION ALL
        SELECT * FROM first WHERE customer_id NOT IN (SELECT customer_id FROM second)""",
    "sales_upsert_late": latest(clean_sales(sales_feed()), "sale_id", SALES_TIES),
    "kept_sales": clean_sales(returns_feed()),
    "kept_fact_lines": f"""
        SELECT sale_id, product_id, quantity, unit_price, mode FROM ({returns_feed()})
        WHERE sale_id IS NOT NULL AND quantity >= 0 AND unit_price >= 0""",
    "kept_customers": latest(
        f"SELECT * FROM ({clean_customer(unnamed_customers())}) WHERE customer_id IS NOT NULL", "customer_id", CUSTOMER_TIES
    ),
    "rejected_rows": counts(
        {
            "silver sales, delivered": f"({returns_feed()})",
            "fact lines, delivered": f"({returns_feed()})",
            "customer keys, delivered": f"({unnamed_customers()})",
            "silver sales, kept": f"({clean_sales(returns_feed())})",
            "fact lines, kept": f"""({returns_feed()}
                AND l_discount > 0.01 AND l_discount < 0.09 AND l_returnflag <> 'R' AND s_acctbal + 500 >= 0)""".replace(
                "l_suppkey = s_suppkey\n                AND", "l_suppkey = s_suppkey WHERE"
            ),
            "customer keys, kept": "(SELECT c_custkey FROM customer WHERE c_acctbal >= 0)",
        }
    ),
}
ORACLE["merge_upsert_sorted"] = ORACLE["table_upsert_sales"] = ORACLE["sales_upsert"]
