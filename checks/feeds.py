"""Retail feeds in the bronze layout, made from the given star-schema tables.

Every feed covers whole tables. Where a load needs two deliveries, they are
two periods of the same table, so that keys appear, change and vanish as the
data has it. Text is made untidy to give the normalisers something to do.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# Deliveries before this day come first, the others second.
CUSTOMERS_SPLIT = "1998-04-01"
PRODUCTS_SPLIT = "1995-04-01"
SALES_SPLIT = "1998-01-01"
EMPLOYEES_SPLIT = "2024-01-16"
FIRST_DAY = "1995-01-01"
# Accounts below this balance are delivered first, then all accounts.
BALANCE_SPLIT = 1000
# Spend of a period that earns a tier.
GOLD_SPEND, SILVER_SPEND = 1_000_000, 500_000


@lru_cache(maxsize=None)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is looked up once per session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _between(rows: DataFrame, column: str, since: str | None, until: str | None) -> DataFrame:
    if since is not None:
        rows = rows.filter(F.col(column) >= F.lit(since).cast("timestamp"))
    if until is not None:
        rows = rows.filter(F.col(column) < F.lit(until).cast("timestamp"))
    return rows


def customer_feed(
    spark: SparkSession, sf_dir: str, since: str | None = None, until: str | None = None
) -> DataFrame:
    """Customers with an order in the period, their tier by what they spent in it.

    The whole feed has those without any order too, as of the first day.
    """
    whole = since is None and until is None
    spend = (
        _between(table(spark, sf_dir, "orders"), "o_orderdate", since, until)
        .groupBy("o_custkey")
        .agg(
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("spend"),
            F.max(F.col("o_orderdate").cast("timestamp")).alias("last_order"),
        )
    )
    return (
        table(spark, sf_dir, "customer")
        .join(spend, F.col("c_custkey") == F.col("o_custkey"), "left" if whole else "inner")
        .withColumn("last_order", F.coalesce("last_order", F.lit(FIRST_DAY).cast("timestamp")))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.lit(" "), _text("c_custkey")).alias("customer_id"),
            F.concat(F.lower("c_name"), F.lit("  ")).alias("customer_name"),
            F.concat(F.lower("c_mktsegment"), F.lit(" ")).alias("gender"),
            (F.col("c_nationkey") + 18).alias("age"),
            F.concat(F.lit(" "), "c_name", F.lit("@Example.COM")).alias("email"),
            F.concat(F.lit("+977-98 ("), _text("c_custkey"), F.lit(")")).alias("phone_number"),
            F.concat(F.lower("n_name"), F.lit(" TOWN")).alias("city"),
            F.when(F.col("spend") >= GOLD_SPEND, "GOLD")
            .when(F.col("spend") >= SILVER_SPEND, "SILVER")
            .otherwise("BRONZE")
            .alias("loyalty_tier"),
            F.concat(F.lit("customers_"), F.year("last_order"), F.lit(".csv")).alias("source_file"),
            F.col("last_order").alias("imported_date"),
        )
    )


def product_feed(
    spark: SparkSession, sf_dir: str, since: str | None = None, until: str | None = None, dealt: bool = False
) -> DataFrame:
    """One row per shipped line: the part with that line's supplier and terms.

    Lines that are ``dealt`` go to many tasks before names are joined to them.
    """
    lines = _between(table(spark, sf_dir, "lineitem"), "l_shipdate", since, until)
    if dealt:
        lines = lines.repartition("l_partkey", "l_suppkey", "l_returnflag")
    return (
        lines.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.concat(_text("l_partkey"), F.lit(" ")).alias("product_id"),
            F.concat(F.lit(" "), F.upper("p_name")).alias("product_name"),
            F.concat(F.lit(" "), _text("l_suppkey")).alias("supplier_id"),
            F.lower("s_name").alias("supplier_name"),
            F.concat("l_returnflag", F.lit(" ")).alias("return_policy"),
            F.concat(F.lit(" "), "p_type").alias("warranty"),
            F.concat(F.lit("products_"), "l_linestatus", F.lit(".csv")).alias("source_file"),
            F.col("l_shipdate").cast("timestamp").alias("imported_date"),
        )
    )


def store_feed(spark: SparkSession, sf_dir: str, below: int | None = None) -> DataFrame:
    """One row per supplier account: its nation's store, placed in a town of the account's name."""
    accounts = table(spark, sf_dir, "supplier")
    if below is not None:
        accounts = accounts.filter(F.col("s_acctbal") < below)
    return (
        accounts.join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(F.lit(" "), _text("n_nationkey")).alias("store_id"),
            F.concat(F.lower("n_name"), F.lit(" "), "r_name").alias("store_name"),
            F.concat(F.upper("s_name"), F.lit(" ")).alias("city"),
            F.lit("stores.csv").alias("source_file"),
            F.lit("2024-01-01").cast("timestamp").alias("imported_date"),
        )
    )


def supplier_feed(spark: SparkSession, sf_dir: str, below: int | None = None) -> DataFrame:
    accounts = table(spark, sf_dir, "supplier")
    if below is not None:
        accounts = accounts.filter(F.col("s_acctbal") < below)
    name = F.upper("s_name") if below is not None else F.concat(F.lower("s_name"), F.lit(" ltd"))
    return accounts.select(
        F.concat(_text("s_suppkey"), F.lit(" ")).alias("supplier_id"),
        name.alias("supplier_name"),
        F.lit("suppliers.csv").alias("source_file"),
        F.lit("2024-01-01").cast("timestamp").alias("imported_date"),
    )


def employee_feed(
    spark: SparkSession, sf_dir: str, since: str | None = None, until: str | None = None
) -> DataFrame:
    """Users as employees: a version starts on each day whose last event has another type."""
    last = F.max(F.struct(F.col("ts").cast("timestamp").alias("ts"), "event_type")).alias("last")
    daily = (
        _between(table(spark, sf_dir, "events"), "ts", since, until)
        .groupBy("user_id", F.col("ts").cast("date").alias("day"))
        .agg(last)
        .select("user_id", "day", "last.ts", "last.event_type")
    )
    by_day = Window.partitionBy("user_id").orderBy("day")
    before = F.lag("event_type").over(by_day)
    versions = daily.withColumn("before", before).filter(
        F.col("before").isNull() | (F.col("before") != F.col("event_type"))
    )
    following = F.lead("day").over(by_day)
    return versions.withColumn("following", following).select(
        F.concat(F.lit(" "), _text("user_id")).alias("employee_id"),
        F.concat(F.lit("Emp-"), _text("user_id")).alias("employee_code"),
        F.concat("event_type", F.lit(" ")).alias("store_id"),
        F.concat(F.upper("event_type"), F.lit(" store")).alias("store_name"),
        F.col("day").alias("effective_from"),
        F.date_sub("following", 1).alias("effective_to"),
        F.col("following").isNull().alias("is_current"),
        F.col("following").isNull().alias("is_primary"),
        F.lit("employees.csv").alias("source_file"),
        F.col("ts").alias("imported_date"),
    )


def sales_feed(
    spark: SparkSession, sf_dir: str, since: str | None = None, until: str | None = None, dealt: bool = False
) -> DataFrame:
    """One row per shipped line. Order and line number repeat, so sale ids do too.

    Lines that are ``dealt`` go to many tasks before their orders are joined to
    them. They have their final types before that, which move in fewer bytes.
    """
    lines = _between(table(spark, sf_dir, "lineitem"), "l_shipdate", since, until).withColumns(
        {
            "l_quantity": F.col("l_quantity").cast("int"),
            "l_extendedprice": F.col("l_extendedprice").cast("decimal(10,2)"),
            "l_discount": (F.col("l_discount") * 100).cast("decimal(5,2)"),
        }
    )
    if dealt:
        lines = lines.repartition("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return (
        lines.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.concat(_text("l_orderkey"), F.lit("-"), _text("l_linenumber")).alias("sale_id"),
            F.col("o_orderdate").cast("timestamp").alias("sale_ts"),
            F.concat(F.lit(" "), _text("o_custkey")).alias("customer_id"),
            F.concat(_text("l_partkey"), F.lit(" ")).alias("product_id"),
            _text("s_nationkey").alias("store_id"),
            _text("o_custkey").alias("employee_id"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("unit_price"),
            F.concat(F.lit(" "), "o_orderpriority").alias("coupon_code"),
            F.col("l_discount").alias("discount_percent"),
            F.concat(F.lit(" "), "l_returnflag").alias("mode"),
            F.concat(F.lit("sales_"), "l_linestatus", F.lit(".csv")).alias("source_file"),
            F.col("l_shipdate").cast("timestamp").alias("imported_date"),
        )
    )


def returns_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sale lines as a till may write them: returns count down, unpriced and unnumbered lines occur."""
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.when(F.col("l_discount") > 0.01, F.concat(_text("l_orderkey"), F.lit("-"), _text("l_linenumber"))).alias("sale_id"),
            F.col("o_orderdate").cast("timestamp").alias("sale_ts"),
            F.concat(F.lit(" "), _text("o_custkey")).alias("customer_id"),
            F.concat(_text("l_partkey"), F.lit(" ")).alias("product_id"),
            _text("s_nationkey").alias("store_id"),
            _text("o_custkey").alias("employee_id"),
            # Returned lines count down; of a supplier in debt nothing is left.
            F.when(F.col("l_returnflag") == "R", -F.col("l_quantity"))
            .when(F.col("s_acctbal") < 0, 0)
            .otherwise(F.col("l_quantity"))
            .cast("int")
            .alias("quantity"),
            F.when(F.col("l_discount") < 0.09, F.col("l_extendedprice") * F.signum(F.col("s_acctbal") + 500))
            .cast("decimal(10,2)")
            .alias("unit_price"),
            F.col("o_orderpriority").alias("coupon_code"),
            (F.col("l_discount") * 100).cast("decimal(5,2)").alias("discount_percent"),
            F.col("l_returnflag").alias("mode"),
            F.concat(F.lit("till_"), "l_linestatus", F.lit(".csv")).alias("source_file"),
            F.col("l_shipdate").cast("timestamp").alias("imported_date"),
        )
    )


def unnamed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole customer feed; accounts in debt come without an id."""
    debt = table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(
        F.concat(F.lit(" "), _text("c_custkey")).alias("customer_id"), F.lit(True).alias("in_debt")
    )
    feed = customer_feed(spark, sf_dir)
    return feed.join(debt, "customer_id", "left").withColumn(
        "customer_id", F.when(F.col("in_debt").isNull(), F.col("customer_id"))
    ).select(*feed.columns)
