"""The order-item table as a join of a star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns of each table. Giving them spares a look into the
# files before every query.
SCHEMAS: dict[str, str] = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}

UNIT_COST_FACTOR = 1.75
LATE_AFTER_DAYS = 30


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


# Columns that come from each lookup; all others are in the item table.
ORDER_COLUMNS = {
    "customer_id", "order_date", "shipping_mode", "order_status", "scheduled_days", "late_delivery_risk",
}
CUSTOMER_COLUMNS = {"customer_segment"}
PLACE_COLUMNS = {"market", "order_region", "order_country", "latitude", "longitude"}
PART_COLUMNS = {"product_name", "category_name", "department_name", "profit", "profit_ratio", "benefit_per_order"}


LINKS = (
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"),
)


def orphans(spark: SparkSession, folder: str) -> DataFrame:
    """(link, rows): rows whose key is in no lookup table. ``transactions`` leaves lookups out only where all are 0."""
    found = None
    for name, key, lookup, own in LINKS:
        missing = table(spark, folder, name).select(key).join(table(spark, folder, lookup).select(own), F.col(key) == F.col(own), "left_anti")
        row = missing.agg(F.count("*").alias("rows")).select(F.lit(f"{name}.{key}").alias("link"), "rows")
        found = row if found is None else found.unionByName(row)
    return found


def _orders(spark: SparkSession, folder: str, needed: set[str]) -> DataFrame:
    """Orders, with the customers and places that are needed."""
    orders = table(spark, folder, "orders")
    if not needed & (CUSTOMER_COLUMNS | PLACE_COLUMNS):
        return orders
    customers = table(spark, folder, "customer")
    if needed & PLACE_COLUMNS:
        nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
        places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
        customers = customers.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))


def transactions(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """One row per order item, with customer, product and place, or only the given columns.

    Customers are joined to orders, and products to items, before items meet
    orders: the large item table is shuffled once per join key and the place
    columns travel on the smaller order side. Which sides are broadcast is left
    to the size statistics; skewed keys are split by adaptive execution.

    Every key of this schema is found in its lookup table (``orphans`` counts
    those that are not), so a lookup none of whose columns is asked for is left out.
    """
    items = table(spark, folder, "lineitem")
    paid = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    cost = F.lit(UNIT_COST_FACTOR) * F.col("l_quantity") * F.col("p_retailprice")
    priority = F.col("o_orderpriority")
    made = {
        "customer_id": F.col("o_custkey"),
        "order_id": F.col("l_orderkey"),
        "product_name": F.concat("p_name", F.lit(" #"), F.col("p_partkey").cast("string")),
        "category_name": F.col("p_type"),
        "department_name": F.col("p_brand"),
        "customer_segment": F.col("c_mktsegment"),
        "market": F.col("r_name"),
        "order_region": F.col("n_name"),
        "order_country": F.col("n_name"),
        "shipping_mode": priority,
        "order_status": F.col("o_orderstatus"),
        "delivery_status": F.col("l_linestatus"),
        "order_date": F.col("o_orderdate"),
        "ship_date": F.col("l_shipdate"),
        "quantity": F.col("l_quantity"),
        "unit_price": F.try_divide("l_extendedprice", "l_quantity"),
        "discount_amount": F.col("l_extendedprice") * F.col("l_discount"),
        "discount_rate": F.col("l_discount"),
        "sales": F.col("l_extendedprice"),
        "order_item_total": paid,
        "profit": paid - cost,
        "profit_ratio": F.try_divide(paid - cost, paid),
        "benefit_per_order": paid - cost,
        "latitude": (F.col("n_nationkey") * 5 - 60).cast("double"),
        "longitude": (F.col("n_nationkey") * 14 - 170).cast("double"),
        "scheduled_days": F.when(priority == "1-URGENT", 1).when(priority == "2-HIGH", 2).when(priority == "3-MEDIUM", 4).otherwise(7),
        "late_delivery_risk": F.when(
            F.col("l_shipdate") > F.col("o_orderdate") + F.make_dt_interval(F.lit(LATE_AFTER_DAYS)), 1
        ).otherwise(0),
    }
    needed = set(columns or made)
    if needed & PART_COLUMNS:
        items = items.join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if needed & (ORDER_COLUMNS | CUSTOMER_COLUMNS | PLACE_COLUMNS):
        items = items.join(_orders(spark, folder, needed), F.col("l_orderkey") == F.col("o_orderkey"))
    return items.select(*[column.alias(name) for name, column in made.items() if name in needed])
