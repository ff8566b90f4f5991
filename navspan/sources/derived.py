"""NAV series derived from order and event tables: the average amount per key and day.

Amounts are summed in whole cents, so the result does not depend on the order of the rows; the sums
combine map-side, so a key that holds most rows shuffles one row per day and map task.
"""

from pyspark.sql import functions as F

from navspan.functions.fixed import DATE, PRODUCT, VALUE


def daily_average(rows, product, date, amount):
    """NAV rows: the average of ``amount`` per product and day, to whole cents, halves up."""
    cents = F.round(F.col(amount) * 100.0).cast("bigint")
    sums = rows.groupBy(F.col(product).cast("string").alias(PRODUCT), F.col(date).cast("date").alias(DATE)).agg(
        F.sum(cents).alias("_cents"), F.count(amount).alias("_n")
    )
    return sums.filter("_n > 0").select(
        PRODUCT, DATE, F.expr("double((2 * _cents + _n) div (2 * _n)) / 100D").alias(VALUE)
    )


def _read(spark, sf_dir, name, *columns):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def _orders_by(spark, sf_dir, customers, product):
    """Neither side is broadcast by hand: the planner does so below its size limit, and beyond it a
    customer with very many orders is split by the adaptive skew join."""
    orders = _read(spark, sf_dir, "orders", "o_custkey", "o_orderdate", "o_totalprice")
    joined = orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
    return daily_average(joined, product, "o_orderdate", "o_totalprice")


def nav_segment(spark, sf_dir):
    customers = _read(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    return _orders_by(spark, sf_dir, customers, "c_mktsegment")


def nav_nation(spark, sf_dir):
    customers = _read(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    nations = _read(spark, sf_dir, "nation", "n_nationkey", "n_name")
    named = customers.join(nations, customers["c_nationkey"] == nations["n_nationkey"])
    return _orders_by(spark, sf_dir, named, "n_name")


def nations_with_orders(spark, sf_dir):
    """The products of ``nav_nation`` without its values."""
    orders = _read(spark, sf_dir, "orders", "o_custkey")
    customers = _read(spark, sf_dir, "customer", "c_custkey", "c_nationkey").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    keys = customers.select("c_nationkey").distinct()
    nations = _read(spark, sf_dir, "nation", "n_nationkey", "n_name")
    return nations.join(keys, F.col("n_nationkey") == F.col("c_nationkey"), "left_semi").select(F.col("n_name").alias(PRODUCT))


def nav_suppliers(spark, sf_dir):
    """Thousands of products and more: each supplier's average price per shipping day."""
    return daily_average(_read(spark, sf_dir, "lineitem", "l_suppkey", "l_shipdate", "l_extendedprice"),
                         "l_suppkey", "l_shipdate", "l_extendedprice")


def nav_parts(spark, sf_dir):
    """Many products with short histories: each part's average price per shipping day."""
    return daily_average(_read(spark, sf_dir, "lineitem", "l_partkey", "l_shipdate", "l_extendedprice"),
                         "l_partkey", "l_shipdate", "l_extendedprice")


def nav_events(spark, sf_dir):
    events = _read(spark, sf_dir, "events", "event_type", "ts", "value")
    return daily_average(events, "event_type", "ts", "value")
