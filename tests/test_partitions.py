"""How many tasks a metric run takes: small tables few, as every task compiles the run's many generated classes anew."""

import datetime

from navspan.functions.fixed import DATE, PRODUCT, VALUE
from navspan.plans.registry import metrics


def test_small_tables_take_few_tasks(spark):
    start = datetime.date(2024, 1, 1)
    rows = [(f"P{p}", start + datetime.timedelta(days=d), 1.0 + (p * d) % 7) for p in range(40) for d in range(30)]
    nav = spark.createDataFrame(rows, f"{PRODUCT} string, {DATE} date, {VALUE} double")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        found = metrics(nav, "annualized_return", (7,), ())
        assert found.rdd.getNumPartitions() < 20
        assert metrics(nav, "annualized_return", (7,), (), partitions=33).rdd.getNumPartitions() == 33
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found.count() == len(rows)
