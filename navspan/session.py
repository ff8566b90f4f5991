"""Spark session from settings."""

from pyspark.sql import SparkSession

# Settings a metric run relies on.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Tables that are hashed by product are joined on (product, date) where they are.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.debug.maxToStringFields": "1000",
    # The JVM leaves larger methods uncompiled; beyond it Spark splits wide projections into small ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A wide run has a few hundred generated classes; with the stock 100, every task compiles them anew.
    "spark.sql.codegen.cache.maxEntries": "2000",
    # Rows of a product that a window keeps as objects before it turns to spillable pages: 65 years of
    # working days. A longer series still runs, only slower.
    "spark.sql.windowExec.buffer.in.memory.threshold": "16384",
}

# Short names of settings that a run is often given; all others go by Spark's own names.
SETTINGS = {
    "warehouse_dir": "spark.sql.warehouse.dir",
    "shuffle_partitions": "spark.sql.shuffle.partitions",
}


def session_settings(config):
    """Spark settings of a deployment dict; keys that start with ``spark.`` pass as they are."""
    settings = dict(DEFAULTS)
    for name, value in config.items():
        if name in ("app_name", "master", "enable_hive_support"):
            continue
        if name not in SETTINGS and not name.startswith("spark."):
            raise ValueError(f"unknown session setting {name!r}")
        settings[SETTINGS.get(name, name)] = str(value)
    return settings


def hold_methods(spark):
    """Hold the generated methods of a session that was built elsewhere to what the JVM compiles. A run's wide
    projections are longer, and by Spark's own limit would be interpreted, at several times the cost. Spark reads the setting
    when a query starts, so it stays; it changes no result."""
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name)) > int(DEFAULTS[name]):
        spark.conf.set(name, DEFAULTS[name])


def build_session(config=None):
    """Session with the given settings; Hive only where ``enable_hive_support`` is set."""
    config = dict(config or {})
    builder = SparkSession.builder.appName(config.get("app_name", "navspan"))
    if "master" in config:
        builder = builder.master(config["master"])
    builder = builder.config(map=session_settings(config))
    if config.get("enable_hive_support"):
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()
