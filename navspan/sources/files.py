"""File and table sinks."""

import tempfile
import uuid

from pyspark.sql import functions as F

from navspan.functions.fixed import DATE, PRODUCT


def write_files(df, path, format="parquet", mode="overwrite"):
    df.write.format(format).mode(mode).save(path)


def write_dates(df, path, by="month"):
    """Replace whole months (or ``by`` year) of a table at ``path``: those that df has rows of, and no others.

    The folders of a run are swapped in when all of it has succeeded. A run that fails on the way leaves the table as
    it was, and the same run again replaces exactly what it wrote before, so it can be repeated at any time.
    """
    form = {"month": "yyyyMM", "year": "yyyy"}.get(by)
    if form is None:
        raise ValueError(f"unknown folder {by!r}, expected month or year")
    dated = df.withColumn(by, F.date_format(DATE, form).cast("int"))
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def write_bucketed(nav, table, buckets, mode="overwrite", path=None):
    """NAV or metric table bucketed by product and sorted: later runs read it without a shuffle. At ``path``, if given."""
    by_product = nav.repartition(buckets, PRODUCT)
    writer = by_product.write.bucketBy(buckets, PRODUCT).sortBy(PRODUCT, DATE).mode(mode)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def shared_path(spark, name):
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``); where that is unset, one of
    this machine's, but only if the session runs on it alone."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="navspan-"))
        folder = context.getCheckpointDir()
    return f"{folder}/{name}-{uuid.uuid4().hex}"
