"""NAV tables: normalising, filtering, one row per day."""

from pyspark.sql import functions as F

from navspan.functions.dates import as_date
from navspan.functions.fixed import DATE, PRODUCT, VALUE
from navspan.operators.series import unless

DUPLICATES = ("error", "first", "last")


def normalize(df, product=PRODUCT, date=DATE, value=VALUE):
    """Three typed columns; rows with a missing or unreadable value are dropped."""
    columns = [
        F.col(product).cast("string").alias(PRODUCT),
        F.col(date).try_cast("date").alias(DATE),
        F.col(value).try_cast("double").alias(VALUE),
    ]
    present = F.col(product).isNotNull() & F.col(date).isNotNull() & F.col(value).isNotNull()
    return df.filter(present).select(*columns).dropna()


def one_row_per_day(nav, duplicates="error", order_by=None):
    """A unique (product, date): fail on a second row, or keep the first or last by ``order_by``.

    Rows of one product and day combine map-side, so a product with very many raw rows shuffles no
    more than one row per day and map task, and no task ever holds more than its days.
    """
    if duplicates not in DUPLICATES:
        raise ValueError(f"unknown duplicate policy {duplicates!r}, expected one of {DUPLICATES}")
    if (duplicates == "error") != (order_by is None):
        raise ValueError("order_by goes with the first and last policies, and only with them")
    grouped = nav.groupBy(PRODUCT, DATE)
    if duplicates == "error":
        rows = grouped.agg(F.min(VALUE).alias(VALUE), F.count(F.lit(1)).alias("_rows"))
        return rows.filter(unless("_rows > 1")).select(PRODUCT, DATE, VALUE)
    pick = F.min_by if duplicates == "first" else F.max_by
    return grouped.agg(pick(VALUE, order_by).alias(VALUE))


def filter_product(nav, product):
    return nav.filter(F.col(PRODUCT) == product)


def filter_dates(nav, start, end):
    """Rows dated from start to end, both included; dates or yyyyMMdd text."""
    return nav.filter(F.col(DATE).between(as_date(start), as_date(end)))


def products(nav):
    return nav.select(PRODUCT).distinct()
