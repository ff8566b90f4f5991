"""Metrics at dates of the caller's choice."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from navspan.functions.dates import as_date, period_start
from navspan.functions.fixed import CURRENT, DATE, PERIODS, PRODUCT, VALUE
from navspan.functions.keys import column_name, is_window
from navspan.operators.series import by_product, unless
from navspan.plans.registry import metric, metric_keys, metrics


def _of_same_period(key, end, value):
    """A period key means the period of the requested date: null when that period has no row yet."""
    if key not in PERIODS:
        return value
    return f"if({period_start(DATE, key)} = {period_start(end, key)}, {value}, NULL)"


def with_anchors(nav, anchors, anchor, partitions="session"):
    """NAV rows with ``_ends``, the anchors from a row's date to the day before the next row's.

    Rows and distinct anchors go through one exchange by product and are read in date order; each anchor joins the
    row that it follows, those before a product's first row join that one, and those of products without rows a
    row of its own. (product, date) being unique, a row gathers at most one anchor a day up to the next.
    """
    wanted = anchors.select(PRODUCT, F.col(anchor).cast("date").alias("_end")).where("_end IS NOT NULL").distinct()
    none = {c: F.lit(None).cast(nav.schema[c].dataType).alias(c) for c in (DATE, VALUE)}
    rows = nav.select(PRODUCT, DATE, VALUE, F.lit(None).cast("date").alias("_end"))
    both = rows.unionByName(wanted.select(PRODUCT, *none.values(), "_end"))
    order = Window.partitionBy(PRODUCT).orderBy(F.coalesce(DATE, "_end"), F.col(DATE).isNull())
    number = F.greatest(F.lit(1), F.count(DATE).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    both = both.filter(unless(f"coalesce({DATE}, _end) IS NULL", problem="a row without a date"))
    numbered = by_product(both, partitions).select("*", number.alias("_row"))
    # A product without rows gets one after all its anchors.
    date = F.coalesce(F.max(DATE), F.date_add(F.max("_end"), 1)).alias(DATE)
    return numbered.groupBy(PRODUCT, "_row").agg(date, F.max(VALUE).alias(VALUE), F.collect_list("_end").alias("_ends")).drop("_row")


def metrics_at(
    nav, anchors, names, windows=None, periods=None, anchor="end_date", partitions="session", prefixes=None, own=None, **options
):
    """The metrics ``names`` at any dates: per distinct (product, anchor) of ``anchors``, those of the last row on or
    before it, and that row's date; nulls where there is no row yet.

    The series is read, exchanged and computed once, whatever the number of dates and metrics, and only rows that are
    asked for leave it. A period key means the anchor's own period: null when that period has no row yet. A second
    row of a product on a date is an error.
    """
    table = metrics(
        with_anchors(nav, anchors, anchor, partitions), names, windows, periods, None, prefixes, own, ("_ends",), **options)
    names = [names] if isinstance(names, str) else list(names)
    keys = {}
    for name in names:
        found = (own or {}).get(name) or metric(name)
        prefix = (prefixes or {}).get(name, found.prefix)
        keys.update({column_name(prefix, key): key for key in metric_keys(found, windows, periods)})
    rows = table.where("size(_ends) > 0").select("*", F.explode("_ends").alias("_end"))
    shown = [f"if({DATE} <= _end, {_of_same_period(key, '_end', column)}, NULL) AS {column}" for column, key in keys.items()]
    return rows.selectExpr(PRODUCT, f"_end AS {anchor}", f"if({DATE} <= _end, {DATE}, NULL) AS {DATE}", *shown)


def volatility_at(nav, anchors, name="list_volatility", windows=None, periods=None, anchor="end_date", **options):
    """Volatility at any date: frames end at the last row on or before it."""
    return metrics_at(nav, anchors, name, windows, periods, anchor, **options)


def latest_rows(nav, rows, with_first):
    """The last ``rows`` rows of each product, and its first one if asked for.

    The planner cuts the ranked rows to that many per product and task before it exchanges them. Rows on one date share
    their rank, so that none of them goes alone: two such rows are an error later on.
    """
    order = Window.partitionBy(PRODUCT).orderBy(F.desc(DATE))
    last = nav.select(PRODUCT, DATE, VALUE, F.rank().over(order).alias("_n")).where(F.col("_n") <= rows)
    if not with_first:
        return last.drop("_n")
    first = nav.groupBy(PRODUCT).agg(F.min(F.struct(DATE, VALUE)).alias("_first"), F.min(VALUE).alias("_least"), F.count("*").alias("_rows"))
    # A value below zero anywhere in the past matters as much as the first date: the row left stands for both.
    first = first.where(F.col("_rows") > rows).select(
        PRODUCT, F.col("_first")[DATE].alias(DATE), F.when(F.col("_least") < 0, F.col("_least")).otherwise(F.col("_first")[VALUE]).alias(VALUE))
    return last.drop("_n").unionByName(first)


def rows_of_period(nav, end, period, with_first):
    """The rows from the period's start on, the row before them, and the product's first one if asked for."""
    start = F.expr(period_start("_end", period))
    nav = nav.select(PRODUCT, DATE, VALUE, end.alias("_end")).select(PRODUCT, DATE, VALUE, (F.col(DATE) < start).alias("_early"))
    inside = nav.where("NOT _early").drop("_early")
    early = nav.where("_early").drop("_early")
    return inside.unionByName(latest_rows(early, 1, with_first))


def metric_at(nav, end_date, name, key, products=None, **options):
    """One metric of one key at any date (a date, yyyyMMdd or yyyy-MM-dd): one row per product that has a row by
    then, with the last row's own date.

    Only the rows that the key's frame can hold are sorted: the last N + 1 of each product for a look-back of N,
    those of the period and the one before for a period. Since inception takes all of them.
    """
    end = as_date(end_date).cast("date")
    if products is not None:
        nav = nav.filter(F.col(PRODUCT).isin([products] if isinstance(products, str) else list(products)))
    nav = nav.filter(F.col(DATE) <= end).select(PRODUCT, DATE, VALUE)
    aged = metric(name).aged
    if key == CURRENT or is_window(key) and key > 0:
        nav = latest_rows(nav, 2 if key == CURRENT else key + 1, aged)
    elif key in PERIODS:
        nav = rows_of_period(nav, end, key, aged)
    windows, periods = ([key], []) if is_window(key) else ([], [key])
    column = column_name(metric(name).prefix, key)
    table = metrics(nav, name, windows, periods, **options)
    last = table.groupBy(PRODUCT).agg(F.max(F.struct(DATE, column)).alias("row")).select(PRODUCT, "row.*")
    return last.select("*", end.alias("_end")).selectExpr(PRODUCT, DATE, f"{_of_same_period(key, '_end', column)} AS {column}")
