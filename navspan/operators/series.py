"""A product's series as window partitions.

Every ascending spec orders by the same columns (product, year, quarter, month, date), which is date
order within a product. So one hash exchange on the product and one sort serve the whole-product and
all the calendar windows. (product, date) is unique and dates are whole days, so a product holds at
most 366 rows a year however large the table is; raw tables with several rows per day are collapsed
before (``sources.nav.one_row_per_day``), by an aggregation that combines map-side.
"""

from navspan.functions.dates import day_gap
from navspan.functions.fixed import DATE, PRODUCT, VALUE
from navspan.functions.numeric import pct_change

_PARTS = {"product": 0, "year": 1, "quarter": 2, "month": 3}
_CALENDAR = ["_year", "_quarter", "_month"]

SO_FAR = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
ALL = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"


def over(part="product", frame=""):
    """Ordered window of one product, or of one calendar period of a product."""
    n = _PARTS[part]
    partition = ", ".join([PRODUCT] + _CALENDAR[:n])
    order = ", ".join(_CALENDAR[n:] + [DATE])
    return f"OVER (PARTITION BY {partition} ORDER BY {order} {frame})"


def over_backwards(frame=""):
    """Window of one product from its newest row to its oldest."""
    return f"OVER (PARTITION BY {PRODUCT} ORDER BY {DATE} DESC {frame})"


def by_product(nav, partitions="session"):
    """Hash partitions by product.

    The number given, and then exactly that number, or else as many of the session's shuffle partitions as the rows'
    bytes call for: adaptive execution merges small ones, though not below one a core while they hold a megabyte. A run
    has more generated classes than the stock class cache holds, so every task compiles most of them, which many small
    tasks would do for few rows each. With None the planner decides, and a table bucketed by product
    (``sources.files.write_bucketed``) needs no exchange at all.
    """
    if partitions is None:
        return nav
    return nav.repartition(PRODUCT) if partitions == "session" else nav.repartition(partitions, PRODUCT)


def add(df, columns):
    """Append ``{name: SQL expression}`` in one projection."""
    if not columns:
        return df
    return df.selectExpr("*", *[f"{sql} AS {name}" for name, sql in columns.items()])


def calendar_columns(df):
    return add(
        df,
        {"_year": f"year({DATE})", "_quarter": f"quarter({DATE})", "_month": f"month({DATE})"},
    )


def neighbours(seeded=False):
    """Position in the series, the row before, the first row and the lowest value so far; ``seeded`` rows go on from what
    their column ``_seed`` says of the rows before them (``plans.refresh``)."""
    w, so_far = over(), over(frame=SO_FAR)
    if seeded:
        return {
            **neighbours(),
            "_i": f"row_number() {w} - 1 + coalesce(_seed.rows, 0)",
            "_first_date": f"coalesce(_seed.first_date, first({DATE}) {so_far})",
            "_first_val": f"coalesce(_seed.first_val, first({VALUE}) {so_far})",
            "_lowest": f"least(min({VALUE}) {so_far}, _seed.lowest)",
        }
    return {
        "_i": f"row_number() {w} - 1",
        "_prev_date": f"lag({DATE}) {w}",
        "_prev_val": f"lag({VALUE}) {w}",
        "_first_date": f"first({DATE}) {so_far}",
        "_first_val": f"first({VALUE}) {so_far}",
        "_lowest": f"min({VALUE}) {so_far}",
    }


def row_offset_start(window):
    """The row ``window`` rows back, or the product's first row."""
    return {
        f"_start_date_{window}": f"coalesce(lag({DATE}, {window}) {over()}, _first_date)",
        f"_start_val_{window}": f"coalesce(lag({VALUE}, {window}) {over()}, _first_val)",
    }


def step_return():
    """Return per day since the previous row; null on the first row and on a zero base."""
    return {"_x": f"try_divide({pct_change(VALUE, '_prev_val')}, {day_gap(DATE, '_prev_date')})"}


def unless(wrong, keep="true", problem="two rows on one date"):
    """A filter condition that raises where ``wrong`` holds: no column that a query leaves out takes it away."""
    message = f"concat('{problem} for product ', coalesce({PRODUCT}, 'null'))"
    return f"if({wrong}, boolean(raise_error({message})), {keep})"


def place(window):
    """Columns by which ``unique_dates`` tells rows on one date: they share a rank. Comparing the dates themselves would
    not do, as a caller's filter on the date is put in their place."""
    return {"_place": f"row_number() {window}", "_rank": f"rank() {window}"}


def unique_dates(df):
    """df, which has the columns of ``place``, or an error if a product has two rows on a date, or one without."""
    return df.filter(unless(f"_place <> _rank OR {DATE} IS NULL", problem="two rows on one date, or one without,")).drop("_place", "_rank")
