"""Reshaping and combining metric tables."""

from functools import reduce

from pyspark.sql import functions as F

from navspan.functions.dates import format_date
from navspan.functions.fixed import DATE, PRODUCT, REPORT_RETURNS, VALUE
from navspan.functions.keys import column_name
from navspan.sources.nav import one_row_per_day


def join_metrics(*tables):
    """Full outer join of metric tables that were computed apart, each unique on (product, date), which no column but
    these two may share: rows of any of them come out once, with nulls for what the others lack.

    The tables are stacked and then merged by key, so that any number of them meet in one step. Those hashed by product
    into equally many partitions, as ``metrics`` leaves them, meet without an exchange.
    """
    if len(tables) == 1:
        return tables[0]
    values = [c for t in tables for c in t.columns if c not in (PRODUCT, DATE)]
    if len(set(values)) < len(values):
        raise ValueError(f"metric tables share columns: {sorted(c for c in set(values) if values.count(c) > 1)}")
    types = {f.name: f.dataType for t in tables for f in t.schema}

    def padded(table):
        own = set(table.columns)
        return table.select(PRODUCT, DATE, *[F.col(c) if c in own else F.lit(None).cast(types[c]).alias(c) for c in values])

    stacked = reduce(lambda a, b: a.union(b), [padded(t) for t in tables])
    return stacked.groupBy(PRODUCT, DATE).agg(*[F.first(c, ignorenulls=True).alias(c) for c in values])


def join_stored(*tables):
    """``join_metrics`` of tables that ``sources.files.write_bucketed`` stored with equally many buckets. In a session with
    the defaults of ``navspan.session`` two of them are joined bucket by bucket, without an exchange; each further one
    takes an exchange of what is joined so far. (A union of stored tables would seem to need none either, but Spark
    4.1.2 then mixes up buckets where it reads them by column.)"""
    return reduce(lambda a, b: a.join(b, [PRODUCT, DATE], "full_outer"), tables)


def union_products(tables, empty):
    """Rows of all tables; without any, ``empty``, a table of no rows with the real columns."""
    return reduce(lambda a, b: a.unionByName(b), tables) if tables else empty


def long_table(wide, names):
    """One row per product, date and column: (name, value), in the order of the names."""
    return wide.unpivot([PRODUCT, DATE], list(names), "name", "value")


def nested(wide, names):
    """One row per product and date with an array of (name, value)."""
    pairs = [F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("value")) for n in names]
    return wide.select(PRODUCT, F.expr(format_date(DATE)).alias(DATE), F.array(*pairs).alias("values"))


def first_columns(df, *names):
    """The given columns first, the rest after them."""
    return df.select(*names, *[c for c in df.columns if c not in names])


def with_constant(df, name, value, dtype=None):
    """A constant column; null of the given type for None."""
    column = F.lit(value)
    return df.withColumn(name, column.cast(dtype) if dtype else column)


def report(returns):
    """The fixed eight-column output: text date and 32-bit returns."""
    columns = [
        f"float({column_name('Returns', window)}) AS {name}" for name, window in REPORT_RETURNS.items()
    ]
    return returns.selectExpr(PRODUCT, f"{format_date(DATE)} AS net_val_date", *columns)


def in_order(nav, step, start, schema):
    """A user's own metric that hangs on the one before: rows (product, date, and the columns of ``schema``).

    ``step(state, date, value)`` gives the next state and a tuple of the columns; a product's first row gets ``start`` as
    its state. The way out for what SQL over frames cannot say (``plans.registry.sql_metric``, ``frame_metric``): a Python
    table function over each product's rows in date order, which holds one state and one row at a time. A second row on
    a date is an error.
    """
    @F.udtf(returnType=f"{PRODUCT} string, {DATE} date, {schema}")
    class Steps:
        def __init__(self):
            self.state = start

        def eval(self, row):
            self.state, values = step(self.state, row[DATE], row[VALUE])
            yield (row[PRODUCT], row[DATE], *values)

    return Steps(one_row_per_day(nav).asTable().partitionBy(PRODUCT).orderBy(DATE))
