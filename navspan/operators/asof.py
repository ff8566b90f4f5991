"""Look-ups at arbitrary dates, on or off the valuation calendar.

Anchors are reduced to distinct (product, date) first, by an aggregation that combines map-side, so a
product with very many requests still brings at most one anchor per day into its window.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from navspan.functions.fixed import DATE, PRODUCT
from navspan.operators.series import unless


def lookup(table, anchors, anchor, forward, fallback):
    """Anchors with ``row``: the struct of the table's row found, null if there is none.

    Two rows of the table on one date are an error, as the one found would hang on their order.
    """
    payload = F.struct(*[c for c in table.columns if c != PRODUCT])
    rows = table.select(PRODUCT, F.col(DATE).alias("_at"), F.lit(0).alias("_tag"), payload.alias("_row"))
    wanted = anchors.select(PRODUCT, F.col(anchor).cast("date").alias("_at")).distinct()
    empty = F.lit(None).cast(rows.schema["_row"].dataType)
    wanted = wanted.select(PRODUCT, "_at", F.lit(1).alias("_tag"), empty.alias("_row"))
    at = F.col("_at").desc() if forward else F.col("_at")
    ordered = Window.partitionBy(PRODUCT).orderBy(at, "_tag")
    nearest = F.last("_row", ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    if fallback:
        whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        nearest = F.coalesce(nearest, F.first("_row", ignorenulls=True).over(whole))
    place = [F.row_number().over(ordered).alias("_place"), F.rank().over(ordered).alias("_rank")]
    both = rows.unionByName(wanted).select("*", nearest.alias("row"), *place)
    # Rows of one date share a rank. One condition: the rows that are not asked for are checked too.
    both = both.filter(unless("_place <> _rank", "_tag = 1"))
    return both.select(PRODUCT, F.col("_at").alias(anchor), "row")


def asof_rows(table, anchors, anchor="anchor"):
    """Per distinct anchor the last row on or before it, else the product's first row."""
    return lookup(table, anchors, anchor, forward=False, fallback=True).select(PRODUCT, anchor, "row.*")


def forward_rows(table, anchors, anchor="anchor"):
    """Per distinct anchor the first row on or after it; nulls if there is none."""
    return lookup(table, anchors, anchor, forward=True, fallback=False).select(PRODUCT, anchor, "row.*")
