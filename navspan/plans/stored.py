"""Look-ups that read stored summaries (``operators.summaries``) instead of the series."""

from pyspark.sql import functions as F

from navspan.functions.dates import as_date
from navspan.functions.fixed import DATE, PRODUCT, VALUE
from navspan.functions.keys import check_window, column_name
from navspan.functions.numeric import round_even
from navspan.operators import summaries
from navspan.operators.summaries import write_summaries  # noqa: F401  the table that all of these read
from navspan.plans.registry import Options, metric


def drawdown_between(spark, path, requests, start="start", end="end"):
    """Of requests (product, start, end; other columns pass) the deepest decline of the rows dated from start to end,
    both included: value (rounded, 0.0 without a decline), s and t (peak and trough; first and last row's date without
    a decline), drd (days between) and rows; nulls and 0 rows where there are none. A value below zero gives a null
    value, as a fall from there has no size. Requests that repeat come out as often.

    Reads one calendar row a date, and O(log rows) summaries a request, whatever the length of its range.
    """
    spark_columns = requests.columns
    asked = requests.select(PRODUCT, F.col(start).cast("date").alias("_start"), F.col(end).cast("date").alias("_end")).distinct()
    found = summaries.positions(spark, path, asked.withColumn("_before", F.date_sub("_start", 1)), "_before", "_end")
    found = found.selectExpr(PRODUCT, "_start", "_end", "coalesce(_at__before.position + 1, 0) AS _lo", "_at__end.position AS _hi", f"_at__end.{DATE} AS _last")
    ranges = found.where("_hi >= _lo AND _start <= _end")
    merged = summaries.range_summaries(spark, path, ranges)
    first = summaries.stored_blocks(spark, path, None).where("level = 0").select(F.col(PRODUCT).alias("_p"), F.col("block").alias("_b"), F.expr("date_from_unix_date(low_day)").alias("_first"))
    merged = merged.join(first, (F.col(PRODUCT) == F.col("_p")) & (F.col("_lo") == F.col("_b")))
    fall = "_summary.m < 0D"
    merged = merged.selectExpr(
        PRODUCT, "_start", "_end", f"if(_summary.low >= 0D, {round_even('_summary.m')}, NULL) AS value",
        f"if(_summary.low >= 0D, if({fall}, date_from_unix_date(_summary.s), _first), NULL) AS s",
        f"if(_summary.low >= 0D, if({fall}, date_from_unix_date(_summary.t), _last), NULL) AS t", "_hi - _lo + 1 AS rows")
    merged = merged.withColumnsRenamed({PRODUCT: "_of", "_start": "_from", "_end": "_to"})
    same = F.col(PRODUCT).eqNullSafe(F.col("_of")) & F.col(start).cast("date").eqNullSafe(F.col("_from")) & F.col(end).cast("date").eqNullSafe(F.col("_to"))
    return requests.join(merged, same, "left").selectExpr(
        *[f"`{c}`" for c in spark_columns], "value", "s", "t", "datediff(t, s) AS drd", "coalesce(rows, 0) AS rows")


def _ranges(parts, window):
    """{name: (lo, hi)} as SQL of the last row's position: the runs of rows that the parts of a metric need."""
    start = "0" if window == 0 else f"greatest(0, _e - {window})"
    found = {"all": ("0", "_e")}
    for kind, _ in parts:
        if kind == "moments":
            found[kind] = ("0" if window == 0 else f"greatest(0, _e - {window - 1})", "_e")
        elif kind in ("decline", "depth"):
            found[kind] = (start, "_e")
        elif kind == "high":
            found[kind] = (start, "_e - 1")
    return found, start


def stored_metric_at(spark, path, end_date, name, window, products=None, **options):
    """``lookups.metric_at`` for a look-back, from stored summaries: one row per product that has a row by then.

    Reads the calendar of one year, and of the summaries those blocks that the look-backs of the products span.
    """
    check_window(window)
    found = metric(name)
    parts = [p for p in found.parts(window)]
    ranges, start = _ranges(parts, window)
    end = as_date(end_date).cast("date")
    calendar = summaries.calendar(spark, path)
    if products is not None:
        calendar = calendar.where(F.col(PRODUCT).isin([products] if isinstance(products, str) else list(products)))
    told = summaries.about(spark, path)
    asked = calendar.where(F.col("year") == F.least(F.year(end), F.lit(told["last_year"]))).withColumn("_end", end)
    asked = asked.where(f"exists(days, d -> d.{DATE} <= _end)").selectExpr(PRODUCT, f"element_at(filter(days, d -> d.{DATE} <= _end), -1) AS _row")
    asked = asked.selectExpr(PRODUCT, f"_row.{DATE} AS {DATE}", f"_row.{VALUE} AS {VALUE}", "_row.position AS _e", f"{start} AS _s")
    each = ", ".join(f"struct('{kind}' AS kind, bigint({lo}) AS lo, bigint({hi}) AS hi)" for kind, (lo, hi) in ranges.items())
    each += ", struct('start' AS kind, bigint(_s) AS lo, bigint(_s) AS hi), struct('first' AS kind, 0L AS lo, 0L AS hi)"
    runs = asked.selectExpr(PRODUCT, f"explode(array({each})) AS r").selectExpr(PRODUCT, "r.kind AS _kind", "r.lo AS _lo", "r.hi AS _hi").where("_hi >= _lo")
    merged = summaries.range_summaries(spark, path, runs, few=True)
    kinds = ["start", "first", *ranges]
    wide = merged.groupBy(F.col(PRODUCT).alias("_p")).agg(*[F.max(F.when(F.col("_kind") == k, F.col("_summary"))).alias(f"_{k}") for k in kinds])
    rows = asked.join(wide, F.col(PRODUCT) == F.col("_p"))
    moments, fall = "_moments", "_decline" if "decline" in ranges else "_depth"
    columns = {
        "_i": "_e", "_first_date": "date_from_unix_date(_first.low_day)", "_first_val": "_first.low", "_lowest": "_all.low",
        f"_start_date_{window}": "date_from_unix_date(_start.low_day)", f"_start_val_{window}": "_start.low",
    }
    if "moments" in ranges:
        columns[f"_mean_{window}"] = f"if({moments}.n > 0D, {moments}.mean, NULL)"
        columns[f"_std_{window}"] = f"if({moments}.n > 1D, sqrt({moments}.m2 / ({moments}.n - 1D)), NULL)"
    if "high" in ranges:
        columns[f"_high_{window}"] = "_high.high"
    if "decline" in ranges or "depth" in ranges:
        columns.update({f"_dd_{window}_{f}": f"{fall}.{f}" for f in ("m", "t", "s")})
    rows = rows.selectExpr(PRODUCT, DATE, VALUE, *[f"{sql} AS {column}" for column, sql in columns.items()])
    more = [None] if found.reused else []
    return rows.selectExpr(PRODUCT, DATE, f"{found.column(window, Options(**options), *more)} AS {column_name(found.prefix, window)}")
