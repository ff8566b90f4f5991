"""Stored summaries of a series: any look-back, or any range of dates, from a few rows.

A row's summary holds its step return (count, mean, squared deviations), its value as highest and lowest with days, and
no decline. Summaries of neighbouring rows merge, so ``RADIX`` of them make one of the next level, and so on. The rows
at positions lo to hi are then at most 2 * (RADIX - 1) summaries of each level, merged in order.

On disk are ``blocks`` (one folder a level, sorted by block number), ``calendar`` (one folder a year: of each product one
row with the days of that year and the last row before them, so that a day is found in one such row) and ``about``.
Only whole blocks are stored, which later days never change.
"""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from navspan.functions.fixed import DATE, PRODUCT, VALUE
from navspan.operators import series

RADIX = 8
FIELDS = {
    "n": "double", "mean": "double", "m2": "double", "high": "double", "high_day": "int", "low": "double", "low_day": "int",
    "m": "double", "t": "int", "s": "int", "p": "double",
}
_LEAF = {
    "n": "if(_x IS NULL, 0D, 1D)", "mean": "coalesce(_x, 0D)", "m2": "0D", "high": VALUE, "high_day": f"unix_date({DATE})",
    "low": VALUE, "low_day": f"unix_date({DATE})", "m": "0D", "t": "int(NULL)", "s": "int(NULL)", "p": "double(NULL)",
}


def _struct(columns):
    return "named_struct(" + ", ".join(f"'{name}', {sql}" for name, sql in columns.items()) + ")"


def _merged(a, b):
    """SQL: the summary of two neighbouring runs of rows, a before b. Equal highs and lows are the earliest ones. Of
    equally deep declines the earliest trough counts, then the highest peak, then the earliest."""
    n = f"({a}.n + {b}.n)"
    delta = f"({b}.mean - {a}.mean)"
    fall = f"if({b}.low < {a}.high AND {a}.high > 0D, ({b}.low - {a}.high) / {a}.high, 0D)"
    least = f"least({a}.m, {b}.m, {fall})"
    old = f"{a}.m = {least}"
    cross = f"({fall} = {least} AND ({b}.m > {least} OR {b}.low_day < {b}.t OR {b}.low_day = {b}.t AND {a}.high >= {b}.p))"

    def pick(field, across):
        return f"CASE WHEN {old} THEN {a}.{field} WHEN {cross} THEN {across} ELSE {b}.{field} END"

    return _struct({
        "n": n, "mean": f"if({n} > 0D, ({a}.n * {a}.mean + {b}.n * {b}.mean) / {n}, 0D)",
        "m2": f"{a}.m2 + {b}.m2 + if({n} > 0D, {delta} * {delta} * {a}.n * {b}.n / {n}, 0D)",
        "high": f"if({b}.high > {a}.high, {b}.high, {a}.high)", "high_day": f"if({b}.high > {a}.high, {b}.high_day, {a}.high_day)",
        "low": f"if({b}.low < {a}.low, {b}.low, {a}.low)", "low_day": f"if({b}.low < {a}.low, {b}.low_day, {a}.low_day)",
        "m": least, "t": pick("t", f"{b}.low_day"), "s": pick("s", f"{a}.high_day"), "p": pick("p", f"{a}.high"),
    })


def _in_order(summaries):
    """SQL: the merge of an array of summaries."""
    return f"aggregate(slice({summaries}, 2, size({summaries})), get({summaries}, 0), (a, b) -> {_merged('a', 'b')})"


def write_summaries(nav, path, radix=RADIX, partitions="session"):
    """Store the summaries of NAV rows (product, date, value), one row per product and date; replaces what is there.

    Each level is read back from the one below it, so that no level is computed twice.
    """
    spark = nav.sparkSession
    df = series.calendar_columns(series.by_product(nav.select(PRODUCT, DATE, VALUE), partitions))
    df = series.unique_dates(series.add(df, {**series.neighbours(), **series.place(series.over())}))
    df = series.add(df, series.step_return()).selectExpr(PRODUCT, "bigint(_i) AS block", DATE, VALUE, f"{_struct(_LEAF)} AS s")
    columns = [PRODUCT, "block", DATE, VALUE, "s.*"]
    df.select(*columns).sortWithinPartitions("block", PRODUCT).write.mode("overwrite").parquet(f"{path}/blocks/level=0")
    level, longest = 0, _level(spark, path, 0).agg(F.max("block")).first()[0] or 0
    while radix ** (level + 1) <= longest + 1:
        below = _level(spark, path, level).selectExpr(PRODUCT, f"block div {radix} AS up", f"struct(block, struct({', '.join(FIELDS)}) AS s) AS child")
        children = F.transform(F.sort_array(F.collect_list("child")), lambda x: x["s"]).alias("all")
        above = below.groupBy(PRODUCT, F.col("up").alias("block")).agg(children).where(f"size(all) = {radix}")
        level += 1
        above = above.selectExpr(PRODUCT, "block", f"{_in_order('all')} AS s").select(PRODUCT, "block", "s.*")
        above.sortWithinPartitions("block", PRODUCT).write.mode("overwrite").parquet(f"{path}/blocks/level={level}")
    last_year = _write_calendar(spark, path)
    spark.createDataFrame([(radix, level, last_year)], "radix int, levels int, last_year int").coalesce(1).write.mode("overwrite").parquet(f"{path}/about")


def _level(spark, path, level):
    return spark.read.parquet(f"{path}/blocks/level={level}")


def _write_calendar(spark, path):
    rows = _level(spark, path, 0).selectExpr(PRODUCT, f"year({DATE}) AS year", f"struct({DATE}, block AS position, {VALUE}) AS day")
    bounds = rows.agg(F.max("year")).first()[0]
    # At most 366 days a year.
    years = rows.groupBy(PRODUCT, "year").agg(F.sort_array(F.collect_list("day")).alias("days"))
    spans = years.groupBy(PRODUCT).agg(F.min("year").alias("first"))
    spans = spans.select(PRODUCT, F.explode(F.sequence("first", F.lit(bounds))).alias("year")) if bounds is not None else spans.select(PRODUCT, F.col("first").alias("year"))
    before = Window.partitionBy(PRODUCT).orderBy("year").rowsBetween(Window.unboundedPreceding, -1)
    every = spans.join(years, [PRODUCT, "year"], "left").select(PRODUCT, "year", "days", F.last(F.expr("get(days, size(days) - 1)"), True).over(before).alias("carried"))
    every = every.selectExpr(PRODUCT, "year", "concat(if(carried IS NULL, array(), array(carried)), coalesce(days, array())) AS days")
    every.write.mode("overwrite").partitionBy("year").parquet(f"{path}/calendar")
    return bounds


def about(spark, path):
    return spark.read.parquet(f"{path}/about").first()


def calendar(spark, path):
    schema = f"{PRODUCT} string, days array<struct<{DATE}: date, position: bigint, {VALUE}: double>>, year int"
    return spark.read.schema(schema).parquet(f"{path}/calendar")


def positions(spark, path, requests, *days):
    """requests (product, and the date columns ``days``) with a struct ``_at_<day>`` (date, position, value) for each: the
    last row on or before it, null if there is none. One row of the calendar is read for each."""
    last = about(spark, path)["last_year"]
    for day in days:
        years = calendar(spark, path).select(F.col(PRODUCT).alias("_p"), F.col("year").alias("_y"), "days")
        year = F.least(F.year(day), F.lit(last))
        found = requests.withColumn("_year", year).join(years, (F.col(PRODUCT) == F.col("_p")) & (F.col("_year") == F.col("_y")), "left")
        upto = F.expr(f"element_at(filter(days, d -> d.{DATE} <= `{day}`), -1)")
        requests = found.withColumn(f"_at_{day}", F.when(F.exists("days", lambda d: d[DATE] <= F.col(day)), upto)).drop("_p", "_y", "_year", "days")
    return requests


def pieces(lo, hi, radix, levels):
    """SQL: array of (level, block) that cover positions lo to hi, in no order; two columns of SQL per level."""
    steps, found = [], []
    a, b = f"({lo})", f"({hi} + 1)"
    for level in range(levels + 1):
        steps.append((f"_a{level}", f"_b{level}", a, b))
        a, b = f"_a{level}", f"_b{level}"
        up, down = f"ceil({a} / double({radix}))", f"floor({b} / double({radix}))"
        goes_on = f"({a} < {b} AND {up} < {down})" if level < levels else "false"

        def run(first, last, when):
            return f"if({when} AND {first} < {last}, transform(sequence({first}, {last} - 1), x -> struct({level} AS level, x AS block)), array())"

        found.append(run(a, f"{radix} * {up}", goes_on))
        found.append(run(f"{radix} * {down}", b, goes_on))
        found.append(run(a, b, f"NOT {goes_on}"))
        a, b = f"if({goes_on}, {up}, 0)", f"if({goes_on}, {down}, 0)"
    return steps, f"flatten(array({', '.join(found)}))"


def needed_blocks(spark, path, ranges):
    """Rows (all columns of ranges, level, block) of the summaries that cover positions _lo to _hi of ranges."""
    told = about(spark, path)
    steps, covering = pieces("_lo", "_hi", told["radix"], told["levels"])
    wanted = ranges
    for first, last, a, b in steps:
        wanted = wanted.selectExpr("*", f"bigint({a}) AS {first}", f"bigint({b}) AS {last}")
    wanted = wanted.selectExpr("*", f"explode({covering}) AS _piece")
    return wanted.selectExpr(*ranges.columns, "_piece.level AS level", "_piece.block AS block")


def stored_blocks(spark, path, wanted=None):
    """The stored summaries, of all levels; of few ``wanted`` (level, block) only the ranges of blocks that these span,
    by filters on folder and block that reach the scan."""
    told = about(spark, path)
    stored = reduce(lambda x, y: x.unionByName(y), [
        _level(spark, path, k).select(PRODUCT, F.lit(k).alias("level"), "block", *FIELDS) for k in range(told["levels"] + 1)
        if wanted is None or k in wanted
    ]) if wanted is None or wanted else _level(spark, path, 0).select(PRODUCT, F.lit(0).alias("level"), "block", *FIELDS).limit(0)
    if wanted is None:
        return stored
    parts = [F.col("block").between(a, b) & (F.col("level") == k) for k, (a, b) in wanted.items()]
    return stored.where(reduce(lambda x, y: x | y, parts)) if parts else stored


def spans(wanted):
    """{level: (first block, last block)} of the wanted ones: a few numbers, whatever the number of requests."""
    return {r["level"]: (r["a"], r["b"]) for r in wanted.groupBy("level").agg(F.min("block").alias("a"), F.max("block").alias("b")).collect()}


def range_summaries(spark, path, ranges, few=False):
    """ranges (product, any columns, positions _lo and _hi) with ``_summary`` of the rows from _lo to _hi; ranges without
    rows are left out. With ``few``, first looks up which blocks the requests span, and reads only those."""
    told = about(spark, path)
    keys = ranges.columns
    wanted = needed_blocks(spark, path, ranges)
    stored = stored_blocks(spark, path, spans(wanted) if few else None)
    stored = stored.select(F.col(PRODUCT).alias("_p"), F.col("level").alias("_l"), F.col("block").alias("_b"), F.struct(*FIELDS).alias("s"))
    joined = wanted.join(stored, (F.col(PRODUCT) == F.col("_p")) & (F.col("level") == F.col("_l")) & (F.col("block") == F.col("_b")))
    place = F.expr(f"block * bigint(power({told['radix']}, level))")
    merged = joined.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct(place.alias("at"), "s"))), lambda x: x["s"]).alias("_all"))
    return merged.selectExpr(*[f"`{k}`" for k in keys], f"{_in_order('_all')} AS _summary")
