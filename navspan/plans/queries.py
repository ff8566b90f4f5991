"""The registered queries: each reads whole tables and returns one result table.

Dates come out as text and -0.0 as 0.0; metrics that are not rounded by definition are rounded to six
decimals here, and only here, so that results can be compared by value.
"""

import uuid

from pyspark.sql import functions as F

from navspan.functions.dates import day_gap, format_date, period_anchor
from navspan.functions.fixed import DATE, PRODUCT, VALUE
from navspan.functions.numeric import round_even
from navspan.operators import asof, tables
from navspan.operators.sliding import Monoid
from navspan.plans.lookups import metric_at, metrics_at, volatility_at
from navspan.plans.registry import (
    BUNDLE, METRICS, all_indicators, all_metrics, frame_metric, metric_columns, metrics, sql_metric, step_returns,
)
from navspan.plans.refresh import next_state, refreshed, state_of
from navspan.plans.stored import drawdown_between, stored_metric_at, write_summaries
from navspan.sources import nav as navs
from navspan.sources import packed
from navspan.sources.files import shared_path, write_bucketed, write_files
from navspan.sources.derived import nations_with_orders, nav_events, nav_nation, nav_parts, nav_segment, nav_suppliers

CUSTOM_WINDOWS = (3, 21, 60)
POINT_DATE = "19960628"
SHORT_WINDOWS = (7, 14, 30, 0)
SUPPLIER_WINDOWS = (30, 91, 182, 365)
EVERY_PERIOD = ("month", "quarter", "year")


def _shown(df, rounded=False):
    columns = []
    for name, kind in df.dtypes:
        sql = f"`{name}`"
        if kind == "date":
            sql = f"string({sql})"
        elif kind == "double":
            sql = f"{round_even(sql, 6) if rounded else sql} + 0D"
        columns.append(f"{sql} AS `{name}`")
    return df.selectExpr(*columns)


def _metric(source, name, windows=None, periods=None, rounded=False, **options):
    def query(spark, sf_dir):
        return _shown(metrics(source(spark, sf_dir), name, windows, periods, **options), rounded)

    return query


def _max_drawdown_values(source, windows, periods, **options):
    def query(spark, sf_dir):
        found = metrics(source(spark, sf_dir), "max_drawdown", windows, periods, **options)
        names = metric_columns("max_drawdown", windows, periods)
        return _shown(found.select(PRODUCT, DATE, *[F.col(n)["value"].alias(n) for n in names]))

    return query


def _max_drawdown_detail(spark, sf_dir):
    windows, periods = (30, 365, 0), ("month", "year")
    found = metrics(nav_segment(spark, sf_dir), "max_drawdown", windows, periods)
    columns = []
    for n in metric_columns("max_drawdown", windows, periods):
        columns += [F.col(n)[f].alias(f"{n}_{f}") for f in ("value", "s", "t", "drd")]
    return _shown(found.select(PRODUCT, DATE, *columns))


def _max_drawdown_text(spark, sf_dir):
    return _shown(metrics(nav_segment(spark, sf_dir), "max_drawdown", (91,), ("quarter",), as_text=True))


def _returns_long(spark, sf_dir):
    names = metric_columns("strict_return")
    wide = metrics(nav_nation(spark, sf_dir), "strict_return")
    return _shown(tables.long_table(wide, names), rounded=True)


def _returns_nested(spark, sf_dir):
    names = metric_columns("strict_return")
    wide = metrics(nav_segment(spark, sf_dir), "strict_return")
    rows = tables.nested(wide, names).select(PRODUCT, DATE, F.posexplode("values").alias("position", "pair"))
    return _shown(rows.select(PRODUCT, DATE, "position", "pair.name", "pair.value"), rounded=True)


def _monthly_anchors(nav, name):
    """The 17th of every month in which a product has a row."""
    return nav.select(PRODUCT, F.date_add(F.trunc(DATE, "MM"), 16).alias(name)).distinct()


def _step_returns(spark, sf_dir):
    return _shown(step_returns(nav_nation(spark, sf_dir)), rounded=True)


def _volatility_asof(spark, sf_dir):
    nav = nav_nation(spark, sf_dir)
    return _shown(volatility_at(nav, _monthly_anchors(nav, "end_date")), rounded=True)


def _metrics_asof(spark, sf_dir):
    """Return, drawdown and Calmar ratio on the 17th of every month, on or off the calendar."""
    nav = nav_nation(spark, sf_dir)
    names = ["annualized_return", "drawdown", "annualized_calmer_ratio"]
    return _shown(metrics_at(nav, _monthly_anchors(nav, "end_date"), names, (30, 182, 0), EVERY_PERIOD), rounded=True)


def _asof_start(spark, sf_dir):
    nav = nav_nation(spark, sf_dir)
    return _shown(asof.asof_rows(nav, _monthly_anchors(nav, "anchor")))


def _forward_start(spark, sf_dir):
    nav = nav_nation(spark, sf_dir)
    return _shown(asof.forward_rows(nav, _monthly_anchors(nav, "anchor")))


def _metrics_bundle(spark, sf_dir):
    return _shown(tables.first_columns(all_metrics(nav_segment(spark, sf_dir)), DATE, PRODUCT))


def _product_metrics(spark, sf_dir):
    """All volatilities, then the last column of each other metric under the metric's name."""
    table = all_metrics(nav_segment(spark, sf_dir))
    last = [F.col(metric_columns(n)[-1]).alias(n) for n in BUNDLE[1:]]
    return _shown(table.select(PRODUCT, DATE, *metric_columns(BUNDLE[0]), *last))


def _metrics_outer_join(spark, sf_dir):
    """Returns of orders against counts of events and orders: rows of either side alone stay, both whole."""
    orders, events = nav_segment(spark, sf_dir), nav_events(spark, sf_dir)
    returns = metrics(orders, "annualized_return", (30,), ())
    counts = metrics(tables.union_products([navs.filter_product(orders, "BUILDING"), events], None), "valuation_count", (30,), ())
    return _shown(tables.join_metrics(returns, counts))


def _stored_outer_join(spark, sf_dir):
    """As ``_metrics_outer_join``, of two tables that are stored by product first."""
    orders, events = nav_segment(spark, sf_dir), nav_events(spark, sf_dir)
    some = tables.union_products([navs.filter_product(orders, "BUILDING"), events], None)
    made = {
        "returns": metrics(orders, "annualized_return", (30,), ()),
        "others": metrics(some, ["valuation_count", "drawdown"], (30,), ()),
    }
    names = []
    for name, table in made.items():
        names.append(f"{name}_{uuid.uuid4().hex}")
        write_bucketed(table, names[-1], 8, path=shared_path(spark, name))
    return _shown(tables.join_stored(*[spark.table(name) for name in names]))


def _union_products(spark, sf_dir):
    parts = [nav_segment(spark, sf_dir), nav_nation(spark, sf_dir), nav_events(spark, sf_dir)]
    return _shown(metrics(tables.union_products(parts, None), "valuation_count"))


def _report(spark, sf_dir):
    return tables.report(metrics(nav_segment(spark, sf_dir), "annualized_return"))


def _packed(spark, sf_dir):
    """Texts that hold every date twice: first a wrong value, at the end the right one."""
    texts = packed.pack(nav_nation(spark, sf_dir))
    wrong = F.regexp_replace("packed", r"\^", "^1")
    return texts.select(PRODUCT, F.concat_ws(",", wrong, "packed").alias("packed"))


def _packed_parse(spark, sf_dir):
    return _shown(packed.parse_packed(_packed(spark, sf_dir)))


def _packed_map(spark, sf_dir):
    maps = packed.parse_packed_map(_packed(spark, sf_dir))
    return _shown(maps.select(PRODUCT, F.explode("nav").alias(DATE, VALUE)))


def _packed_fanout(spark, sf_dir):
    whole = nav_segment(spark, sf_dir).withColumn(VALUE, F.floor(VALUE))
    return _shown(packed.fan_out(packed.pack(whole)))


def _nav_normalize(spark, sf_dir):
    """The order table as a raw NAV table: numbers as text, some unreadable, several rows a day."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    raw = orders.select(
        F.col("o_orderpriority").alias("code"),
        F.when(F.col("o_orderstatus") == "P", "unknown").otherwise(F.col("o_orderdate").cast("string")).alias("day"),
        F.col("o_totalprice").cast("string").alias("amount"),
        "o_orderkey",
    )
    return _shown(navs.normalize(raw, "code", "day", "amount"))


def _one_row_per_day(duplicates):
    def query(spark, sf_dir):
        orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
        raw = orders.select(
            F.col("o_orderpriority").alias(PRODUCT), F.col("o_orderdate").cast("date").alias(DATE),
            F.col("o_totalprice").alias(VALUE), "o_orderkey",
        )
        return _shown(navs.one_row_per_day(raw, duplicates, "o_orderkey"))

    return query


def _nav_range(spark, sf_dir):
    nav = navs.filter_product(nav_segment(spark, sf_dir), "BUILDING")
    return _shown(navs.filter_dates(nav, "19960101", "19971231"))


def _nav_products(spark, sf_dir):
    return navs.products(nations_with_orders(spark, sf_dir))


def _period_anchors(spark, sf_dir):
    columns = []
    for period in ("month", "quarter", "year", "current"):
        anchor = period_anchor(DATE, period)
        columns += [f"{format_date(anchor)} AS {period}_anchor", f"{day_gap(DATE, anchor)} AS {period}_days"]
    return _shown(nav_nation(spark, sf_dir).selectExpr(PRODUCT, DATE, *columns))


def _point(source, name, key, rounded=False):
    """The metric of each product at one date, on or off its calendar."""
    def query(spark, sf_dir):
        return _shown(metric_at(source(spark, sf_dir), POINT_DATE, name, key), rounded)

    return query


def _stored(source, name, window):
    """``_point`` from summaries that are written first."""
    def query(spark, sf_dir):
        path = shared_path(spark, "summaries")
        write_summaries(source(spark, sf_dir), path)
        return _shown(stored_metric_at(spark, path, POINT_DATE, name, window), rounded=True)

    return query


def _drawdown_ranges(spark, sf_dir):
    """From the 10th of every month with a row, ranges of 1 to 1,000 days."""
    nav = nav_nation(spark, sf_dir)
    path = shared_path(spark, "summaries")
    write_summaries(nav, path)
    months = nav.selectExpr(PRODUCT, f"date_add(trunc({DATE}, 'MM'), 9) AS start").distinct()
    requests = months.selectExpr(PRODUCT, "start", "explode(array(0, 30, 95, 400, 999)) AS length")
    requests = requests.selectExpr(PRODUCT, "start", "date_add(start, length) AS end")
    return _shown(drawdown_between(spark, path, requests))


def _custom_metric(spark, sf_dir):
    """A metric of the user's own, as SQL over frame parts: value over the best value of the frame."""
    ratio = sql_metric("Ratio", lambda key: f"{VALUE} / greatest({VALUE}, _high_{key})", lambda key: [("high", key)], (30, 0), ())
    return _shown(metrics(nav_nation(spark, sf_dir), "ratio", own={"ratio": ratio}), rounded=True)


def _sum_fields(*fields):
    return lambda a, b: {f: f"{a}_{f} + {b}_{f}" for f in fields}


REFRESHED = ["annualized_return", "valuation_count", "annualized_volatility", "max_drawdown", "annualized_calmer_ratio", "drawdown"]


def _refreshed(spark, sf_dir):
    """History first, then two batches of new days, each computed from the stored state before it."""
    nav = nav_nation(spark, sf_dir)
    keys = ((30, 365, 0), EVERY_PERIOD)
    day = F.col(DATE)
    batches = [nav.where(day <= "1995-12-31"), nav.where((day > "1995-12-31") & (day <= "1997-03-14")), nav.where(day > "1997-03-14")]
    results = [metrics(batches[0], REFRESHED, *keys)]
    state = state_of(batches[0], 365)
    for i, new in enumerate(batches[1:]):
        path = shared_path(spark, "state")
        write_files(state, path)
        state = spark.read.parquet(path)
        results.append(refreshed(state, new, REFRESHED, *keys))
        state = next_state(state, new, 365) if not i else None
    table = tables.union_products(results, None)
    names = metric_columns("max_drawdown", *keys)
    ratios = metric_columns("annualized_calmer_ratio", *keys)
    shown = {c: f"{c}.value" if c in names else round_even(c, 6) if c in ratios else c for c in table.columns}
    return _shown(table.selectExpr(*[f"{sql} AS {c}" for c, sql in shown.items()]))


def _downside_deviation(spark, sf_dir):
    """Root of the mean square of the step returns below zero, over look-backs."""
    falls = Monoid(
        "falls", {"n": "if(_x IS NULL, 0D, 1D)", "square": "pow(least(coalesce(_x, 0D), 0D), 2D)"}, {"n": "0D", "square": "0D"},
        _sum_fields("n", "square"), steps=True)
    own = frame_metric("Downside", falls, lambda frame, window: f"if({frame}_n > 0D, sqrt({frame}_square / {frame}_n), NULL)", (30, 91, 182))
    return _shown(metrics(nav_nation(spark, sf_dir), "downside", own={"downside": own}), rounded=True)


def _longest_rise(spark, sf_dir):
    """The most rows in a row that each stand above the row before, within look-backs: order matters when merging."""
    def combine(a, b):
        return {
            "n": f"{a}_n + {b}_n", "best": f"greatest({a}_best, {b}_best, {a}_tail + {b}_head)",
            "head": f"if({a}_head = {a}_n, {a}_n + {b}_head, {a}_head)", "tail": f"if({b}_tail = {b}_n, {b}_n + {a}_tail, {b}_tail)",
        }

    up = f"int(coalesce({VALUE} > _prev_val, false))"
    rises = Monoid("rises", {"n": "1", "best": up, "head": up, "tail": up}, dict.fromkeys(("n", "best", "head", "tail"), "0"), combine, steps=True)
    own = frame_metric("Rise", rises, lambda frame, window: f"{frame}_best", (7, 30, 365))
    return _shown(metrics(nav_segment(spark, sf_dir), ["rise", "annualized_return"], (7, 30, 365), (), own={"rise": own}))


def _custom_group(spark, sf_dir):
    """What windows cannot say, as each value hangs on the one before: an exponential average."""
    def step(average, date, value):
        average = value if average is None else 0.3 * value + 0.7 * average
        return average, (average,)

    return _shown(tables.in_order(nav_segment(spark, sf_dir), step, None, "average double"), rounded=True)


def _custom_state(spark, sf_dir):
    """Held until a third below the best value since it was bought; bought again at a third above the worst since then."""
    def step(state, date, value):
        held, edge = state or (True, value)
        edge = max(edge, value) if held else min(edge, value)
        turned = 3 * value <= 2 * edge if held else 3 * value >= 4 * edge
        held, edge = (not held, value) if turned else (held, edge)
        return (held, edge), (held, edge)

    return _shown(tables.in_order(nav_nation(spark, sf_dir), step, None, "held boolean, edge double"))


def _all_indicators(spark, sf_dir):
    """All seven families of every part in one run; of the maximum drawdowns the value."""
    table = all_indicators(nav_parts(spark, sf_dir))
    declines, ratios = set(metric_columns("max_drawdown")), set(metric_columns("annualized_calmer_ratio"))
    shown = {c: f"{c}.value" if c in declines else round_even(c, 6) if c in ratios else c for c in table.columns}
    return _shown(table.selectExpr(*[f"{sql} AS {c}" for c, sql in shown.items()]))


def _returns_both(spark, sf_dir):
    names = ["annualized_return", "strict_return"]
    return _shown(metrics(nav_nation(spark, sf_dir), names, prefixes={"strict_return": "Strict"}), rounded=True)


def _constant_column(spark, sf_dir):
    table = tables.with_constant(nav_segment(spark, sf_dir), "currency", "CNY")
    return _shown(tables.with_constant(table, "note", None, "string"))


QUERIES = {
    "returns_windows": _metric(nav_segment, "annualized_return", periods=()),
    "returns_periods": _metric(nav_nation, "annualized_return", windows=()),
    "returns_custom_windows": _metric(nav_nation, "annualized_return", CUSTOM_WINDOWS, ("current",)),
    "returns_short_history": _metric(nav_events, "annualized_return"),
    "returns_strict": _metric(nav_nation, "strict_return", rounded=True),
    "returns_long": _returns_long,
    "returns_nested": _returns_nested,
    "returns_output_schema": _report,
    "valuation_count": _metric(nav_nation, "valuation_count"),
    "valuation_count_range": _metric(nav_nation, "range_count", periods=("month", "quarter", "year", "current")),
    "volatility_windows": _metric(nav_segment, "annualized_volatility", periods=()),
    "volatility_periods": _metric(nav_nation, "annualized_volatility", windows=()),
    "volatility_custom_windows": _metric(nav_nation, "annualized_volatility", CUSTOM_WINDOWS, (), min_points=4),
    "volatility_documented": _metric(nav_segment, "annualized_volatility", ladder="documented"),
    "volatility_list": _metric(nav_nation, "list_volatility", rounded=True),
    "volatility_steps": _metric(nav_nation, "mean_step_return", rounded=True),
    "step_returns": _step_returns,
    "volatility_asof": _volatility_asof,
    "sharpe": _metric(nav_segment, "annualized_sharpe_ratio"),
    "max_drawdown_windows": _max_drawdown_values(nav_segment, METRICS["max_drawdown"].windows, ()),
    "max_drawdown_periods": _max_drawdown_values(nav_nation, (0,), ("month", "quarter", "year", "current")),
    "max_drawdown_detail": _max_drawdown_detail,
    "max_drawdown_text": _max_drawdown_text,
    "calmar": _metric(nav_nation, "annualized_calmer_ratio", rounded=True),
    "drawdown_windows": _metric(nav_segment, "drawdown", periods=()),
    "drawdown_periods": _metric(nav_nation, "drawdown", windows=()),
    "metrics_bundle": _metrics_bundle,
    "product_metrics": _product_metrics,
    "metrics_outer_join": _metrics_outer_join,
    "stored_outer_join": _stored_outer_join,
    "union_products": _union_products,
    "point_metric": _point(nav_nation, "annualized_volatility", 30),
    "point_period": _point(nav_nation, "strict_return", "quarter", rounded=True),
    "point_drawdown": _point(nav_segment, "drawdown", 91),
    "stored_volatility": _stored(nav_nation, "annualized_volatility", 30),
    "stored_calmar": _stored(nav_nation, "annualized_calmer_ratio", 182),
    "stored_drawdown": _stored(nav_segment, "drawdown", 91),
    "drawdown_ranges": _drawdown_ranges,
    "custom_metric": _custom_metric,
    "refreshed": _refreshed,
    "downside_deviation": _downside_deviation,
    "longest_rise": _longest_rise,
    "custom_group": _custom_group,
    "custom_state": _custom_state,
    "constant_column": _constant_column,
    "returns_both": _returns_both,
    "strict_return_custom": _metric(nav_nation, "strict_return", CUSTOM_WINDOWS, (), rounded=True, min_points=2),
    "count_custom": _metric(nav_nation, "valuation_count", CUSTOM_WINDOWS, ()),
    "sharpe_custom": _metric(nav_nation, "annualized_sharpe_ratio", CUSTOM_WINDOWS, (), min_points=4),
    "max_drawdown_custom": _max_drawdown_values(nav_nation, CUSTOM_WINDOWS, (), min_points=40),
    "calmar_custom": _metric(nav_nation, "annualized_calmer_ratio", CUSTOM_WINDOWS, (), rounded=True, min_points=40),
    "drawdown_custom": _metric(nav_nation, "drawdown", CUSTOM_WINDOWS, (), min_points=40),
    "volatility_daily_252": _metric(nav_nation, "annualized_volatility", daily=252),
    "volatility_list_daily_252": _metric(nav_nation, "list_volatility", rounded=True, daily=252),
    "sharpe_risk_free": _metric(nav_segment, "annualized_sharpe_ratio", (30, 365), ("year",), risk_free=0.03),
    "supplier_returns": _metric(nav_suppliers, "annualized_return", SUPPLIER_WINDOWS),
    "supplier_volatility": _metric(nav_suppliers, "annualized_volatility", SUPPLIER_WINDOWS),
    "part_max_drawdown": _max_drawdown_values(nav_parts, SHORT_WINDOWS, EVERY_PERIOD),
    "part_calmar": _metric(nav_parts, "annualized_calmer_ratio", SHORT_WINDOWS, EVERY_PERIOD, rounded=True),
    "part_bundle": _metric(nav_parts, BUNDLE),
    "all_indicators": _all_indicators,
    "metrics_asof": _metrics_asof,
    "asof_start": _asof_start,
    "forward_start": _forward_start,
    "period_anchors": _period_anchors,
    "packed_parse": _packed_parse,
    "packed_map": _packed_map,
    "packed_fanout": _packed_fanout,
    "nav_normalize": _nav_normalize,
    "nav_last_per_day": _one_row_per_day("last"),
    "nav_first_per_day": _one_row_per_day("first"),
    "nav_range": _nav_range,
    "nav_products": _nav_products,
}

FLAGSHIP = "metrics_bundle"
