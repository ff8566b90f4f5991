"""The metrics by name, and the one job that computes any set of them for all products."""

from collections.abc import Callable
from dataclasses import dataclass

from navspan.functions.dates import day_gap
from navspan.functions.fixed import (
    CURRENT, DATE, DAYS_PER_YEAR, PERIODS, PRODUCT, RISK_FREE, VALUE, WINDOWS,
    WINDOWS_WITHOUT_VOLATILITY,
)
from navspan.functions.keys import check_keys, column_name
from navspan.functions.numeric import drawdown_text, pct_change
from navspan.operators import counts, drawdown, returns, series, volatility
from navspan.operators.prepare import prepare

_VOLATILITY_WINDOWS = tuple(w for w in WINDOWS if w not in WINDOWS_WITHOUT_VOLATILITY)


@dataclass(frozen=True)
class Options:
    risk_free: float = RISK_FREE
    ladder: str = "coded"
    min_points: int | None = None
    daily: int = DAYS_PER_YEAR
    as_text: bool = False


@dataclass(frozen=True)
class Metric:
    """``parts(key)`` names the frame columns needed, ``column(key, options)`` is the result as SQL.

    ``reused``: the metric whose column of the same key the result starts from, where one run computes both;
    ``column`` then gets that column's name as a third argument, and None otherwise. ``aged``: it asks for the
    product's first date, wherever the frame starts.
    """

    prefix: str
    parts: Callable
    column: Callable
    windows: tuple = WINDOWS
    periods: tuple = PERIODS
    current: bool = True
    reused: str | None = None
    aged: bool = False


METRICS = {
    "annualized_return": Metric(
        "Returns", returns.frame_parts, lambda k, o: returns.annualized_return(k),
        periods=PERIODS + (CURRENT,),
    ),
    "valuation_count": Metric("Count", returns.frame_parts, lambda k, o: counts.valuation_count(k)),
    "annualized_volatility": Metric(
        "Volatility", volatility.volatility_parts,
        lambda k, o: volatility.annualized_volatility(k, o.ladder, o.min_points, o.daily),
        windows=_VOLATILITY_WINDOWS, current=False,
    ),
    "mean_step_return": Metric(
        "Step", volatility.volatility_parts,
        lambda k, o: volatility.mean_step_return(k, o.ladder, o.min_points, o.daily),
        windows=_VOLATILITY_WINDOWS, current=False,
    ),
    "annualized_sharpe_ratio": Metric(
        "Sharpe", volatility.volatility_parts,
        lambda k, o, v: volatility.sharpe_ratio(k, o.risk_free, o.ladder, o.min_points, o.daily, v),
        windows=_VOLATILITY_WINDOWS, current=False, reused="annualized_volatility",
    ),
    "max_drawdown": Metric(
        "Max_drawdown", drawdown.max_drawdown_parts, lambda k, o: drawdown.max_drawdown(k, o.min_points), aged=True,
    ),
    "annualized_calmer_ratio": Metric(
        "Calmer", drawdown.calmar_parts, lambda k, o, v: drawdown.calmar_ratio(k, o.min_points, v),
        reused="annualized_return", aged=True,
    ),
    "drawdown": Metric(
        "Drawdown", drawdown.drawdown_parts, lambda k, o: drawdown.drawdown(k, o.min_points), current=False, aged=True,
    ),
    "strict_return": Metric(
        "Returns", returns.frame_parts, lambda k, o: returns.strict_return(k, o.min_points),
        periods=PERIODS + (CURRENT,),
    ),
    "range_count": Metric("Count", returns.frame_parts, lambda k, o: counts.range_count(k)),
    "list_volatility": Metric(
        "Volatility", volatility.list_volatility_parts,
        lambda k, o: volatility.list_volatility(k, o.ladder, o.min_points, o.daily),
        windows=_VOLATILITY_WINDOWS,
    ),
}

BUNDLE = ("annualized_volatility", "valuation_count", "annualized_return", "drawdown")
INDICATORS = (
    "annualized_return", "valuation_count", "annualized_volatility", "annualized_sharpe_ratio", "max_drawdown",
    "annualized_calmer_ratio", "drawdown",
)


def sql_metric(prefix, column, parts=returns.frame_parts, windows=WINDOWS, periods=PERIODS, current=False):
    """A user's own metric for ``metrics(..., own={name: ...})``: ``column(key)`` is SQL over the frame's parts,
    which ``operators.prepare`` lists, and over the table's columns."""
    return Metric(prefix, parts, lambda key, options: column(key), windows, periods, current)


def frame_metric(prefix, monoid, finish, windows=tuple(w for w in WINDOWS if w)):
    """A user's own aggregate over look-backs for ``metrics(..., own={name: ...})``: ``monoid`` (``operators.sliding.Monoid``)
    summarises a frame in O(log length) a row, and ``finish(frame, window)`` is the result as SQL over the columns
    ``{frame}_field`` and the row's own."""
    return Metric(prefix, lambda key: [(monoid, key)], lambda key, options: finish(monoid.frame(key), key), windows, (), False)


def metric_catalog():
    """Names of the metrics."""
    return sorted(METRICS)


def metric(name):
    if name not in METRICS:
        raise ValueError(f"unknown metric {name!r}, expected one of {metric_catalog()}")
    return METRICS[name]


def metric_keys(name, windows=None, periods=None):
    found = name if isinstance(name, Metric) else metric(name)
    return check_keys(
        found.windows if windows is None else windows,
        found.periods if periods is None else periods,
        found.current,
    )


def metric_columns(name, windows=None, periods=None):
    """Output column names of a metric."""
    return [column_name(metric(name).prefix, k) for k in metric_keys(name, windows, periods)]


def metrics(
    nav, names, windows=None, periods=None, partitions="session", prefixes=None, own=None, kept=(), seeded=False, **options
):
    """One row per product and date with the columns of all ``names``.

    ``nav`` has prod_reg_code, date and net_val, one row per product and date; two rows on one date
    raise. ``windows`` and ``periods`` replace each metric's own lists. Options: ``risk_free``,
    ``ladder`` (coded, documented), ``min_points`` for unlisted windows, ``daily`` periods a year,
    ``as_text`` for maximum drawdowns as text. ``prefixes`` {name: prefix} renames a metric's columns, so that
    both variants of one go into one run; ``own`` {name: metric} adds metrics (``sql_metric``); columns ``kept``
    pass through; ``seeded`` is for ``plans.refresh``. One exchange and one sort, whatever the number of columns; with ``partitions=None`` and a
    table bucketed by product no exchange.
    """
    options = Options(**options)
    volatility.check_ladder(options.ladder)
    names = [names] if isinstance(names, str) else list(names)
    known = {name: (own or {}).get(name) or metric(name) for name in names}
    prefix = {name: (prefixes or {}).get(name, found.prefix) for name, found in known.items()}
    outputs = []
    for name, found in known.items():
        for key in metric_keys(found, windows, periods):
            more = []
            if found.reused:
                shared = found.reused in known and key in metric_keys(found.reused, windows, periods)
                more = [column_name(prefix[found.reused], key) if shared else None]
            column = column_name(prefix[name], key)
            outputs.append((column, key, found.parts(key), found.column(key, options, *more)))
    columns = [output[0] for output in outputs]
    if len(set(columns)) < len(columns):
        raise ValueError(f"metrics {names} share column names; give them prefixes")
    df = prepare(nav, [part for output in outputs for part in output[2]], outputs, partitions, kept, seeded)
    if options.as_text and "max_drawdown" in known:
        text = {column_name(prefix["max_drawdown"], k) for k in metric_keys("max_drawdown", windows, periods)}
        columns = [f"{drawdown_text(c)} AS {c}" if c in text else c for c in columns]
    return df.selectExpr(PRODUCT, DATE, *kept, *columns)


def all_metrics(nav, **options):
    """The bundle: volatility, valuation count, return and drawdown."""
    return metrics(nav, BUNDLE, **options)


def all_indicators(nav, windows=None, periods=None, **options):
    """All seven families in one run."""
    return metrics(nav, INDICATORS, windows, periods, **options)


def step_returns(nav, partitions="session"):
    """Every row's step since the row before: days, relative change and change per day.

    The step series of a frame are these rows, scaled by the days that ``volatility.scaling`` gives.
    """
    df = series.calendar_columns(series.by_product(nav, partitions))
    df = series.add(df, {**series.neighbours(), **series.place(series.over())})
    return series.unique_dates(df).selectExpr(
        PRODUCT, DATE, f"{day_gap(DATE, '_prev_date')} AS days",
        f"{pct_change(VALUE, '_prev_val')} AS change", f"{series.step_return()['_x']} AS step",
    )
