"""Annualised volatility and Sharpe ratio."""

from navspan.functions.fixed import (
    CURRENT, DAYS_PER_YEAR, DEFAULT_MIN_POINTS, INCEPTION_ROWS_PER_STEP, PERIOD_DAYS,
    SCALING_RUNGS, VOLATILITY_MIN_ROWS,
)
from navspan.functions.keys import is_window
from navspan.functions.numeric import round_even
from navspan.operators import prepare as p

LADDERS = ("coded", "documented")


def check_ladder(ladder):
    if ladder not in LADDERS:
        raise ValueError(f"unknown ladder {ladder!r}, expected one of {LADDERS}")
    return ladder


def volatility_parts(key):
    return [("moments", key)] + ([] if is_window(key) else [("base", key)])


def list_volatility_parts(key):
    if is_window(key):
        return [("moments", key)]
    return [] if key == CURRENT else [("inner", key), ("base", key)]


def scaling(key, rows, ladder="coded", chained=False, daily=DAYS_PER_YEAR):
    """(days a step return is scaled to, periods a year) for a frame of ``rows`` rows, as SQL.

    ``coded``: the coarsest rung always holds, as the row gate is its threshold; ``chained`` takes the
    days of the rung reached before it. ``documented``: the finest rung that the frame reaches.
    """
    rungs = [(need, daily if freq == DAYS_PER_YEAR else freq) for need, freq in SCALING_RUNGS.get(key, ())]
    days = {**PERIOD_DAYS, daily: PERIOD_DAYS[DAYS_PER_YEAR]}
    if not rungs:
        return "1D", f"{daily}D"

    def reached(need):
        times = f" * floor({rows} / {INCEPTION_ROWS_PER_STEP})" if key == 0 else ""
        return f"{rows} >= {need}{times}"

    if ladder == "documented":
        finest = {**days, daily: 1}
        scale, freq = "1D", f"{daily}D"
        for need, per_year in reversed(rungs):
            scale = f"if({reached(need)}, {finest[per_year]}D, {scale})"
            freq = f"if({reached(need)}, {per_year}D, {freq})"
        return scale, freq
    coarsest = rungs[-1][1]
    scale = f"{days[daily] if chained else days[coarsest]}D"
    if chained and len(rungs) > 1:
        need, per_year = rungs[-2]
        scale = f"if({reached(need)}, {days[per_year]}D, {scale})"
    return scale, f"{coarsest}D"


def _gated(key, rows, min_points, value):
    least = VOLATILITY_MIN_ROWS.get(key, DEFAULT_MIN_POINTS if min_points is None else min_points)
    return f"if({rows} >= {least}, {value}, NULL)"


def annualized_volatility(key, ladder="coded", min_points=None, daily=DAYS_PER_YEAR):
    rows = p.frame_rows(key)
    scale, freq = scaling(key, rows, ladder, daily=daily)
    return _gated(key, rows, min_points, round_even(f"_std_{key} * {scale} * sqrt({freq})"))


def mean_step_return(key, ladder="coded", min_points=None, daily=DAYS_PER_YEAR):
    """Mean of the scaled step returns behind the volatility of the same key."""
    rows = p.frame_rows(key)
    scale, _ = scaling(key, rows, ladder, daily=daily)
    return _gated(key, rows, min_points, f"_mean_{key} * {scale}")


def sharpe_ratio(key, risk_free, ladder="coded", min_points=None, daily=DAYS_PER_YEAR, rounded=None):
    """Mean yearly step return over ``risk_free``, divided by the rounded volatility (``rounded`` where it is a
    column already)."""
    mean = mean_step_return(key, ladder, min_points, daily)
    excess = f"{mean} * {DAYS_PER_YEAR}D - double('{risk_free}')"
    return round_even(f"try_divide({excess}, {rounded or annualized_volatility(key, ladder, min_points, daily)})")


def list_volatility(key, ladder="coded", min_points=None, daily=DAYS_PER_YEAR):
    """Volatility over the forward frame, unrounded; ``current`` holds one step at most, so null."""
    if key == CURRENT:
        return "cast(NULL AS double)"
    rows = p.rows_in_range(key)
    scale, freq = scaling(key, rows, ladder, chained=True, daily=daily)
    std = f"_std_{key}" if is_window(key) else f"_std_inner_{key}"
    return _gated(key, rows, min_points, f"{std} * {scale} * sqrt({freq})")
