"""Drawdown, maximum drawdown and Calmar ratio."""

from navspan.functions.dates import day_gap
from navspan.functions.fixed import CURRENT, DATE, PERIODS, VALUE
from navspan.functions.keys import is_window, needed
from navspan.functions.numeric import pct_change, round_even
from navspan.operators import prepare as p
from navspan.operators.returns import annualized_return, frame_parts


def drawdown_parts(key):
    return [("high", key)] + ([] if is_window(key) else [("base", key)])


def max_drawdown_parts(key):
    return [] if key == CURRENT else [("decline", key)]


def calmar_parts(key):
    return ([] if key == CURRENT else [("depth", key)]) + frame_parts(key)


def _old_enough(key, min_points):
    """Whether the product is as old as the key asks for, in calendar days, and never was below zero, from where
    on a fall has no size."""
    return f"{day_gap(DATE, '_first_date')} >= {needed(key, min_points)} AND _lowest >= 0D"


def drawdown(key, min_points=None):
    """Current value against the highest earlier value of the frame; positive at a new high."""
    high = f"greatest(_high_{key}, _base_prev_val_{key})" if key in PERIODS else f"_high_{key}"
    return f"if({_old_enough(key, min_points)}, {round_even(pct_change(VALUE, high))}, NULL)"


def _deepest(key, field="m"):
    """A field of the deepest decline: drop (0 = none), trough day or peak day."""
    if key != CURRENT:
        return f"_dd_{key}_m" if field == "m" else f"int(_dd_{key}_{field})"
    if field != "m":
        return f"unix_date({DATE if field == 't' else '_prev_date'})"
    return f"if({VALUE} < _prev_val AND _prev_val > 0D, ({VALUE} - _prev_val) / _prev_val, 0D)"


def max_drawdown(key, min_points=None):
    """Struct of value, peak date, trough date and days between.

    Without a decline: 0.0, first date of the frame, current date. Null while the product is too young.
    """
    found = f"{_deepest(key)} < 0D"
    start, peak, trough = p.start_row(key)[0], _deepest(key, "s"), _deepest(key, "t")
    return (
        f"if({_old_enough(key, min_points)}, named_struct('value', {round_even(_deepest(key))}, "
        f"'s', if({found}, date_from_unix_date({peak}), {start}), "
        f"'t', if({found}, date_from_unix_date({trough}), {DATE}), "
        f"'drd', if({found}, {trough} - {peak}, {day_gap(DATE, start)})), NULL)"
    )


def max_drawdown_value(key, min_points=None):
    return f"if({_old_enough(key, min_points)}, {round_even(_deepest(key))}, NULL)"


def calmar_ratio(key, min_points=None, yearly=None):
    """Rounded annualised return (``yearly`` where it is a column already) over the size of the rounded maximum
    drawdown, itself unrounded."""
    return f"try_divide({yearly or annualized_return(key)}, abs({max_drawdown_value(key, min_points)}))"
