"""Annualised returns."""

from navspan.functions.dates import day_gap
from navspan.functions.fixed import CURRENT, DATE, VALUE
from navspan.functions.keys import is_window, needed
from navspan.functions.numeric import annualize, pct_change, round_even
from navspan.operators import prepare as p


def frame_parts(key):
    """Parts that give the start row and the row count of a frame."""
    if is_window(key):
        return [("start", key)]
    return [] if key == CURRENT else [("base", key)]


def _annualized(start):
    date, value = start
    return annualize(pct_change(VALUE, value), day_gap(DATE, date))


def annualized_return(key):
    """From the as-of start row, 4 decimals; null where the frame is the start row alone."""
    return round_even(_annualized(p.start_row(key)))


def strict_return(key, min_points=None):
    """From the forward start row, unrounded; null with fewer rows or days than the key asks for."""
    least = needed(key, min_points)
    start = p.forward_row(key)
    enough = f"{p.rows_in_range(key)} >= {least} AND {day_gap(DATE, start[0])} >= {least}"
    return f"if({enough}, {_annualized(start)}, NULL)"
