"""Frame keys: an int is a look-back in rows (0 = since inception), a str a calendar period."""

from navspan.functions.fixed import CURRENT, PERIODS, WINDOWS


def check_window(window):
    if isinstance(window, bool) or not isinstance(window, int) or window < 0:
        raise ValueError(f"window must be a whole number of rows, 0 or more: {window!r}")
    return window


def check_period(period, current=True):
    allowed = PERIODS + ((CURRENT,) if current else ())
    if period not in allowed:
        raise ValueError(f"unknown period {period!r}, expected one of {allowed}")
    return period


def check_keys(windows, periods, current=True):
    """The keys in output order, each once."""
    keys = [check_window(w) for w in windows] + [check_period(p, current) for p in periods]
    if not keys:
        raise ValueError("give at least one window or period")
    return list(dict.fromkeys(keys))


def is_window(key):
    return isinstance(key, int)


def column_name(prefix, key):
    return f"{prefix}_{key}D"


def needed(key, min_points=None):
    """Rows or days that a frame asks for: the look-back itself, one for others; for a look-back that is not among
    the usual ones, ``min_points`` where given."""
    if not is_window(key):
        return 1
    return min_points if min_points is not None and key not in WINDOWS else max(key, 1)
