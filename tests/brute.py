"""Every metric by its definition, on plain lists: what the window plans are checked against."""

import math
from datetime import date, timedelta

PERIOD_FIRST_DAY = {
    "month": lambda d: date(d.year, d.month, 1),
    "quarter": lambda d: date(d.year, d.month - (d.month - 1) % 3, 1),
    "year": lambda d: date(d.year, 1, 1),
}


def anchor(day, key):
    return day - timedelta(days=1) if key == "current" else PERIOD_FIRST_DAY[key](day) - timedelta(days=1)


def frame(rows, i, key, forward=False):
    """Rows (day, value) of the frame of row i, start row included."""
    if isinstance(key, int):
        return rows[: i + 1] if key == 0 else rows[max(0, i - key): i + 1]
    border = anchor(rows[i][0], key)
    if forward:
        return [r for r in rows[: i + 1] if r[0] >= border]
    at_or_before = [j for j in range(i + 1) if rows[j][0] <= border]
    return rows[(at_or_before[-1] if at_or_before else 0): i + 1]


def half_even(x, digits=4):
    """As numpy does: half-even on the scaled value."""
    return None if x is None else float(round(x * 10 ** digits)) / 10 ** digits


def yearly(rows):
    days = (rows[-1][0] - rows[0][0]).days
    if days == 0 or rows[0][1] == 0:
        return None
    return (rows[-1][1] - rows[0][1]) / rows[0][1] * (365 / days)


def annualized_return(rows, i, key):
    return half_even(yearly(frame(rows, i, key)))


USUAL = (0, 7, 14, 30, 91, 182, 365, 730, 1095)


def asked(key, min_points=None):
    """Rows or days that a frame needs."""
    if isinstance(key, int) and key not in USUAL and min_points is not None:
        return min_points
    return key if isinstance(key, int) and key else 1


def strict_return(rows, i, key, min_points=None):
    found = frame(rows, i, key, forward=True)
    least = asked(key, min_points)
    if len(found) < least or (found[-1][0] - found[0][0]).days < least:
        return None
    return yearly(found)


def steps(rows):
    return [
        (b[1] - a[1]) / a[1] / (b[0] - a[0]).days for a, b in zip(rows, rows[1:]) if a[1] != 0
    ]


GATES = {"month": 12, "quarter": 12, "year": 12, 0: 182, 30: 12, 91: 12, 182: 6, 365: 12, 730: 24, 1095: 36}
# key -> days and periods a year once the gate is passed
COARSEST = {
    "month": (365, 365), "quarter": (7, 52), 91: (7, 52), "year": (30, 12), 182: (30, 12),
    365: (30, 12), 730: (30, 12), 1095: (30, 12), 0: (30, 12),
}
DOCUMENTED = {
    "month": [(12, 1, 365)], 30: [(12, 1, 365)], "quarter": [(36, 1, 365), (12, 7, 52)],
    91: [(36, 1, 365), (12, 7, 52)], 182: [(72, 1, 365), (24, 7, 52), (6, 30, 12)],
    "year": [(144, 1, 365), (48, 7, 52), (12, 30, 12)], 365: [(144, 1, 365), (48, 7, 52), (12, 30, 12)],
    730: [(288, 1, 365), (96, 7, 52), (24, 30, 12)], 1095: [(432, 1, 365), (144, 7, 52), (36, 30, 12)],
}
CHAINED = {  # key -> (periods a year, rows from which the scale is 7 days, else 365)
    "month": (365, None), "quarter": (52, None), 91: (52, None), "year": (12, 48), 365: (12, 48),
    182: (12, 24), 730: (12, 96), 1095: (12, 144), 0: (12, 0),
}


def scaling(key, n, ladder="coded"):
    if ladder == "coded":
        return COARSEST.get(key, (1, 365))
    if key == 0:
        return 1, 365
    for need, days, freq in DOCUMENTED.get(key, [(0, 1, 365)]):
        if n >= need:
            return days, freq
    return 1, 365


def mean(xs):
    return math.fsum(xs) / len(xs)


def deviation(xs):
    if len(xs) < 2:
        return None
    m = mean(xs)
    return math.sqrt(math.fsum((x - m) ** 2 for x in xs) / (len(xs) - 1))


def volatility(rows, i, key, ladder="coded", min_points=12):
    """(rounded volatility, scaled mean step return)."""
    found = frame(rows, i, key)
    if len(found) < GATES.get(key, min_points):
        return None, None
    days, freq = scaling(key, len(found), ladder)
    xs = [x * days for x in steps(found)]
    std = deviation(xs)
    return (None if std is None else half_even(std * math.sqrt(freq))), (mean(xs) if xs else None)


def sharpe(rows, i, key):
    vol, step = volatility(rows, i, key)
    return None if not vol else half_even((step * 365 - 0.015) / vol)


def list_volatility(rows, i, key, min_points=12):
    found = frame(rows, i, key, forward=True)
    if len(found) < GATES.get(key, min_points):
        return None
    days, freq = 1, 365
    if key in CHAINED:
        freq, seven_from = CHAINED[key]
        days = 7 if seven_from is not None and len(found) >= seven_from else 365
    std = deviation([x * days for x in steps(found)])
    return None if std is None else std * math.sqrt(freq)


def age(rows, i):
    return (rows[i][0] - rows[0][0]).days


def max_drawdown(rows, i, key, min_points=None):
    """(value, peak day, trough day, days), tried for every pair of rows."""
    if age(rows, i) < asked(key, min_points):
        return None
    found = frame(rows, i, key)
    best = (0.0, None, None)
    for t, (t_day, low) in enumerate(found):
        peak_day, peak = max(found[: t + 1], key=lambda r: (r[1], -r[0].toordinal()))
        if peak > 0 and low < peak and (low - peak) / peak < best[0]:
            best = ((low - peak) / peak, peak_day, t_day)
    drop, s, t = best
    if s is None:
        s, t = found[0][0], rows[i][0]
    return half_even(drop), s, t, (t - s).days


def calmar(rows, i, key, min_points=None):
    worst, gain = max_drawdown(rows, i, key, min_points), annualized_return(rows, i, key)
    if worst is None or gain is None or worst[0] == 0:
        return None
    return gain / abs(worst[0])


def drawdown(rows, i, key, min_points=None):
    if i == 0 or age(rows, i) < asked(key, min_points):
        return None
    high = max(r[1] for r in frame(rows, i, key)[:-1])
    return half_even((rows[i][1] - high) / high) if high else None
