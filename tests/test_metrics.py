"""Window plans against definitions, on series with gaps, ties, flat runs, zeros and short histories."""

import random
from datetime import date, timedelta

import pytest

import brute
from navspan.functions.fixed import WINDOWS
from navspan.plans.lookups import volatility_at
from navspan.plans.registry import METRICS, metric_keys, metrics

SMALL = [1, 2, 3, 5, 7, 14, 30, 91]


def _series(seed, rows, gaps, values, start=date(2021, 11, 3)):
    rng, day, out = random.Random(seed), start, []
    for _ in range(rows):
        out.append((day, float(values(rng))))
        day += timedelta(days=rng.choice(gaps))
    return out


def _rounded(rng):
    return round(rng.uniform(0.5, 3.0), 4)


SERIES = {
    "daily": _series(1, 260, [1], _rounded),
    "workdays": _series(2, 220, [1, 1, 1, 1, 3], _rounded),
    "gaps": _series(3, 200, [1, 2, 9, 40, 120, 400], _rounded),
    "ties": _series(4, 150, [1, 2, 5], lambda rng: rng.choice([1, 2, 3])),
    "zeros": _series(5, 80, [1, 3], lambda rng: rng.choice([0, 1, 2])),
    "flat": [(date(2024, 1, 1) + timedelta(days=k), 1.5) for k in range(60)],
    "rising": [(date(2024, 1, 30) + timedelta(days=k), 1.0 + k / 64) for k in range(60)],
    "falling": [(date(2024, 12, 30) + timedelta(days=k), 4.0 - k / 64) for k in range(60)],
    "one": [(date(2024, 6, 30), 2.0)],
    "anchors": [
        (d, float(v)) for v, d in enumerate(
            [date(2023, 12, 31), date(2024, 1, 1), date(2024, 1, 31), date(2024, 3, 31),
             date(2024, 4, 1), date(2024, 4, 30), date(2024, 12, 30), date(2025, 1, 1)], 3)
    ],
    "quarterly": _series(6, 40, [88, 90, 93, 95], _rounded),
}


@pytest.fixture(scope="module")
def nav(spark):
    rows = [(p, d, v) for p, series in SERIES.items() for d, v in series]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, "prod_reg_code string, date date, net_val double")


def _expected(name, rows, i, key, min_points=None):
    if name == "annualized_volatility":
        return brute.volatility(rows, i, key)[0]
    if name == "mean_step_return":
        return brute.volatility(rows, i, key)[1]
    if name in ("valuation_count", "range_count"):
        return len(brute.frame(rows, i, key, forward=name == "range_count"))
    if name == "annualized_return":
        return brute.annualized_return(rows, i, key)
    return {
        "strict_return": brute.strict_return, "max_drawdown": brute.max_drawdown,
        "annualized_calmer_ratio": brute.calmar, "drawdown": brute.drawdown,
    }[name](rows, i, key, min_points)


def _same(got, want):
    if want is None or got is None:
        return got is None and want is None
    if isinstance(want, tuple):
        return tuple(got)[1:] == want[1:] and _same(got[0], want[0])
    return got == want or abs(got - want) <= 1e-9 * max(1.0, abs(want))


def _check(result, name, keys, prefix, expected=_expected):
    wrong, seen = [], 0
    index = {(p, d): (rows, i) for p, rows in SERIES.items() for i, (d, _) in enumerate(rows)}
    for row in result.collect():
        rows, i = index[(row["prod_reg_code"], row["date"])]
        seen += 1
        for key in keys:
            got, want = row[f"{prefix}_{key}D"], expected(name, rows, i, key)
            if not _same(got, want):
                wrong.append((row["prod_reg_code"], row["date"], key, got, want))
    assert seen == len(index)
    assert not wrong, f"{len(wrong)} wrong, first {wrong[:5]}"


@pytest.mark.parametrize("name", sorted(METRICS))
def test_metric(nav, name):
    windows = [w for w in WINDOWS if w < 800] + [w for w in SMALL if w not in WINDOWS]
    periods = list(METRICS[name].periods) + (["current"] if METRICS[name].current else [])
    keys = metric_keys(name, windows, periods)
    result = metrics(nav, name, windows, periods, min_points=3)
    def expected(name, rows, i, key):
        return _expected(name, rows, i, key, 3)

    if "volatility" in name or name in ("mean_step_return", "annualized_sharpe_ratio"):
        def expected(name, rows, i, key):
            if name == "list_volatility":
                return None if key == "current" else brute.list_volatility(rows, i, key, 3)
            vol, step = brute.volatility(rows, i, key, min_points=3)
            if name == "annualized_sharpe_ratio":
                return None if not vol else brute.half_even((step * 365 - 0.015) / vol)
            return vol if name == "annualized_volatility" else step
    _check(result, name, keys, METRICS[name].prefix, expected)


def test_documented_ladder(nav):
    keys = metric_keys("annualized_volatility")
    result = metrics(nav, "annualized_volatility", ladder="documented")
    _check(result, "v", keys, "Volatility", lambda n, r, i, k: brute.volatility(r, i, k, "documented")[0])


@pytest.mark.parametrize("name", ["max_drawdown", "drawdown", "annualized_calmer_ratio", "annualized_volatility"])
def test_many_small_series(spark, name):
    """Block borders, ties and zeros at every offset: 60 series of few distinct values."""
    rng = random.Random(7)
    many = {
        f"S{k}": _series(100 + k, rng.randint(1, 70), [1, 1, 2, 11], lambda r, top=rng.randint(1, 4): r.randint(0, top))
        for k in range(60)
    }
    rows = [(p, d, v) for p, series in many.items() for d, v in series]
    nav = spark.createDataFrame(rows, "prod_reg_code string, date date, net_val double")
    keys = metric_keys(name, [1, 2, 3, 4, 5, 6, 8, 9, 16, 26, 27, 40, 64, 0])
    result = metrics(nav, name, [k for k in keys if isinstance(k, int)], min_points=2)
    wrong = []
    for row in result.collect():
        series = many[row["prod_reg_code"]]
        i = [d for d, _ in series].index(row["date"])
        for key in keys:
            if name == "annualized_volatility":
                want = brute.volatility(series, i, key, min_points=2)[0]
            else:
                want = _expected(name, series, i, key, 2)
            got = row[f"{METRICS[name].prefix}_{key}D"]
            if not _same(got, want):
                wrong.append((row["prod_reg_code"], row["date"], key, got, want))
    assert not wrong, f"{len(wrong)} wrong, first {wrong[:5]}"


def test_invariants(nav):
    """A longer look-back never shows a smaller decline, and counts follow the position."""
    windows = [7, 14, 30, 91]
    table = metrics(nav, ["max_drawdown", "valuation_count"], windows, ["month"])
    rows = sorted(table.collect(), key=lambda r: (r["prod_reg_code"], r["date"]))
    position = {}
    for row in rows:
        i = position[row["prod_reg_code"]] = position.get(row["prod_reg_code"], -1) + 1
        assert [row[f"Count_{n}D"] for n in windows] == [min(i, n) + 1 for n in windows]
        found = [row[f"Max_drawdown_{n}D"] for n in windows]
        values = [f["value"] for f in found if f is not None]
        assert values == sorted(values, reverse=True) and all(v <= 0 for v in values)


@pytest.mark.parametrize("name", ["annualized_volatility", "list_volatility"])
def test_volatility_at_any_date(spark, nav, name):
    """Requested days before, between and after the rows, some of them asked for twice."""
    asked = [
        (p, rows[0][0] + timedelta(days=k)) for p, rows in SERIES.items() for k in (-3, 0, 17, 45, 45, 200, 431, 900)
    ]
    wanted = spark.createDataFrame(asked, "prod_reg_code string, end_date date")
    keys = metric_keys(name)
    found = volatility_at(nav, wanted, name).collect()
    assert len(found) == len(set(asked))
    for row in found:
        rows = [r for r in SERIES[row["prod_reg_code"]] if r[0] <= row["end_date"]]
        assert row["date"] == (rows[-1][0] if rows else None)
        for key in keys:
            got, want = row[f"Volatility_{key}D"], None
            same = isinstance(key, int) or (
                rows and brute.anchor(rows[-1][0], key) == brute.anchor(row["end_date"], key))
            if rows and same:
                i = len(rows) - 1
                want = brute.volatility(rows, i, key)[0] if name.startswith("a") else brute.list_volatility(rows, i, key)
            assert _same(got, want), (row["prod_reg_code"], row["end_date"], key, got, want)
