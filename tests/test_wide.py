"""Runs of all families: declines that ride on the levels of the moments, and what their steps carry and compile."""

import datetime
import random
import re

import brute
import pytest

from navspan.functions.fixed import DATE, PRODUCT, VALUE
from navspan.plans.registry import all_indicators, metrics

LOOK_BACKS = (1, 2, 7, 8, 26, 53, 80)


def _series(values):
    day, rows = datetime.date(2020, 1, 1), []
    for i, value in enumerate(values):
        rows.append((day, float(value)))
        day += datetime.timedelta(days=1 + i % 3)
    return rows


def _walk(seed, n):
    rng, value = random.Random(seed), 10.0
    for _ in range(n):
        value = max(0.5, value * (1 + rng.gauss(0, 0.03)))
        yield value


SERIES = {
    "walk": _series(_walk(1, 190)),
    "ties": _series(random.Random(2).choices([1, 2, 3], k=120)),
    "zeros": _series(random.Random(3).choices([0, 1, 2], k=90)),
    "flat": _series([5] * 30),
    "fall": _series(range(100, 60, -1)),
    "one": _series([4]),
}


@pytest.fixture(scope="module")
def nav(spark):
    rows = [(p, day, value) for p, found in SERIES.items() for day, value in found]
    return spark.createDataFrame(rows, f"{PRODUCT} string, {DATE} date, {VALUE} double").cache()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_declines_beside_moments(nav):
    """Value, days and length of the deepest decline of every look-back, by trying every pair of rows."""
    found = metrics(nav, ["annualized_volatility", "max_drawdown"], LOOK_BACKS, ["month"], min_points=1)
    rows = {(r[PRODUCT], r[DATE]): r for r in found.collect()}
    assert len(rows) == sum(map(len, SERIES.values()))
    for product, series in SERIES.items():
        for i, (day, _) in enumerate(series):
            for key in (*LOOK_BACKS, "month"):
                got, want = rows[product, day][f"Max_drawdown_{key}D"], brute.max_drawdown(series, i, key, 1)
                assert (got and tuple(got)) == want, (product, day, key)


def test_ratios_beside_moments(nav):
    """Calmar ratios without days of a decline, next to those of a run that looks backwards in blocks."""
    both = metrics(nav, ["annualized_volatility", "annualized_calmer_ratio"], LOOK_BACKS, ["month"], min_points=3)
    alone = metrics(nav, "annualized_calmer_ratio", LOOK_BACKS, ["month"], min_points=3)
    assert sorted(both.select(*alone.columns).collect(), key=str) == sorted(alone.collect(), key=str)


def test_all_families_take_one_sort_and_carry_no_arrays_through_the_levels(nav):
    """A further sort and an array for each look-back, copied by every step, took most of a run's time."""
    plan = _plan(all_indicators(nav))
    assert plan.count("Exchange hashpartitioning") == 1
    assert len(re.findall(r"\bSort \[", plan)) == 1
    assert "_tail_" not in plan


def test_methods_are_held_to_what_the_jvm_compiles(spark, nav):
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    try:
        for given, held in (("65535", "8000"), ("8000", "8000"), ("4000", "4000")):
            spark.conf.set(name, given)
            metrics(nav, "valuation_count", [7], [])
            assert spark.conf.get(name) == held
    finally:
        spark.conf.set(name, before)
