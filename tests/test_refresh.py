"""A run in steps equals the run over the whole series, and never reads the history."""

from datetime import date

import pytest

from navspan.plans.refresh import next_state, refreshed, state_of
from navspan.plans.registry import metrics
from test_metrics import SERIES, _same

NAV = "prod_reg_code string, date date, net_val double"
NAMES = ["annualized_return", "valuation_count", "annualized_volatility", "max_drawdown", "drawdown", "strict_return", "list_volatility"]
PREFIXES = {"strict_return": "Strict", "list_volatility": "List"}
KEYS = ((1, 7, 30, 0), ("month", "quarter", "year"))
SERIES = {**SERIES, "below": [(date(2022, 1, 1 + k), v) for k, v in enumerate([2.0, -1.0, 1.0, 3.0, 2.5, 4.0])]}


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Rows of a first run, of two refreshes and of one run over all; borders that split years, months and short series."""
    rows = [(p, d, v) for p, series in SERIES.items() for d, v in series]
    borders = [date(2022, 1, 3), date(2022, 5, 20)]
    folder = str(tmp_path_factory.mktemp("states"))
    batches = [[r for r in rows if (i == 0 or r[1] > borders[i - 1]) and (i == 2 or r[1] <= borders[i])] for i in range(3)]
    first, second, third = (spark.createDataFrame(b, NAV) for b in batches)
    found = metrics(first, NAMES, *KEYS, prefixes=PREFIXES).collect()
    state_of(first, 30).write.parquet(f"{folder}/1")
    state = spark.read.parquet(f"{folder}/1")
    found += refreshed(state, second, NAMES, *KEYS, prefixes=PREFIXES).collect()
    next_state(state, second, 30).write.parquet(f"{folder}/2")
    found += refreshed(spark.read.parquet(f"{folder}/2"), third, NAMES, *KEYS, prefixes=PREFIXES).collect()
    return found, metrics(spark.createDataFrame(rows, NAV), NAMES, *KEYS, prefixes=PREFIXES).collect(), folder


def test_same_as_the_whole(steps):
    found, whole, _ = steps
    want = {(r["prod_reg_code"], r["date"]): r for r in whole}
    assert len(found) == len(want)
    for r in found:
        other = want[r["prod_reg_code"], r["date"]]
        for column in r.asDict():
            if column not in ("prod_reg_code", "date"):
                assert _same(r[column], other[column]), (r["prod_reg_code"], r["date"], column, r[column], other[column])


def test_state_is_short(spark, steps):
    """At most the longest look-back and one row, or the last calendar year and the row before."""
    counts = spark.read.parquet(f"{steps[2]}/2").groupBy("prod_reg_code").count().collect()
    assert all(r["count"] <= 367 for r in counts)
    rows = {p: [d for d, _ in series if d <= date(2022, 5, 20)] for p, series in SERIES.items()}
    for r in counts:
        days = rows[r["prod_reg_code"]]
        assert r["count"] <= max(31, sum(d.year == days[-1].year for d in days) + 1)


def test_history_is_not_read(spark, steps, tmp_path):
    new = str(tmp_path / "new")
    spark.createDataFrame([("daily", date(2030, 1, 1), 1.0)], NAV).write.parquet(new)
    plan = refreshed(spark.read.parquet(f"{steps[2]}/2"), spark.read.parquet(new), NAMES, *KEYS, prefixes=PREFIXES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "/2" in plan and "/new" in plan
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


def test_refusals(spark, steps):
    state = spark.read.parquet(f"{steps[2]}/1")
    with pytest.raises(ValueError, match="up to 30"):
        refreshed(state, spark.createDataFrame([], NAV), "annualized_return", (31,))
    for day in (date(2021, 12, 1), SERIES["daily"][61][0]):
        with pytest.raises(Exception, match="not after the known ones"):
            refreshed(state, spark.createDataFrame([("daily", day, 1.0)], NAV), "annualized_return", (7,)).collect()
    twice = spark.createDataFrame([("daily", date(2030, 1, 1), 1.0), ("daily", date(2030, 1, 1), 2.0)], NAV)
    with pytest.raises(Exception, match="two rows on one date"):
        refreshed(state, twice, "annualized_return", (7,)).collect()
    assert refreshed(state, spark.createDataFrame([], NAV), "drawdown", (7,)).count() == 0
    assert state_of(spark.createDataFrame([], NAV)).count() == 0
