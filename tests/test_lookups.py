"""Metrics at dates of the caller's choice: against definitions, with duplicates, and the plans they run."""

import re
from datetime import date, timedelta

import pytest

import brute
from navspan.plans.lookups import metric_at, metrics_at
from navspan.plans.registry import METRICS, metric_keys, metrics
from navspan.sources.derived import nav_nation
from test_metrics import SERIES, _expected, _same

NAV = "prod_reg_code string, date date, net_val double"


@pytest.fixture(scope="module")
def nav(spark):
    return spark.createDataFrame([(p, d, v) for p, series in SERIES.items() for d, v in series], NAV)


def test_many_metrics_at_many_dates(spark, nav):
    """Days before, between and after the rows, some asked for twice, and a product without rows."""
    names = ["annualized_return", "max_drawdown", "annualized_calmer_ratio", "drawdown", "range_count"]
    asked = [(p, rows[0][0] + timedelta(days=k)) for p, rows in SERIES.items() for k in (-400, -3, 0, 17, 45, 45, 200, 431, 900)]
    asked += [("nowhere", date(2024, 1, 1)), ("nowhere", date(2024, 1, 2)), ("daily", None)]
    wanted = spark.createDataFrame(asked, "prod_reg_code string, day date")
    windows, periods = (1, 5, 30, 0), ("month", "quarter", "year")
    found = metrics_at(nav, wanted, names, windows, periods, anchor="day", prefixes={"range_count": "Range"}).collect()
    assert len(found) == len({a for a in asked if a[1] is not None})
    for row in found:
        rows = [r for r in SERIES.get(row["prod_reg_code"], []) if r[0] <= row["day"]]
        assert row["date"] == (rows[-1][0] if rows else None)
        for name in names:
            for key in metric_keys(name, windows, periods):
                prefix = "Range" if name == "range_count" else METRICS[name].prefix
                same = isinstance(key, int) or rows and brute.anchor(rows[-1][0], key) == brute.anchor(row["day"], key)
                want = _expected(name, rows, len(rows) - 1, key) if rows and same else None
                got = row[f"{prefix}_{key}D"]
                assert _same(got, want), (row["prod_reg_code"], row["day"], name, key, got, want)


def test_series_is_read_once(spark, sf_dir):
    """One scan of the series and one exchange of its rows; the anchors' own are those of their table."""
    nav = nav_nation(spark, sf_dir)
    anchors = spark.createDataFrame([("FRANCE", date(1996, 6, 28))], "prod_reg_code string, end_date date")
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (
        metrics(nav, "list_volatility"), metrics_at(nav, anchors, ["list_volatility", "annualized_return", "drawdown", "annualized_calmer_ratio"]))]
    series, asked = plans
    assert asked.count("FileScan") == series.count("FileScan")
    # The daily averages', the one of series and anchors, and that of the distinct anchors.
    assert asked.count("Exchange hashpartitioning") == series.count("Exchange hashpartitioning") + 1
    assert "Python" not in asked.replace("PythonRDD", "") or "Scan ExistingRDD" in asked


@pytest.mark.parametrize("name, key", [("annualized_return", 1), ("annualized_return", 5), ("drawdown", 3), ("annualized_return", 0), ("strict_return", "month"), ("range_count", "current"), ("max_drawdown", "year")])
@pytest.mark.parametrize("order", [1, -1])
def test_second_row_of_a_date_is_an_error(spark, name, key, order):
    rows = [("A", date(2024, 1, 2), 1.0), ("A", date(2024, 1, 2), 2.0), ("A", date(2024, 1, 3), 3.0)][::order]
    raw = spark.createDataFrame(rows, NAV).coalesce(1)
    with pytest.raises(Exception, match="two rows on one date"):
        metric_at(raw, "20240103", name, key).collect()
    anchors = spark.createDataFrame([("A", date(2024, 1, 4))], "prod_reg_code string, end_date date")
    with pytest.raises(Exception, match="two rows on one date"):
        metrics_at(raw, anchors, name, [key] if isinstance(key, int) else [], [] if isinstance(key, int) else [key]).collect()


def test_rows_without_a_date_are_an_error(spark):
    rows = spark.createDataFrame([("A", None, 1.0), ("A", date(2024, 1, 2), 2.0)], NAV)
    anchors = spark.createDataFrame([("A", date(2024, 1, 4))], "prod_reg_code string, end_date date")
    with pytest.raises(Exception, match="one without"):
        metrics(rows, "annualized_return").collect()
    with pytest.raises(Exception, match="without a date"):
        metrics_at(rows, anchors, "annualized_return").collect()


def test_point_lookup_cuts_rows_before_the_exchange(nav):
    plan = metric_at(nav, "20240103", "annualized_return", 30)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("WindowGroupLimit", plan)) == 2
