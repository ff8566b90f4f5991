"""Look-ups from stored summaries: against the series' own, against definitions, and what they read."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from navspan.operators import summaries
from navspan.operators.tables import join_metrics, join_stored
from navspan.plans.lookups import metric_at
from navspan.plans.stored import drawdown_between, stored_metric_at, write_summaries
from navspan.plans.registry import metrics
from navspan.sources.files import write_bucketed
from test_metrics import SERIES

NAV = "prod_reg_code string, date date, net_val double"
MORE = {**SERIES, "below": [(date(2024, 1, 1) + timedelta(days=k), v) for k, v in enumerate([2.0, 1.0, -1.0, 3.0, 2.5])]}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    nav = spark.createDataFrame([(p, d, v) for p, series in MORE.items() for d, v in series], NAV)
    path = str(tmp_path_factory.mktemp("stored"))
    write_summaries(nav, path, radix=3)
    return nav, path


@pytest.mark.parametrize("name, window", [
    ("strict_return", 30), ("valuation_count", 14), ("annualized_volatility", 5),
    ("annualized_volatility", 0), ("annualized_sharpe_ratio", 91), ("max_drawdown", 30), ("max_drawdown", 0),
    ("annualized_calmer_ratio", 14), ("drawdown", 7), ("drawdown", 0)])
def test_same_as_from_the_series(spark, stored, name, window):
    nav, path = stored
    for day in ("20220410", "20240218", "19000101"):
        want = {r["prod_reg_code"]: (r["date"], r[2]) for r in metric_at(nav, day, name, window, min_points=4).collect()}
        got = {r["prod_reg_code"]: (r["date"], r[2]) for r in stored_metric_at(spark, path, day, name, window, min_points=4).collect()}
        assert set(got) == set(want)
        for product, (on, value) in want.items():
            assert got[product][0] == on
            if isinstance(value, float):
                assert got[product][1] == pytest.approx(value, rel=1e-9, abs=1e-9), (product, day)
            else:
                assert got[product][1] == value, (product, day)


def brute_decline(rows):
    if not rows or min(v for _, v in rows) < 0:
        return (None, None, None, None, len(rows))
    peak = best = None
    for day, value in rows:
        if peak is None or value > peak[1]:
            peak = day, value
        fall = (value - peak[1]) / peak[1] if peak[1] > 0 else 0.0
        if fall < 0 and (best is None or fall < best[0]):
            best = fall, peak[0], day
    fall, s, t = best or (0.0, rows[0][0], rows[-1][0])
    return (round(fall * 1e4) / 1e4, s, t, (t - s).days, len(rows))


def test_drawdown_between(spark, stored):
    draw = random.Random(1)
    requests = [("nowhere", date(2024, 1, 1), date(2024, 2, 1)), ("daily", None, date(2024, 1, 1)), ("daily", date(2022, 1, 1), None), (None, date(2024, 1, 1), date(2024, 2, 1))]
    for product, rows in MORE.items():
        for _ in range(25):
            start = draw.choice(rows)[0] + timedelta(days=draw.randint(-9, 9))
            requests.append((product, start, start + timedelta(days=draw.choice([-1, 0, 1, 5, 30, 90, 400, 5000]))))
    requests += requests[:9]
    df = spark.createDataFrame(requests, "prod_reg_code string, start date, end date").withColumn("rows_asked", F.lit("x"))
    _, path = stored
    found = drawdown_between(spark, path, df).collect()
    assert len(found) == len(requests)
    for r in found:
        inside = [x for x in MORE.get(r["prod_reg_code"], []) if r["start"] and r["end"] and r["start"] <= x[0] <= r["end"]]
        assert (r["value"], r["s"], r["t"], r["drd"], r["rows"]) == brute_decline(inside), r


def test_rows_read(spark, tmp_path):
    """A look-back of 1,095 of 20,000 rows takes at most 14 summaries of each of the levels that it spans."""
    nav = spark.range(20_000).selectExpr("'A' AS prod_reg_code", "date_add(date'1970-01-01', int(id)) AS date", "1D + pmod(id * 37, 101) AS net_val")
    path = str(tmp_path)
    write_summaries(nav, path)
    rows = spark.createDataFrame([("A", 15_000 - 1_094, 15_000)], "prod_reg_code string, _lo long, _hi long")
    wanted = summaries.needed_blocks(spark, path, rows)
    spans = summaries.spans(wanted)
    assert set(spans) == {0, 1, 2, 3} and wanted.count() <= 4 * 14
    read = summaries.stored_blocks(spark, path, spans)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(block" in plan and "LessThanOrEqual(block" in plan
    assert sum(r["block"] * 8 ** r["level"] <= 15_000 for r in wanted.collect()) == wanted.count()
    want = metric_at(nav, date(2011, 1, 26), "annualized_volatility", 1095).collect()
    assert stored_metric_at(spark, path, date(2011, 1, 26), "annualized_volatility", 1095).collect() == want


def test_duplicates_and_no_rows(spark, tmp_path):
    twice = spark.createDataFrame([("A", date(2024, 1, 2), 1.0), ("A", date(2024, 1, 2), 2.0)], NAV)
    with pytest.raises(Exception, match="two rows on one date"):
        write_summaries(twice, str(tmp_path / "a"))
    path = str(tmp_path / "b")
    write_summaries(twice.limit(0), path)
    assert stored_metric_at(spark, path, "20240101", "annualized_return", 7).count() == 0
    requests = spark.createDataFrame([("A", date(2024, 1, 2), date(2024, 1, 3))], "prod_reg_code string, start date, end date")
    assert [tuple(r)[3:] for r in drawdown_between(spark, path, requests).collect()] == [(None, None, None, None, 0)]


def test_stored_tables_join_where_they_are(spark, stored):
    """Two tables bucketed by product: no exchange at all; two computed in one session: none at the join."""
    nav, _ = stored
    names = []
    for name in ("annualized_return", "valuation_count", "drawdown"):
        names.append(f"apart_{name}")
        write_bucketed(metrics(nav, name, (7,), ()), names[-1], 4)
    tables = [spark.table(n) for n in names]
    two = join_stored(*tables[:2])
    assert "Exchange" not in two._jdf.queryExecution().executedPlan().toString()
    joined = join_stored(*tables)
    assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange") <= 2
    assert joined.count() == nav.count() and joined.where("Count_7D IS NULL").count() == 0
    assert set(joined.collect()) == set(join_metrics(*tables).select(*joined.columns).collect())
    computed = join_metrics(metrics(nav, "annualized_return", (7,), ()), metrics(nav, "valuation_count", (7,), ()))
    assert computed._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
