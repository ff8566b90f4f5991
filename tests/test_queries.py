"""Every registered query against its SQL twin, and the plans they run."""

import re

import pytest

from __spark_entry__ import entry, queries
from compare import compare, connect
from navspan.plans.oracles import ORACLES
from navspan.plans.queries import QUERIES
from navspan.plans.registry import BUNDLE, METRICS, metrics
from navspan.sources.derived import nav_nation


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    problem, rows, _, _ = compare(spark, con, sf_dir, name)
    assert problem is None
    assert rows > 0


def test_entry(spark):
    assert entry(spark).count() > 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("names", [[n] for n in sorted(METRICS)] + [list(BUNDLE)])
def test_one_exchange_and_one_sort(spark, names):
    """Two sorts with sliding declines, which also look backwards; never a Python worker."""
    nav = spark.range(4).selectExpr(
        "string(id) AS prod_reg_code", "date_add(date'2024-01-01', int(id)) AS date", "double(id) AS net_val"
    )
    plan = _plan(metrics(nav, names))
    declines = names[0] in ("max_drawdown", "annualized_calmer_ratio")
    assert plan.count("Exchange hashpartitioning") == 1
    assert len(re.findall(r"\bSort \[", plan)) == (2 if declines else 1)
    assert "Python" not in plan and "Pandas" not in plan


def test_scan_reads_only_what_it_needs(spark, sf_dir):
    plan = _plan(metrics(nav_nation(spark, sf_dir), "annualized_return"))
    assert "struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp" in plan
    assert "IsNotNull(o_custkey)" in plan


def test_wide_rows_of_asof_metrics_are_exchanged_once(spark, sf_dir):
    """Above the windows there is no exchange: the rows asked for leave from where they were computed."""
    plan = _plan(queries()["volatility_asof"](spark, sf_dir))
    assert "Exchange" not in plan[: plan.index("Window")]
