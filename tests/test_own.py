"""Metrics of the user's own over sliding frames."""

import pytest

from navspan.operators.sliding import Monoid
from navspan.plans.queries import QUERIES
from navspan.plans.registry import frame_metric, metrics
from test_metrics import SERIES

NAV = "prod_reg_code string, date date, net_val double"


def test_text_of_a_frame(spark):
    """The values of a frame joined in order: an aggregate that shows every row and its place."""
    nav = spark.createDataFrame([(p, d, v) for p, series in SERIES.items() for d, v in series[:40]], NAV)
    joined = Monoid("joined", {"t": "concat(string(net_val), ',')"}, {"t": "''"}, lambda a, b: {"t": f"concat({a}_t, {b}_t)"})
    last = Monoid("last", {"v": "net_val"}, {"v": "NULL"}, lambda a, b: {"v": f"coalesce({b}_v, {a}_v)"}, steps=True)
    windows = (1, 2, 3, 5, 7, 8, 30, 63)
    own = {
        "joined": frame_metric("Joined", joined, lambda frame, n: f"{frame}_t", windows),
        "last": frame_metric("Last", last, lambda frame, n: f"{frame}_v", windows),
    }
    found = metrics(nav, ["joined", "last", "annualized_volatility"], windows, (), own=own).collect()
    for r in found:
        series = SERIES[r["prod_reg_code"]][:40]
        i = [d for d, _ in series].index(r["date"])
        for n in windows:
            assert r[f"Joined_{n}D"] == "".join(f"{v}," for _, v in series[max(0, i - n) : i + 1])
            assert r[f"Last_{n}D"] == series[i][1]


def test_plan_has_no_python(spark, sf_dir):
    plan = QUERIES["downside_deviation"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_look_backs_only(spark):
    nav = spark.createDataFrame([], NAV)
    own = {"n": frame_metric("N", Monoid("n", {"n": "1"}, {"n": "0"}, lambda a, b: {"n": f"{a}_n + {b}_n"}), lambda frame, n: f"{frame}_n")}
    assert metrics(nav, "n", own=own).count() == 0
    for windows, periods in (((0,), ()), ((7,), ("year",))):
        with pytest.raises(ValueError, match="look-backs"):
            metrics(nav, "n", windows, periods, own=own)
