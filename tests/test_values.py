"""Hand-computed values on a short series with gaps, ties and month ends, and the small helpers."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from navspan.functions import dates, keys
from navspan.functions.numeric import drawdown_text, python_text, round_even
from navspan.plans import registry
from navspan.plans.lookups import metric_at
from navspan.plans.registry import all_indicators, metric_columns, metrics, sql_metric
from navspan.session import DEFAULTS, session_settings
from navspan.sources import jdbc, packed

SERIES = {
    "20240129": 100, "20240130": 102, "20240131": 102, "20240201": 99, "20240202": 101, "20240205": 101,
    "20240206": 105, "20240209": 104, "20240229": 110, "20240301": 108, "20240304": 108, "20240305": 112,
}


@pytest.fixture(scope="module")
def example(spark):
    text = ",".join(f"{day}^{value}" for day, value in SERIES.items())
    return packed.parse_packed(spark.createDataFrame([("P", text)], "prod_reg_code string, packed string"))


def _at(df, day):
    return df.filter(F.col("date") == F.lit(day).cast("date")).collect()[0]


def test_returns(example):
    table = metrics(example, "annualized_return")
    assert table.columns[2:] == [f"Returns_{k}D" for k in (7, 14, 30, 91, 182, 365, 730, 1095, 0)] + [
        "Returns_monthD", "Returns_quarterD", "Returns_yearD", "Returns_currentD"]
    assert _at(table, "2024-02-09")["Returns_7D"] == 1.3273  # 4 % in 11 days
    assert _at(table, "2024-02-06")["Returns_monthD"] == 1.7892  # 3 / 102 in 6 days
    assert _at(table, "2024-03-04")["Returns_currentD"] == 0.0
    assert _at(table, "2024-01-29")["Returns_0D"] is None


def test_counts(example):
    table = metrics(example, "valuation_count")
    assert _at(table, "2024-02-09")["Count_7D"] == 8
    assert _at(table, "2024-03-05")["Count_monthD"] == 4
    assert _at(table, "2024-03-05")["Count_0D"] == 12


def test_drawdowns(example):
    found = _at(metrics(example, "max_drawdown", [0, 7], [], as_text=True), "2024-02-05")
    assert found["Max_drawdown_0D"] == "-0.0294(S:20240130,T:20240201,DRD:2)"
    early = _at(metrics(example, "max_drawdown", [7], [], as_text=True), "2024-01-31")
    assert early["Max_drawdown_7D"] == "None(S:None,T:None,DRD:None)"
    assert _at(metrics(example, "drawdown", [0], []), "2024-02-06")["Drawdown_0D"] == 0.0294


def test_values_below_zero(spark):
    rows = [("A", date(2024, 1, d), v) for d, v in ((1, 3.0), (2, -1.0), (3, -2.0), (4, 3.0))]
    table = spark.createDataFrame(rows, "prod_reg_code string, date date, net_val double")
    for name, column in (("max_drawdown", "Max_drawdown_0D"), ("drawdown", "Drawdown_0D"), ("annualized_calmer_ratio", "Calmer_0D")):
        assert [r[column] for r in metrics(table, name, [0], []).orderBy("date").collect()][1:] == [None] * 3


def test_calmar_is_null_without_decline(example):
    assert _at(metrics(example, "annualized_calmer_ratio", [0], []), "2024-01-31")["Calmer_0D"] is None


def test_metric_at(example):
    """At any date, as text or not: the numbers of the last row by then, from few rows."""
    ends = {"20240206": "2024-02-06", "2024-02-20": "2024-02-09", date(2024, 3, 31): "2024-03-05"}
    cases = [("annualized_volatility", 3), ("strict_return", "quarter"), ("max_drawdown", 3), ("drawdown", "month"),
             ("annualized_calmer_ratio", "current"), ("range_count", 0)]
    for k, (name, key) in enumerate(cases):
        end, day = list(ends.items())[k % 3]
        keys = ([key], []) if isinstance(key, int) else ([], [key])
        row = metric_at(example, end, name, key, products="P", min_points=2).collect()
        want = _at(metrics(example, name, *keys, min_points=2), day)
        assert len(row) == 1 and row[0].asDict() == want.asDict(), (name, key, end)
    assert metric_at(example, "2024-04-02", "valuation_count", "month").collect()[0]["Count_monthD"] is None
    assert metric_at(example, "20240128", "valuation_count", 7).count() == 0
    assert metric_at(example, "20240305", "valuation_count", "month", products=["Q"]).count() == 0


def test_look_back_sorts_few_rows(example):
    plan = metric_at(example, "20240305", "annualized_volatility", 30)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_variants_in_one_run(example):
    table = metrics(example, ["annualized_return", "strict_return"], [7], ["month"], prefixes={"strict_return": "Strict"})
    assert table.columns[2:] == ["Returns_7D", "Returns_monthD", "Strict_7D", "Strict_monthD"]
    assert table._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(prod_reg_code") == 1


def test_shared_columns_change_nothing(example):
    wide = {r["date"]: r for r in all_indicators(example, [3, 0], ["month"], min_points=2).collect()}
    for name in registry.INDICATORS:
        for row in metrics(example, name, [3, 0], ["month"], min_points=2).collect():
            assert all(wide[row["date"]][c] == v for c, v in row.asDict().items())


def test_own_metric(example):
    span = sql_metric("Span", lambda key: f"datediff(date, coalesce(_start_date_{key}, date))", lambda key: [("start", key)], (2,), ())
    table = metrics(example, ["valuation_count", "span"], [2], [], own={"span": span})
    assert _at(table, "2024-02-05")["Span_2D"] == 4 and _at(table, "2024-02-05")["Count_2D"] == 3


def test_catalog():
    assert {"annualized_return", "valuation_count", "annualized_volatility", "annualized_sharpe_ratio",
            "max_drawdown", "annualized_calmer_ratio", "drawdown"} <= set(registry.metric_catalog())
    assert metric_columns("annualized_volatility")[:2] == ["Volatility_30D", "Volatility_91D"]
    assert len(metric_columns("annualized_volatility")) == 10


def test_arguments_are_checked(example):
    for call in (
        lambda: metrics(example, "nothing"),
        lambda: metrics(example, "annualized_return", [-1]),
        lambda: metrics(example, "annualized_return", ["7"]),
        lambda: metrics(example, "annualized_return", [7], ["week"]),
        lambda: metrics(example, "annualized_volatility", [30], ["current"]),
        lambda: metrics(example, "annualized_return", [], []),
        lambda: metrics(example, ["annualized_return", "strict_return"]),
        lambda: metrics(example, "annualized_volatility", ladder="other"),
        lambda: dates.period_anchor("date", "week"),
        lambda: keys.check_window(True),
    ):
        with pytest.raises(ValueError):
            call()


def test_rounding(spark):
    values = [round_even("0.00025D"), round_even("-0.00001D"), round_even("2.5D", 0), round_even("double(NULL)")]
    row = spark.range(1).selectExpr(*values).collect()[0]
    assert tuple(row) == (0.0002, 0.0, 2.0, None)


def test_text_of_doubles(spark):
    values = [0.0, -0.0, -0.5, -0.0001, -0.875, -1.0, 12.3, -0.0102]
    rows = spark.createDataFrame([(v,) for v in values], "v double").selectExpr(python_text("v")).collect()
    assert sorted(r[0] for r in rows) == sorted(str(v) for v in values)


def test_drawdown_text_of_null(spark):
    empty = F.lit(None).cast("struct<value:double,s:date,t:date,drd:int>")
    df = spark.range(1).select(empty.alias("d")).selectExpr(drawdown_text("d"))
    assert df.collect()[0][0] == "None(S:None,T:None,DRD:None)"


def test_anchors(spark):
    day = "date'2024-05-17'"
    row = spark.range(1).selectExpr(
        *[dates.period_anchor(day, p) for p in ("month", "quarter", "year", "current")]
    ).collect()[0]
    assert tuple(row) == (date(2024, 4, 30), date(2024, 3, 31), date(2023, 12, 31), date(2024, 5, 16))


def test_session_settings():
    settings = session_settings({"app_name": "x", "shuffle_partitions": 5000, "warehouse_dir": "/w", "spark.a": 1})
    assert settings["spark.sql.shuffle.partitions"] == "5000"
    assert settings["spark.sql.warehouse.dir"] == "/w" and settings["spark.a"] == "1"
    assert DEFAULTS.items() <= settings.items()
    with pytest.raises(ValueError):
        session_settings({"unknown": 1})


def test_jdbc_options():
    config = {"url": "jdbc:x", "table": "t", "user": "u", "password": "p", "driver": "d"}
    assert jdbc.read_options({**config, "single_reader": True}) == {"url": "jdbc:x", "dbtable": "t", "user": "u", "password": "p", "driver": "d"}
    split = jdbc.read_options({**config, "split": ("date", "2020-01-01", "2025-01-01", 64)})
    assert split["partitionColumn"] == "date" and split["numPartitions"] == "64"
    written = jdbc.write_options({**config, "batchsize": 5})
    assert written["numPartitions"] == "100" and written["batchsize"] == "5" and "truncate" not in written
    assert jdbc.write_options({**config, "truncate": True})["truncate"] == "true"
    for wrong in ({"url": "jdbc:x", "single_reader": True}, config, {**config, "single_reader": True, "split": ("d", 0, 1, 2)}):
        with pytest.raises(ValueError):
            jdbc.read_options(wrong)
