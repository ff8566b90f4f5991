from datetime import date

import pytest
from pyspark.sql import functions as F

from navspan.operators import asof, tables
from navspan.plans.registry import metrics, step_returns
from navspan.sources import derived, files, nav, packed

NAV = "prod_reg_code string, date date, net_val double"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_normalize_drops_what_cannot_be_read(spark):
    raw = spark.createDataFrame(
        [("A", "2024-01-02", "1.5"), ("A", "soon", "1"), ("A", "2024-01-03", "much"), (None, "2024-01-02", "1"),
         ("B", None, "1"), ("B", "2024-01-02", None), ("B", "2024-01-05 10:00:00", "2"), ("C", "2024-01-01", "NaN")],
        "prod_reg_code string, date string, net_val string",
    )
    found = nav.normalize(raw)
    assert found.dtypes == [("prod_reg_code", "string"), ("date", "date"), ("net_val", "double")]
    assert _rows(found) == [("A", date(2024, 1, 2), 1.5), ("B", date(2024, 1, 5), 2.0)]


def test_duplicates(spark):
    raw = spark.createDataFrame(
        [("A", date(2024, 1, 2), 1.0, 1), ("A", date(2024, 1, 2), 2.0, 2), ("A", date(2024, 1, 3), 3.0, 3)],
        NAV + ", n int",
    )
    assert _rows(nav.one_row_per_day(raw, "first", "n"))[0][2] == 1.0
    assert _rows(nav.one_row_per_day(raw, "last", "n"))[0][2] == 2.0
    anchors = raw.select("prod_reg_code", F.col("date").alias("anchor"))
    checked = nav.one_row_per_day(raw)
    counted, returned = metrics(raw, "valuation_count", [7], []), metrics(raw, "annualized_return", [7], [])
    declines = metrics(raw, ["max_drawdown", "valuation_count"], [7], [])
    for wrong in (
        checked, checked.select("date"), checked.groupBy().count(), metrics(checked, "valuation_count", [7], []),
        counted, counted.select("Count_7D"), counted.groupBy().count(),
        returned.groupBy("prod_reg_code").agg(F.max("Returns_7D")),
        declines, declines.select("Count_7D"), declines.groupBy().count(),
        step_returns(raw).select("step"), step_returns(raw).groupBy().count(),
        asof.asof_rows(raw, anchors), asof.forward_rows(raw, anchors).groupBy().count(),
        tables.in_order(raw, lambda state, day, value: (state, (value,)), None, "same double"), packed.pack(raw),
    ):
        with pytest.raises(Exception, match="two rows on one date"):
            wrong.collect()
    assert len(_rows(nav.one_row_per_day(raw.filter("n > 1")))) == 2
    # A filter on the date takes no check away and raises none.
    once, day = raw.filter("n > 1"), F.col("date") == F.lit("2024-01-02").cast("date")
    assert metrics(once, "valuation_count", [7], []).filter(day).count() == 1
    assert metrics(once, ["max_drawdown", "valuation_count"], [7], []).filter(day).count() == 1
    assert step_returns(once).filter(day).count() == 1
    assert asof.asof_rows(once, anchors).filter("anchor = date'2024-01-03'").count() == 1
    for wrong in (("last", None), ("error", "n"), ("any", None)):
        with pytest.raises(ValueError):
            nav.one_row_per_day(raw, *wrong)


def test_filters(spark):
    table = spark.createDataFrame([("A", date(2024, 1, d), 1.0) for d in range(1, 9)] + [("B", date(2024, 1, 1), 1.0)], NAV)
    assert nav.filter_dates(table, "20240102", date(2024, 1, 4)).count() == 3
    assert nav.filter_product(table, "B").count() == 1
    assert _rows(nav.products(table)) == [("A",), ("B",)]


def test_packed(spark):
    text = "20240103^3,20240101^1.5,20240102^2,20240101^9"
    df = spark.createDataFrame([("A", text), ("B", "20240101^7")], "prod_reg_code string, packed string")
    want = [("A", date(2024, 1, 1), 9.0), ("A", date(2024, 1, 2), 2.0), ("A", date(2024, 1, 3), 3.0),
            ("B", date(2024, 1, 1), 7.0)]
    rows = packed.parse_packed(df)
    assert _rows(rows) == want
    assert _rows(packed.parse_packed(packed.pack(rows))) == want
    maps = {r["prod_reg_code"]: r["nav"] for r in packed.parse_packed_map(df).collect()}
    assert maps["A"] == {"20240101": 9.0, "20240102": 2.0, "20240103": 3.0}
    assert "Exchange" not in packed.parse_packed_map(df)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("text", ["20240101", "20240101^1^2", "20240101^x", "2024^1", ""])
def test_packed_rejects_other_entries(spark, text):
    df = spark.createDataFrame([("A", text)], "prod_reg_code string, packed string")
    with pytest.raises(Exception):
        packed.parse_packed(df).collect()


def test_fan_out(spark):
    df = spark.createDataFrame([("20240101^1,20240101^2",)], "packed string")
    assert _rows(packed.fan_out(df)) == [(p, date(2024, 1, 1), v) for p in ("P001", "P002") for v in (1, 2)]
    with pytest.raises(Exception):
        packed.fan_out(spark.createDataFrame([("20240101^1.5",)], "packed string")).collect()


def test_lookups(spark):
    table = spark.createDataFrame([("A", date(2024, 1, d), float(d)) for d in (5, 10, 20)], NAV)
    wanted = spark.createDataFrame(
        [("A", date(2024, 1, d)) for d in (1, 5, 12, 12, 25)] + [("B", date(2024, 1, 1))],
        "prod_reg_code string, anchor date",
    )
    back = {r["anchor"].day: r["net_val"] for r in asof.asof_rows(table, wanted).filter("prod_reg_code = 'A'").collect()}
    assert back == {1: 5.0, 5: 5.0, 12: 10.0, 25: 20.0}
    ahead = {r["anchor"].day: r["net_val"] for r in asof.forward_rows(table, wanted).filter("prod_reg_code = 'A'").collect()}
    assert ahead == {1: 5.0, 5: 5.0, 12: 20.0, 25: None}
    assert asof.asof_rows(table, wanted).filter("prod_reg_code = 'B'").collect()[0]["net_val"] is None


def test_tables(spark):
    table = spark.createDataFrame([("A", date(2024, 1, d), float(d)) for d in (5, 10, 20)], NAV)
    returns = metrics(table, "annualized_return")
    empty = spark.createDataFrame([], returns.schema)
    assert tables.union_products([], empty).columns == returns.columns
    assert tables.union_products([returns, returns], empty).count() == 6
    assert tables.first_columns(returns, "date").columns[:2] == ["date", "prod_reg_code"]
    assert tables.with_constant(returns, "other", None, "double").schema["other"].dataType.typeName() == "double"
    assert tables.report(returns).dtypes[2:] == [(n, "float") for n in (
        "d7_returns", "d14_returns", "m1_returns", "m3_returns", "m6_returns", "y1_returns")]
    pairs = tables.nested(returns, ["Returns_7D", "Returns_currentD"]).filter("date = '20240110'").collect()[0]["values"]
    assert [p["name"] for p in pairs] == ["Returns_7D", "Returns_currentD"]
    joined = tables.join_metrics(returns.filter("day(date) < 20"), metrics(table, "valuation_count").filter("day(date) > 5"))
    assert joined.count() == 3


def test_files(spark, tmp_path):
    table = spark.createDataFrame([("A", date(2024, 1, 5), 1.0)], NAV)
    files.write_files(table, str(tmp_path / "out"))
    assert _rows(spark.read.parquet(str(tmp_path / "out"))) == _rows(table)


def test_daily_average_is_exact(spark):
    raw = spark.createDataFrame(
        [("A", date(2024, 1, 1), v) for v in (0.01, 0.02)] + [("A", date(2024, 1, 2), None)] * 2,
        "k string, d date, v double",
    )
    assert _rows(derived.daily_average(raw, "k", "d", "v")) == [("A", date(2024, 1, 1), 0.02)]
    assert derived.daily_average(raw.filter(F.col("v").isNotNull()), "k", "d", "v").count() == 1


def test_bucketed_table_needs_no_exchange(spark):
    table = spark.createDataFrame([(p, date(2024, 1, d), float(d)) for p in "ABC" for d in (5, 10, 20)], NAV)
    files.write_bucketed(table, "nav_bucketed", 4)
    stored = spark.table("nav_bucketed")
    found = metrics(stored, "valuation_count", partitions=None)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert _rows(found) == _rows(metrics(table, "valuation_count"))
    spark.sql("DROP TABLE nav_bucketed")


def test_hot_product_combines_before_the_exchange(spark):
    """A product with a third of all rows, thousands a day: one row per day and task is shuffled."""
    raw = spark.range(90000, numPartitions=6).selectExpr(
        "if(id % 3 = 0, 'HOT', concat('P', id % 997)) AS prod_reg_code",
        "date_add(date'2024-01-01', int(id % 7)) AS date", "double(id) AS net_val", "id AS n",
    )
    kept = nav.one_row_per_day(raw, "last", "n")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange hashpartitioning") == 1
    hot = {r["date"].day: r["net_val"] for r in kept.filter("prod_reg_code = 'HOT'").collect()}
    assert hot == {k % 7 + 1: float(max(i for i in range(89900, 90000) if i % 3 == 0 and i % 7 == k % 7)) for k in range(7)}


def test_large_joins_shuffle_and_agree(spark, sf_dir):
    """Above the broadcast limit the joins sort-merge, with the same series."""
    want = _rows(derived.nav_nation(spark, sf_dir))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = derived.nav_nation(spark, sf_dir)
        assert "SortMergeJoin" in found._jdf.queryExecution().executedPlan().toString()
        assert _rows(found) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_failed_write_leaves_the_table_and_can_be_repeated(spark, tmp_path):
    """Whole months are replaced, others stay; a run that fails half-way changes nothing."""
    path = str(tmp_path / "metrics")
    days = spark.range(120).selectExpr("'A' AS prod_reg_code", "date_add(date'2024-01-01', int(id)) AS date", "1D AS net_val")
    files.write_dates(days, path)
    later = days.where("date >= date'2024-02-01' AND date < date'2024-04-01'").withColumn("net_val", F.lit(2.0)).repartition(4)
    broken = later.withColumn("net_val", F.when(F.col("date") == "2024-03-20", F.raise_error(F.lit("stopped")).cast("double")).otherwise(F.col("net_val")))
    before = _rows(spark.read.parquet(path))
    with pytest.raises(Exception, match="stopped"):
        files.write_dates(broken, path)
    assert _rows(spark.read.parquet(path)) == before
    for _ in range(2):
        files.write_dates(later, path)
        found = spark.read.parquet(path)
        assert found.count() == 120 and found.where("net_val = 2").count() == 60 and found.select("date").distinct().count() == 120
    with pytest.raises(ValueError):
        files.write_dates(later, path, by="week")


def test_even_ranges_of_a_skewed_column(spark):
    """Nine rows in ten lie in one month of ten years, and a third of these on one day."""
    from navspan.sources import jdbc

    rows = spark.range(20_000).selectExpr(
        "CASE WHEN id % 10 = 0 THEN date_add(date'2015-01-01', int(id % 3650)) WHEN id % 3 = 0 THEN date'2020-05-17' "
        "ELSE date_add(date'2020-05-01', int(id % 30)) END AS date", "if(id % 50 = 0, NULL, id * id) AS n")
    rows = rows.withColumn("date", F.when(F.col("n").isNotNull(), F.col("date")))
    for column in ("date", "n"):
        ranges = jdbc.even_ranges(rows, column, 8)
        counts = [rows.where(condition).count() for condition in ranges]
        assert sum(counts) == 20_000 and 5 <= len(ranges) <= 8
        whole = rows.where("date = date'2020-05-17'").count() if column == "date" else 0
        assert max(counts) <= 1.3 * 20_000 / 8 + whole
    assert jdbc.even_ranges(rows.limit(0), "date", 8) == ["1 = 1"] == jdbc.even_ranges(rows, "n", 1)
    with pytest.raises(ValueError):
        jdbc.even_ranges(rows.selectExpr("string(n) AS t"), "t", 2)
    config = {"url": "jdbc:x", "table": "t"}
    assert jdbc.read_options({**config, "ranges": ranges}) == {"url": "jdbc:x", "dbtable": "t"}
    with pytest.raises(ValueError):
        jdbc.read_options({**config, "ranges": ranges, "single_reader": True})
