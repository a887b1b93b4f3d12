import datetime as dt

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from gridzonal.operators import series
from gridzonal.plans.export import daily_report, monthly_report
from gridzonal.schema import DAY_STEPS_O3, FORECAST_AREA, ZONE_DAILY
from gridzonal.sources import manifest
from gridzonal.storage import fresh_path

ROW = "code_muni bigint, date date, value double"


def day(text):
    return dt.date.fromisoformat(text)


def table(spark, rows):
    return spark.createDataFrame([(code, day(d), value) for code, d, value in rows], ROW)


@pytest.fixture
def stacked(spark):
    mean = table(spark, [(5103403, "2024-01-30", 10.0), (5103403, "2024-01-31", 20.0), (5103403, "2024-02-01", None)])
    high = table(spark, [(5103403, "2024-01-30", 15.0), (5103403, "2024-03-01", 99.0)])
    low = table(spark, [(5103403, "2024-01-30", 5.0)])
    return series.stack_stats({"mean": mean, "max": high, "min": low})


def test_stack_labels_rows(stacked):
    counts = {r["name"]: r["count"] for r in stacked.groupBy("name").count().collect()}
    assert counts == {"mean": 3, "max": 2, "min": 1}


def test_stack_of_nothing():
    with pytest.raises(ValueError):
        series.stack_stats({})


def test_monthly_mean_ignores_missing(stacked):
    rows = {(r.date, r["name"]): r.value for r in series.monthly_mean(stacked).collect()}
    assert rows[day("2024-01-01"), "mean"] == 15.0
    assert rows[day("2024-02-01"), "mean"] is None


def test_monthly_export_keeps_months_without_a_mean(stacked):
    rows = series.export_monthly(stacked).orderBy("ano_mes").collect()
    assert [tuple(r) for r in rows] == [
        (510340, day("2024-01-01"), 15.0),
        (510340, day("2024-02-01"), None),
        (510340, day("2024-03-01"), None),
    ]


def test_monthly_export_equals_its_separate_steps(stacked):
    steps = (
        series.pivot_stats(series.monthly_mean(stacked), ["code_muni", "date"])
        .drop("min", "max")
        .selectExpr("cast(substring(cast(code_muni as string), 1, 6) as bigint) cod6", "date ano_mes", "mean pm25")
    )
    fused = series.export_monthly(stacked)
    assert fused.exceptAll(steps).count() == steps.exceptAll(fused).count() == 0
    assert plan_of(fused).count("Exchange") < plan_of(steps).count("Exchange")


def test_daily_export_columns_and_order(stacked):
    daily = series.export_daily(stacked, 2024)
    assert daily.columns == ["cod6", "ano_mes", "min", "med", "max"]
    rows = {r.ano_mes: (r["min"], r.med, r["max"]) for r in daily.collect()}
    assert rows[day("2024-01-30")] == (5.0, 10.0, 15.0)
    assert rows[day("2024-03-01")] == (None, None, 99.0)
    assert series.export_daily(stacked, 2025).count() == 0


def test_pivot_and_back(stacked):
    wide = series.pivot_stats(stacked, ["code_muni", "date"])
    back = series.melt_stats(wide, ["code_muni", "date"]).withColumnRenamed("stat", "name").dropna(subset=["value"])
    kept = stacked.dropna(subset=["value"]).select(*back.columns)
    assert back.exceptAll(kept).count() == kept.exceptAll(back).count() == 0


def test_pivot_refuses_repeated_values(stacked):
    with pytest.raises(Exception, match="more than one 'max' value"):
        series.pivot_stats(stacked.unionByName(stacked.filter("name = 'max'")), ["code_muni", "date"]).collect()


def test_zone_series_and_months(spark):
    rows = table(
        spark,
        [(1, "2024-03-02", 3.0), (1, "2024-01-31", 1.0), (1, "2024-01-01", 2.0), (2, "2024-01-01", 9.0), (1, "2023-12-31", 7.0)],
    )
    assert [r.value for r in series.zone_series(rows, 1).collect()] == [7.0, 2.0, 1.0, 3.0]
    assert [r.value for r in series.zone_series(rows, 1, 2024).collect()] == [2.0, 1.0, 3.0]
    assert [(r.date, r.value) for r in series.zone_monthly(rows, 1, 2024).collect()] == [
        (day("2024-01-01"), 1.5),
        (day("2024-03-01"), 3.0),
    ]


def test_head_is_a_top_n(spark):
    top = series.head_rows(spark.range(100).orderBy(F.desc("id")), ["id"])
    assert [r.id for r in top.collect()] == [0, 1, 2, 3, 4, 5]
    assert "TakeOrderedAndProject" in plan_of(top)


def test_missing_days_newest_first(spark):
    variables = spark.createDataFrame([("o3",)], "variable string")
    planned = manifest.day_manifest(variables, day("2024-01-01"), day("2024-01-03"))
    present = spark.createDataFrame([("o3", day("2024-01-02")), ("o3", day("2024-01-02"))], "variable string, date date")
    todo = manifest.newest_first(manifest.missing(planned, present, ["variable", "date"]))
    assert [(r.date, r.target) for r in todo.collect()] == [
        (day("2024-01-03"), "grid_o3_20240103.nc"),
        (day("2024-01-01"), "grid_o3_20240101.nc"),
    ]


def test_manifests(spark):
    variables = spark.createDataFrame([("o3",), ("co",)], "variable string")
    assert manifest.request_manifest(variables, day("2003-01-01"), day("2024-12-31")).count() == 8036 * (8 + 6)
    runs = spark.createDataFrame([(dt.datetime(2025, 7, 9, 12),)], "run_time timestamp_ntz")
    leads = manifest.lead_manifest(runs)
    assert leads.count() == 121
    assert leads.agg(F.max("valid_time")).first()[0] == dt.datetime(2025, 7, 14, 12)


def test_steps_of_their_own(spark):
    variables = spark.createDataFrame([("o3",), ("co",)], "variable string")
    day_one = day("2024-01-01")
    work = manifest.request_manifest(variables, day_one, day_one, special={"o3": DAY_STEPS_O3})
    counts = {r["variable"]: r["count"] for r in work.groupBy("variable").count().collect()}
    assert counts == {"o3": 6, "co": 8}


def test_request_descriptions(spark):
    work = spark.createDataFrame([("o3",), ("haze",)], "variable string")
    rows = {r.variable: r for r in manifest.describe_requests(work, FORECAST_AREA).collect()}
    assert (rows["o3"].request_name, rows["haze"].request_name) == ("total_column_ozone", "haze")
    assert (rows["o3"].north, rows["o3"].west, rows["o3"].south, rows["o3"].east) == (33.0, -118.0, -56.0, -30.0)
    assert "request_name" in manifest.describe_requests(work).columns


def test_reports_from_the_stored_table(spark):
    path = fresh_path(spark, "series")
    rows = [
        ("pm25", stat, 5103403, day(d), value)
        for d, values in {"2017-12-31": (1.0, 1.0, 1.0), "2018-01-01": (2.0, 3.0, 1.0), "2018-01-02": (4.0, 9.0, 0.5), "2024-02-01": (5.0, 6.0, 4.0)}.items()
        for stat, value in zip(("mean", "max", "min"), values)
    ] + [("o3", "mean", 5103403, day("2024-02-01"), 250.0)]
    spark.createDataFrame(rows, ZONE_DAILY).write.partitionBy("variable", "stat").parquet(path)
    table = spark.read.schema(ZONE_DAILY).parquet(path)
    monthly = monthly_report(table)
    assert sorted(map(tuple, monthly.collect())) == [
        (510340, day("2018-01-01"), 3.0),
        (510340, day("2024-02-01"), 5.0),
    ]
    assert [tuple(r) for r in daily_report(table).collect()] == [(510340, day("2024-02-01"), 4.0, 5.0, 6.0)]
    assert monthly_report(table, "o3").columns == ["cod6", "ano_mes", "o3"]
    plan = plan_of(monthly_report(table))
    assert "(variable = pm25)" in plan.split("PartitionFilters")[1]
    assert "GreaterThanOrEqual(date,2018-01-01)" in plan
    assert plan.count("Exchange") == 1
