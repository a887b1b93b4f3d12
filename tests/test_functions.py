import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridzonal.functions import names, times
from gridzonal.functions.numeric import convert_units, present, reducer, round_to
from gridzonal.schema import CONVERSIONS, GridSpec, conversions


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


def text(value):
    return F.lit(value)


def ntz(value):
    return F.lit(value).cast("timestamp_ntz")


@pytest.mark.parametrize("value, expected", [(2.675, 2.68), (1.005, 1.01), (0.125, 0.13), (-0.125, -0.13), (20.0, 20.0)])
def test_rounding(spark, value, expected):
    assert one(spark, round_to(F.lit(value))) == expected


def test_nan_is_missing(spark):
    assert one(spark, present(F.lit(float("nan")))) is None
    assert one(spark, present(F.lit(1.5))) == 1.5
    assert one(spark, present(F.lit(None).cast("double"))) is None


@pytest.mark.parametrize(
    "variable, profile, value, expected",
    [
        ("temp", "default", 300.0, 26.85),
        ("temp", "reference", 300.0, 27.85),
        ("o3", "default", 0.0067, 299.48),
        ("pm25", "default", 1.2345e-8, 12.35),
        ("no2", "default", 2.5e-6, 2.5),
        ("uv", "default", 0.2, 8.0),
    ],
)
def test_unit_conversion(spark, variable, profile, value, expected):
    assert one(spark, round_to(convert_units(F.lit(value), text(variable), profile=profile))) == expected


def test_unit_conversion_of_an_unknown_variable_stops(spark):
    with pytest.raises(Exception, match="no unit conversion for variable so2"):
        one(spark, convert_units(F.lit(1.0), text("so2")))


def test_unknown_profile_and_reducer():
    with pytest.raises(ValueError):
        conversions("imperial")
    with pytest.raises(ValueError, match="median"):
        reducer("median")
    assert set(CONVERSIONS) == set(conversions("reference"))


def test_grid_spec_is_checked():
    with pytest.raises(ValueError):
        GridSpec("bad", 0, 0, 0.0, 1.0, 2, 2)


@pytest.mark.parametrize("variable", ["pm25", "no2", "o3", "temp_2m"])
def test_date_and_variable_from_names_of_any_length(spark, variable):
    name = f"/data/x_20010101/grid_{variable}_20240102_mean.nc"
    assert one(spark, names.date_from_name(text(name))) == dt.date(2024, 1, 2)
    assert one(spark, names.variable_from_name(text(name))) == variable


@pytest.mark.parametrize("name", ["grid_pm25.nc", "grid_pm25_20241301.nc", "notes.txt"])
def test_no_date_in_name(spark, name):
    assert one(spark, names.date_from_name(text(name))) is None


def test_names_of_days_without_statistic(spark):
    made = names.grid_file_name(text("co"), F.lit(dt.date(2024, 2, 3)))
    assert one(spark, made) == "grid_co_20240203.nc"
    assert one(spark, names.variable_from_name(made)) == "co"


def test_file_parts(spark):
    path = text("/data/v1.2/grid_o3_20240102.tar.nc")
    assert one(spark, names.base_name(path)) == "grid_o3_20240102.tar.nc"
    assert one(spark, names.file_stem(path)) == "grid_o3_20240102.tar"


def test_run_marker_both_ways(spark):
    marker = names.run_marker(ntz("2025-07-09 12:00:00"))
    assert one(spark, marker) == "datestamp_20250709_12:00"
    assert one(spark, names.run_time_from_marker(marker)) == dt.datetime(2025, 7, 9, 12)
    assert one(spark, names.run_hour(text("00:00"))) == 0
    assert one(spark, names.run_hour(text("none"))) is None


@pytest.mark.parametrize("code", ["5103403", "cast(5103403 as double)"])
def test_code6(spark, code):
    assert one(spark, names.code6(F.expr(code))) == 510340


@pytest.mark.parametrize("lead, valid, local", [(0, (2025, 7, 9, 12), (2025, 7, 9, 9)), (120, (2025, 7, 14, 12), (2025, 7, 14, 9))])
def test_valid_and_local_time(spark, lead, valid, local):
    instant = times.valid_time(ntz("2025-07-09 12:00:00"), F.lit(lead))
    assert one(spark, instant) == dt.datetime(*valid)
    assert one(spark, times.local_time(instant)) == dt.datetime(*local)


def test_summer_time(spark):
    assert one(spark, times.local_time(ntz("2018-12-09 00:00:00"))) == dt.datetime(2018, 12, 8, 22)


@pytest.mark.parametrize(
    "now, run",
    [("2025-07-09 11:59:59", dt.datetime(2025, 7, 8, 12)), ("2025-07-09 12:00:00", dt.datetime(2025, 7, 9)), ("2025-01-01 00:00:00", dt.datetime(2024, 12, 31, 12))],
)
def test_latest_cycle(spark, now, run):
    assert one(spark, times.latest_cycle(ntz(now))) == run


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata", "Pacific/Auckland"])
def test_clock_functions_ignore_the_session_zone(spark, zone):
    """02:30 on this day does not exist in New York; a detour over local time would move it."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        moment = ntz("2025-03-09 02:30:00")
        assert one(spark, names.run_marker(moment).alias("x")) == "datestamp_20250309_02:30"
        assert one(spark, times.latest_cycle(moment).cast("string")) == "2025-03-08 12:00:00"
        assert one(spark, times.valid_time(moment, F.lit(1)).cast("string")) == "2025-03-09 03:30:00"
        assert one(spark, times.local_time(ntz("2025-07-09 12:00:00")).cast("string")) == "2025-07-09 09:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_year_filters_are_ranges(spark):
    days = spark.sql("select explode(array(date'2017-12-31', date'2018-01-01', date'2018-12-31', date'2019-01-01')) d")
    assert days.filter(times.from_year(F.col("d"), 2018)).count() == 3
    assert days.filter(times.in_year(F.col("d"), 2018)).count() == 2


def test_rounding_has_no_silent_limits(spark):
    with pytest.raises(ValueError, match="at most 9"):
        round_to(F.lit(1.0), 12)
    for value in (1e19, -3.5e30):
        assert one(spark, round_to(F.lit(value))) == value
    assert one(spark, round_to(F.lit(1.0000000005), 9)) == 1.000000001
