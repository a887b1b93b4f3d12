import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import views
from gridzonal.functions.numeric import present
from gridzonal.operators import grid
from gridzonal.schema import DAY_STEPS_O3, GridSpec

SF = "/root/testdata/sf0.001"
OBS = "variable string, date date, iy int, ix int, value double"


def steps(spark, values):
    rows = [("pm25", dt.date(2024, 1, 1), 0, 0, value) for value in values]
    return spark.createDataFrame(rows, OBS).withColumn("value", present(F.col("value")))


@pytest.mark.parametrize("gap", [None, float("nan")])
def test_missing_step(spark, gap):
    obs = steps(spark, [1.0, gap, 3.0])
    loose = grid.daily_cell_stats(obs).first()
    assert (loose.v_mean, loose.v_max, loose.v_min, loose.n_steps) == (2.0, 3.0, 1.0, 3)
    strict = grid.daily_cell_stats(obs, strict=True).first()
    assert (strict.v_mean, strict.v_max, strict.v_min, strict.n_steps) == (None, None, None, 3)


def test_strict_without_gaps(spark):
    row = grid.daily_cell_stats(steps(spark, [1.0, 5.0]), strict=True).first()
    assert (row.v_mean, row.v_max, row.v_min) == (3.0, 5.0, 1.0)


@pytest.mark.parametrize("lon, expected", [(359.25, -0.75), (180.0, -180.0), (0.0, 0.0), (-180.0, -180.0), (179.5, 179.5)])
def test_longitude_wrap(spark, lon, expected):
    assert spark.range(1).select(grid.wrap_longitude(F.lit(lon))).first()[0] == expected


def test_normalise(spark):
    spec = GridSpec("world", -180.375, -90.375, 0.75, 0.75, 480, 241)
    cells = spark.createDataFrame([(0.0, 90.0), (359.25, -90.0)], "lon double, lat double")
    rows = grid.normalise_grid(cells, spec).collect()
    assert [(r.ix, r.iy) for r in rows] == [(240, 240), (239, 0)]


def test_selections(spark):
    rows = [(h, dt.datetime(2024, 1, 1, h)) for h in range(24)]
    obs = spark.createDataFrame(rows, "lead_hour int, valid_time timestamp_ntz")
    assert [r.lead_hour for r in obs.filter(grid.at_steps(DAY_STEPS_O3)).collect()] == [6, 9, 12, 15, 18, 21]
    assert [r.lead_hour for r in obs.filter(grid.at_layer(1)).collect()] == [0]
    points = spark.createDataFrame([(33.0, -118.0), (-56.0, -30.0), (33.1, -50.0), (0.0, -29.9)], "lat double, lon double")
    assert points.filter(grid.in_area(33.0, -118.0, -56.0, -30.0)).count() == 2


def test_value_range(spark):
    rows = [("a", 0, 1.0), ("a", 0, 5.0), ("a", 1, -2.0), ("a", 1, None)]
    obs = spark.createDataFrame(rows, "variable string, lead_hour int, value double")
    layers = {r.lead_hour: (r.v_min, r.v_max) for r in grid.layer_minmax(obs).collect()}
    assert layers == {0: (1.0, 5.0), 1: (-2.0, -2.0)}
    assert tuple(grid.value_domain(obs).first()) == (-2.0, 5.0)


def gather(field, source, target):
    """Bilinear by gathering four neighbours per target; missing ones left out."""
    result = {}
    for j in range(target.ny):
        for i in range(target.nx):
            x = (target.lon0 + (i + 0.5) * target.dlon - source.lon0) / source.dlon
            y = (target.lat0 + (j + 0.5) * target.dlat - source.lat0) / source.dlat
            if not (0 <= x <= source.nx and 0 <= y <= source.ny):
                continue
            fx, fy = x - 0.5, y - 0.5
            total = weight = 0.0
            for sy in (int(np.floor(fy)), int(np.floor(fy)) + 1):
                for sx in (int(np.floor(fx)), int(np.floor(fx)) + 1):
                    w = (1 - abs(fx - sx)) * (1 - abs(fy - sy))
                    if w > 1e-9 and field.get((sy, sx)) is not None:
                        total, weight = total + w * field[sy, sx], weight + w
            if weight > 0:
                result[j, i] = total / weight
    return result


@pytest.mark.parametrize(
    "target",
    [
        GridSpec("finer", 0.1, -0.2, 0.3, 0.45, 30, 20),
        GridSpec("coarser", -1.0, -1.0, 1.7, 2.1, 8, 6),
        GridSpec("same", 0.0, 0.0, 1.0, 0.8, 9, 7),
    ],
)
def test_regrid_matches_gathering(spark, target):
    source = GridSpec("s", 0.0, 0.0, 1.0, 0.8, 9, 7)
    rng = np.random.default_rng(3)
    field = {(y, x): float(rng.normal()) for y in range(7) for x in range(9) if (y * 9 + x) % 11}
    rows = [("t", dt.date(2024, 1, 1), y, x, field.get((y, x))) for y in range(7) for x in range(9)]
    got = grid.regrid_bilinear(spark.createDataFrame(rows, OBS), source, target)
    found = {(r.iy, r.ix): r.value for r in got.collect()}
    expected = gather(field, source, target)
    assert set(found) == set(expected)
    for cell, value in expected.items():
        assert found[cell] == pytest.approx(value, abs=1e-9)


def test_regrid_keeps_a_plane(spark):
    source = GridSpec("s", 0.0, 0.0, 1.0, 1.0, 10, 10)
    target = GridSpec("t", 1.0, 1.0, 0.25, 0.25, 30, 30)
    plane = spark.range(100).selectExpr(
        "'v' variable", "date'2024-01-01' date", "cast(id div 10 as int) iy", "cast(id % 10 as int) ix",
        "2 * (id % 10 + 0.5D) - 3 * (id div 10 + 0.5D) + 1 as value",
    )
    off = grid.regrid_bilinear(plane, source, target).selectExpr(
        "max(abs(value - (2 * (1 + (ix + 0.5D) * 0.25D) - 3 * (1 + (iy + 0.5D) * 0.25D) + 1))) as d", "count(1) as n"
    ).first()
    assert off.n == 900 and off.d < 1e-9


def test_daily_stats_over_real_events(spark):
    obs = views.grid_obs(spark, SF)
    daily = grid.daily_cell_stats(obs)
    assert daily.agg(F.sum("n_steps")).first()[0] == obs.count()
    assert daily.filter("v_min > v_mean + 1e-9 or v_mean > v_max + 1e-9").count() == 0


def test_resampling_across_the_seam(spark):
    """Four columns of 90 degrees: the target at -157.5 lies between the last column and the first."""
    source, target = GridSpec("s", -180.0, -90.0, 90.0, 180.0, 4, 1), GridSpec("t", -180.0, -90.0, 45.0, 180.0, 8, 1)
    cells = spark.createDataFrame([(0, k, v) for k, v in enumerate((0.0, 10.0, 20.0, 100.0))], "iy int, ix int, value double")
    got = {r.ix: r.value for r in grid.regrid_bilinear(cells, source, target, by=[]).collect()}
    assert got[0] == pytest.approx(25.0) and got[7] == pytest.approx(75.0) and len(got) == 8


def test_columns_of_a_closed_grid(spark):
    spec = GridSpec("w", 0.0, -90.0, 90.0, 180.0, 4, 1)
    cells = spark.createDataFrame([(x, 0.0) for x in (45.0, 135.0, -135.0, -45.0, 315.0)], "lon double, lat double")
    assert [r.ix for r in grid.normalise_grid(cells, spec).collect()] == [0, 1, 2, 3, 3]
