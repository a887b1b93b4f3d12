"""Grid files read by ranges of bytes and written with a commit."""

import datetime as dt
import os

import numpy as np
import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from gridzonal.schema import GridSpec
from gridzonal.sources import layers, netcdf
from gridzonal.sources.layers import GridFile, LayerReader, scan_layers, scan_run_layers, write_grid_layers

SPEC = GridSpec("small", -180.0, -10.0, 0.5, 0.5, 12, 8)
def run():
    return F.to_timestamp_ntz(F.regexp_extract("path", r"_(\d{10})\.nc$", 1), F.lit("yyyyMMddHH"))



def cells(spark, files=("run_a_2024010100.nc", "run_b_2024010112.nc"), count=6):
    grid = spark.range(len(files) * count * SPEC.nx * SPEC.ny).selectExpr("id", f"id % {SPEC.nx} AS ix", f"id div {SPEC.nx} AS rest")
    grid = grid.selectExpr("id", "ix", f"rest % {SPEC.ny} AS iy", f"rest div {SPEC.ny} AS rest")
    names = F.array(*map(F.lit, files))
    return grid.select(
        F.element_at(names, (F.col("rest") % len(files) + 1).cast("int")).alias("source_file"),
        F.lit("o3").alias("variable"), F.floor(F.col("rest") / len(files)).alias("layer"), "iy", "ix",
        F.when(F.col("id") % 7 != 0, F.col("id") / 4).alias("value"),
    ).repartition(4)


@pytest.fixture
def folder(spark, tmp_path):
    write_grid_layers(cells(spark), str(tmp_path), SPEC)
    return str(tmp_path)


def reader(folder, *filters, **options):
    made = LayerReader({"path": f"file://{folder}", **options})
    list(made.pushFilters(list(filters)))
    return made


def test_round_trip_in_ranges_of_any_size(spark, folder):
    assert sorted(os.listdir(folder)) == ["run_a_2024010100.nc", "run_b_2024010112.nc"]
    want = sorted((r.source_file, r.layer, r.iy, r.ix, r.value) for r in cells(spark).filter("value IS NOT NULL").collect())
    for size in (1, 200, 1 << 20):
        found = scan_run_layers(spark, folder, SPEC, run(), range_bytes=size).filter("value IS NOT NULL")
        name = F.when(F.hour("run_time") == 0, "run_a_2024010100.nc").otherwise("run_b_2024010112.nc").alias("source_file")
        rows = found.select(name, "lead_hour", "iy", "ix", "value", "valid_time", "run_time").collect()
        assert sorted(tuple(r)[:5] for r in rows) == want
        assert all(r.valid_time == r.run_time + dt.timedelta(hours=r.lead_hour) for r in rows)


def test_agrees_with_the_decoder_of_whole_files(spark, folder):
    from gridzonal.sources.grid_files import scan_grid_files

    whole = scan_grid_files(spark, folder, SPEC, run_time=run()).drop("stat")
    ranges = scan_run_layers(spark, folder, SPEC, run()).drop("stat")
    assert whole.count() == ranges.count() and whole.exceptAll(ranges).isEmpty()


def test_a_lead_hour_costs_its_layer(spark, folder):
    found = scan_run_layers(spark, folder, SPEC, run()).filter("lead_hour = 3")
    assert "pushed" in plan_of(found).lower() or "BatchScan" in plan_of(found)
    assert found.count() == 2 * SPEC.nx * SPEC.ny
    one = reader(folder, layers.EqualTo(("layer",), 3)).partitions()
    assert sum(p.bytes for p in one) == 2 * SPEC.nx * SPEC.ny * 8 and len(one) == 2
    assert sum(p.bytes for p in reader(folder).partitions()) == 6 * 2 * SPEC.nx * SPEC.ny * 8
    # What is read of a file is its header, its axes and the rows.
    part = one[0]
    opened = []
    plain = GridFile.__init__
    try:
        GridFile.__init__ = lambda self, *a: (plain(self, *a), opened.append(self))[0]
        list(reader(folder, layers.EqualTo(("layer",), 3)).read(part))
    finally:
        GridFile.__init__ = plain
    assert opened[0].read_bytes < part.bytes + 8 * (SPEC.nx + SPEC.ny + 6) + layers.HEADER_BYTES


def test_filters_reach_the_planning(spark, folder):
    assert scan_layers(spark, folder).filter("source_file = 'run_b_2024010112.nc' AND layer >= 4").count() == 2 * SPEC.nx * SPEC.ny
    rows = reader(folder, layers.GreaterThan(("lat",), -8.0), layers.LessThanOrEqual(("lat",), -7.25), layers.In(("layer",), (0, 5)))
    assert {(p.first, p.last, p.first_row, p.last_row) for p in rows.partitions()} == {(0, 1, 4, 6), (5, 6, 4, 6)}
    assert [p for p in reader(folder, layers.EqualTo(("variable",), "none")).partitions() if p.file] == []
    assert scan_layers(spark, folder).filter("layer = 100 OR lat < -100").count() == 0


def test_area_cuts_rows_and_columns(spark, folder):
    area = (-7.0, -179.0, -8.6, -177.0)
    found = scan_layers(spark, folder, SPEC, area=area).select("lat", "lon").distinct().collect()
    lats = {round(r.lat, 2) for r in found}
    assert lats == {-8.25, -7.75, -7.25} and {round(r.lon, 2) for r in found} == {-178.75, -178.25, -177.75, -177.25}
    assert scan_layers(spark, folder, area=(90.0, 10.0, 60.0, 20.0)).count() == 0


def test_one_layer_of_a_file_above_two_gigabytes(spark, tmp_path):
    lats, lons, count = np.linspace(-89.5, 89.5, 360), np.linspace(-179.5, 179.5, 720), 1200
    path = tmp_path / "huge.nc"
    head = netcdf.stream_header("o3", lats, lons)
    size = len(lats) * len(lons) * 8 + 8
    with open(path, "wb") as out:
        out.write(head)
        out.seek(len(head) + 700 * size)
        out.write(netcdf.stream_layer(700.0, np.full((360, 720), 7.0)))
        out.truncate(len(head) + count * size)
    assert path.stat().st_size > 2**31
    found = scan_layers(spark, str(tmp_path)).filter("layer = 700 AND lat > 0")
    assert found.agg(F.count("value"), F.sum("value"), F.max("valid_time")).first()[:2] == (180 * 720, 180 * 720 * 7.0)
    parts = reader(str(tmp_path)).partitions()
    assert len(parts) > 30 and max(p.bytes for p in parts) <= layers.RANGE_BYTES
    assert sum(p.bytes for p in parts) == count * (size - 8)


def test_times_and_missing_layers(spark, tmp_path):
    table = [("f.nc", "pm", 2, dt.datetime(2024, 1, 3), 0, 0, 1.5), ("f.nc", "pm", 0, dt.datetime(2024, 1, 1), 1, 2, 2.5)]
    df = spark.createDataFrame(table, "source_file string, variable string, layer int, valid_time timestamp_ntz, iy int, ix int, value double")
    write_grid_layers(df, str(tmp_path), SPEC)
    found = scan_layers(spark, str(tmp_path))
    assert sorted((r.layer, r.valid_time, r.value) for r in found.filter("value IS NOT NULL").collect()) == [
        (0, dt.datetime(2024, 1, 1), 2.5), (2, dt.datetime(2024, 1, 3), 1.5)
    ]
    assert found.filter("layer = 1").select("valid_time").distinct().collect() == [(None,)]


@pytest.mark.parametrize("broken, message", [({"iy": 99}, "outside the grid"), ({"iy": 0, "ix": 0}, "two rows for one cell")])
def test_failed_jobs_leave_nothing_to_read(spark, folder, broken, message):
    before = scan_layers(spark, folder).filter("value IS NOT NULL").agg(F.sum("value")).first()[0]
    bad = cells(spark).withColumns({k: F.when(F.col("source_file").startswith("run_b"), v).otherwise(F.col(k)) for k, v in broken.items()})
    with pytest.raises(Exception, match=message):
        write_grid_layers(bad.withColumn("value", F.lit(0.0)), folder, SPEC)
    assert sorted(n for n in os.listdir(folder) if not n.startswith("_")) == ["run_a_2024010100.nc", "run_b_2024010112.nc"]
    assert scan_layers(spark, folder).filter("value IS NOT NULL").agg(F.sum("value")).first()[0] == before


def test_bad_files_are_named(spark, folder, tmp_path):
    with pytest.raises(Exception, match="run_a.*not cell centres"):
        scan_layers(spark, folder, GridSpec("other", 0.0, 0.1, 0.4, 0.4, 20, 20)).count()
    with open(f"{folder}/cut.nc", "wb") as out:
        out.write(open(f"{folder}/run_a_2024010100.nc", "rb").read()[:100])
    with pytest.raises(Exception, match="cut.nc"):
        scan_layers(spark, folder).count()
    assert scan_layers(spark, folder, pattern="^run_").count() > 0
    empty = tmp_path / "empty"
    empty.mkdir()
    assert scan_layers(spark, str(empty)).count() == 0
