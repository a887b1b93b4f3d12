import datetime as dt
import glob

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from checks import views
from gridzonal import sinks, storage
from gridzonal.functions.times import from_year
from gridzonal.operators import grid
from gridzonal.operators.coverage import footprint
from gridzonal.operators.zonal import prune_to_box
from gridzonal.plans.reanalysis import zone_daily
from gridzonal.schema import ZONE_DAILY
from gridzonal.sources import tables

SF = "/root/testdata/sf0.001"


@pytest.fixture
def daily(spark):
    rows = [("o3", dt.date(2024, 1, d), d * 1.5) for d in (1, 2, 3)]
    return spark.createDataFrame(rows, "variable string, date date, value double")


def values(df):
    return sorted((r.date.day, r.value) for r in df.collect())


def test_append_creates_then_adds(spark, daily):
    path = storage.fresh_path(spark, "t")
    sinks.append(daily.filter("value < 2"), path, ["variable"])
    sinks.append(daily.filter("value > 2"), path, ["variable"])
    assert values(tables.scan_parquet(spark, path)) == values(daily)


def test_replace_drops_all_partitions(spark, daily):
    path = storage.fresh_path(spark, "t")
    sinks.replace(daily, path, ["variable", "date"])
    sinks.replace(daily.filter("value < 2"), path, ["variable", "date"])
    assert values(tables.scan_parquet(spark, path)) == [(1, 1.5)]


def test_replace_partitions_leaves_the_others(spark, daily):
    path = storage.fresh_path(spark, "t")
    sinks.replace_partitions(daily, path, ["variable", "date"])
    newer = daily.filter("value > 4").withColumn("value", F.lit(0.0))
    sinks.replace_partitions(newer, path, ["variable", "date"])
    sinks.replace_partitions(newer, path, ["variable", "date"])
    assert values(tables.scan_parquet(spark, path)) == [(1, 1.5), (2, 3.0), (3, 0.0)]


def test_catalog_tables(spark, daily):
    sinks.rebuild_table(daily, "o3_mean_mean")
    sinks.rebuild_table(daily.filter("value < 2"), "o3_mean_mean")
    sinks.append_table(daily.filter("value > 4"), "o3_mean_mean")
    assert values(tables.scan_table(spark, "o3_mean_mean")) == [(1, 1.5), (3, 4.5)]
    assert "o3_mean_mean" in [r.name for r in sinks.list_tables(spark).collect()]
    sinks.rebuild_table(spark.table("o3_mean_mean").filter("value > 4"), "o3_mean_mean")  # from itself
    assert values(tables.scan_table(spark, "o3_mean_mean")) == [(3, 4.5)]
    spark.sql("DROP TABLE o3_mean_mean")


@pytest.mark.parametrize("null_value", ["", "NA"])
def test_csv_export(spark, daily, null_value):
    path = storage.fresh_path(spark, "csv")
    sinks.export_csv(daily.withColumn("value", F.when(F.col("value") > 2, F.col("value"))), path, null_value)
    lines = [line for name in glob.glob(f"{path}/*.csv") for line in open(name).read().splitlines()]
    assert "variable,date,value" in lines
    assert f"o3,2024-01-01,{null_value}" in lines and "o3,2024-01-03,4.5" in lines


def test_materialised_table_is_read_back(spark, daily):
    copy = storage.materialise(daily, "m")
    assert values(copy) == values(daily)
    assert "Scan ExistingRDD" not in plan_of(copy)


def test_shared_folder_is_the_configured_one(spark):
    assert storage.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_paths_are_resolved_once(spark):
    assert storage.arrow_uri(spark, "/tmp/x") == "file:///tmp/x"
    assert storage.arrow_uri(spark, "file:/tmp/x") == "file:///tmp/x"


def test_fresh_paths_can_be_removed(spark, daily):
    path = storage.fresh_path(spark, "gone")
    daily.write.parquet(path)
    storage.remove_path(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        storage.remove_path(spark, "/tmp/elsewhere")


def test_filters_reach_the_scan(spark):
    path = storage.fresh_path(spark, "obs")
    sinks.append(views.grid_obs(spark, SF), path, ["variable"])
    obs = tables.scan_parquet(spark, path)
    area = plan_of(obs.filter(grid.in_area(5.0, 2.0, 1.5, 8.0)).select("value"))
    assert "GreaterThanOrEqual(lat,1.5)" in area and "LessThanOrEqual(lon,8.0)" in area
    assert "ReadSchema: struct<lat:double,lon:double,value:double>" in area
    one = plan_of(obs.filter((F.col("variable") == "view") & from_year(F.col("date"), 2024)))
    assert "PartitionFilters: [isnotnull(variable" in one and "GreaterThanOrEqual(date,2024-01-01)" in one
    zones = views.zones(spark, SF).filter("zone_id = 7")
    boxed = plan_of(prune_to_box(obs, footprint(zones, views.GRID)))
    assert "GreaterThanOrEqual(iy," in boxed and "LessThanOrEqual(ix," in boxed


def test_writes_are_balanced_by_partition(spark):
    """A partition with most of the rows is split over tasks; small ones share a task."""
    obs = views.grid_obs(spark, SF)
    hot = obs.withColumn("variable", F.lit("view"))
    plan = plan_of(sinks._arranged(obs.unionByName(hot), ["variable"], [], False))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    assert "Exchange" not in plan_of(sinks._arranged(obs, ["variable"], [], True))


def test_sorted_files_answer_filters(spark):
    import pyarrow.parquet as pq

    path = storage.fresh_path(spark, "sorted")
    sinks.append(views.grid_obs(spark, SF), path, ["variable"], ["iy", "ix"])
    for name in glob.glob(f"{path}/variable=*/*.parquet"):
        column = pq.read_table(name, columns=["iy", "ix"], partitioning=None)
        pairs = list(zip(column["iy"].to_pylist(), column["ix"].to_pylist()))
        assert pairs == sorted(pairs)


def test_bucketed_observations_need_no_shuffle(spark):
    """Both aggregations of the historical plan reuse the table's partitioning by day."""
    obs = views.in_model_units(views.grid_obs(spark, SF))
    sinks.store_bucketed(obs, "obs_by_day", 8, storage.fresh_path(spark, "bucketed"))
    zones = views.zones(spark, SF)
    weights = tables.store_weights(zones, views.GRID, storage.fresh_path(spark, "weights"))
    plan = lambda source: zone_daily(
        source, zones, views.GRID, weights, units=views.UNITS, all_zones=False
    )
    stored = plan(spark.table("obs_by_day"))
    shuffled = [line for line in plan_of(stored).splitlines() if "Exchange hashpartitioning" in line]
    assert all("variable" not in line for line in shuffled)
    assert shuffled == []
    direct = plan(obs)
    assert stored.exceptAll(direct).count() == direct.exceptAll(stored).count() == 0
    spark.sql("DROP TABLE obs_by_day")


def test_large_days_are_split_over_buckets(spark):
    """With the row in the key, only the zone-day sums are exchanged."""
    obs = views.in_model_units(views.grid_obs(spark, SF))
    keys = ["variable", "date", "iy"]
    sinks.store_bucketed(obs, "obs_by_row", 8, storage.fresh_path(spark, "bucketed"), keys)
    zones = views.zones(spark, SF)
    weights = tables.store_weights(zones, views.GRID, storage.fresh_path(spark, "weights"))
    stored = zone_daily(spark.table("obs_by_row"), zones, views.GRID, weights, units=views.UNITS, all_zones=False)
    shuffled = [line for line in plan_of(stored).splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffled) == 1 and "zone_id" in shuffled[0]
    direct = zone_daily(obs, zones, views.GRID, weights, units=views.UNITS, all_zones=False)
    assert stored.exceptAll(direct).count() == direct.exceptAll(stored).count() == 0
    spark.sql("DROP TABLE obs_by_row")


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_zones_from_files(spark, fmt):
    path = storage.fresh_path(spark, "zones")
    zones = views.zones(spark, SF)
    zones.write.format(fmt).save(path)
    back = tables.scan_zones(spark, path, fmt)
    assert sorted(back.collect()) == sorted(zones.collect())


def test_fixed_schemas(spark):
    table = zone_daily(
        views.in_model_units(views.grid_obs(spark, SF)), views.zones(spark, SF), views.GRID, units=views.UNITS
    )
    found = [(f.name, f.dataType) for f in table.schema]
    assert found == [(f.name, f.dataType) for f in ZONE_DAILY]
