import datetime as dt

import pytest
from helpers import make_zones, plan_of, rectangle
from pyspark.sql import functions as F

from checks import views
from gridzonal.operators import joins
from gridzonal.operators.coverage import footprint, zone_weights
from gridzonal.operators.grid import daily_cell_stats
from gridzonal.operators.zonal import complete_zones, zonal_quantiles, prune_to_box, prune_to_cells, zonal_mean, zonal_stats
from gridzonal.plans.forecast import current_run, register_forecast_views, zone_forecast
from gridzonal.plans.reanalysis import register_series_views, zone_daily
from gridzonal.schema import GridSpec
from gridzonal.sources.tables import store_weights
from gridzonal.storage import fresh_path

UNIT = GridSpec("unit", 0.0, 0.0, 1.0, 1.0, 2, 1)
SF = "/root/testdata/sf0.001"


def cells(spark, rows):
    return spark.createDataFrame(rows, "day int, iy int, ix int, value double")


@pytest.fixture
def zones(spark):
    return make_zones(
        spark, {1: [("shell", rectangle(0, 0, 1.5, 1))], 2: [("shell", rectangle(8, 8, 9, 9))]}
    )


def means(df):
    return {(r.day, r.zone_id): r.value for r in df.collect()}


def test_weighted_mean(spark, zones):
    data = cells(spark, [(1, 0, 0, 10.0), (1, 0, 1, 40.0)])
    got = zonal_mean(data, zone_weights(zones, UNIT), ["day"], weight_rows=2)
    assert means(got) == {(1, 1): 20.0}


def test_missing_cell_is_left_out(spark, zones):
    data = cells(spark, [(1, 0, 0, 10.0), (1, 0, 1, None)])
    assert means(zonal_mean(data, zone_weights(zones, UNIT), ["day"], weight_rows=2)) == {(1, 1): 10.0}


def test_zone_without_cells_keeps_its_row(spark, zones):
    # On day 3 the only cell lies outside every zone.
    data = cells(spark, [(1, 0, 0, 10.0), (2, 0, 0, None), (3, -1, -1, 5.0)])
    got = zonal_mean(data, zone_weights(zones, UNIT), ["day"], weight_rows=2, keep_groups=True)
    for zone_rows in (2, None):
        whole = means(complete_zones(got, zones, ["day"], zone_rows))
        assert whole == {(1, 1): 10.0, (1, 2): None, (2, 1): None, (2, 2): None, (3, 1): None, (3, 2): None}


def test_completing_needs_one_scan_and_spreads_groups(spark):
    path = fresh_path(spark, "obs")
    views.in_model_units(views.grid_obs(spark, SF)).write.parquet(path)
    zones = views.zones(spark, SF).filter("zone_id < 3")
    table = zone_daily(spark.read.parquet(path), zones, views.GRID, units=views.UNITS)
    assert plan_of(table).count(path.rsplit("/", 1)[1][:20]) == 1
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        used = zone_daily(spark.read.parquet(path), zones, views.GRID, units=views.UNITS).select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert used == 8


def test_weights_of_several_grids_are_kept_apart(spark, zones):
    data = cells(spark, [(1, 0, 0, 1.0), (1, 0, 1, 3.0)])
    own = zone_weights(zones, UNIT)
    both = own.unionByName(own.withColumn("grid_id", F.lit("other")))
    outputs = {"s": ("sum", "value"), "n": ("count", "value")}
    alone = zonal_stats(data, own, ["day"], outputs, 2).collect()
    assert zonal_stats(data, both, ["day"], outputs, 4, grid_id=UNIT.grid_id).collect() == alone


def test_count_without_a_valid_cell_is_zero(spark, zones):
    data = cells(spark, [(1, 0, 0, None), (1, 0, 1, None)])
    row = zonal_stats(data, zone_weights(zones, UNIT), ["day"], {"n": ("count", "value"), "m": ("mean", "value")}, 2).first()
    assert row.n == 0.0 and row.m is None


def test_zone_that_fails_validation_stops_the_plans(spark):
    zones = make_zones(spark, {9: [("shell", [(179.0, 0.0), (-179.0, 0.0), (-179.0, 2.0), (179.0, 2.0)])]})
    with pytest.raises(Exception, match="zone 9 is not valid"):
        zone_daily(views.grid_obs(spark, SF), zones, views.GRID, units=views.UNITS).collect()


def test_constant_field_gives_the_constant(spark):
    obs = views.grid_obs(spark, SF).withColumn("value", F.lit(7.0))
    zones = views.zones(spark, SF)
    daily = daily_cell_stats(obs, ["mean"])
    got = zonal_mean(daily, zone_weights(zones, views.GRID), ["variable", "date"], "v_mean", 342)
    assert [r.value for r in got.select("value").distinct().collect()] == [7.0]


def test_all_statistics(spark, zones):
    data = cells(spark, [(1, 0, 0, 10.0), (1, 0, 1, 40.0)])
    outputs = {name: (name, "value") for name in ("mean", "sum", "count", "min", "max")}
    row = zonal_stats(data, zone_weights(zones, UNIT), ["day"], outputs, 2).first()
    assert (row["mean"], row["sum"], row["count"], row["min"], row["max"]) == (20.0, 30.0, 1.5, 10.0, 40.0)


def test_unknown_statistic(spark, zones):
    with pytest.raises(ValueError, match="median"):
        zonal_stats(cells(spark, []), zone_weights(zones, UNIT), ["day"], {"x": ("median", "value")})


def test_min_mean_max_are_ordered(spark):
    table = zone_daily(
        views.grid_obs(spark, SF), views.zones(spark, SF), views.GRID, units={k: (1.0, 0.0, "") for k in views.UNITS}
    )
    wide = table.groupBy("variable", "code_muni", "date").pivot("stat", ["min", "mean", "max"]).agg(F.first("value"))
    wide = wide.filter("coalesce(min, mean, max) is not null")
    assert wide.count() > 0
    assert wide.filter("min > mean or mean > max or min is null").count() == 0


def test_documented_values(spark):
    """All event types together at sf0.01: 750 zone-days, zone 0 at 40.47 and 44.85."""
    sf = "/root/testdata/sf0.01"
    zones = views.zones(spark, sf)
    daily = daily_cell_stats(views.grid_obs(spark, sf), ["mean"], by=["date"])
    got = zonal_mean(daily, zone_weights(zones, views.GRID), ["date"], "v_mean", 342)
    rows = {(r.zone_id, r.date): r.value for r in got.collect()}
    assert len(rows) == 750
    assert rows[0, dt.date(2024, 1, 1)] == 40.47 and rows[0, dt.date(2024, 1, 2)] == 44.85


def test_shuffled_join_gives_the_broadcast_result(spark):
    """One cell holds a third of all rows; with no known bound nothing is broadcast."""
    zones = views.zones(spark, SF)
    weights = zone_weights(zones, views.GRID).persist()
    obs = views.grid_obs(spark, SF)
    hot = obs.withColumn("iy", F.lit(1)).withColumn("ix", F.lit(1)).limit(obs.count() // 2)
    skewed = obs.unionByName(hot).withColumn("step", F.col("valid_time"))
    by = ["variable", "date"]
    bound = footprint(zones, views.GRID).rows
    near = zonal_mean(skewed, weights, by, weight_rows=bound)
    far = zonal_mean(skewed, weights, by, weight_rows=None)
    assert "BroadcastHashJoin" in plan_of(near)
    key = lambda df: {(r.variable, r.date, r.zone_id): r.value for r in df.collect()}
    assert key(near) == key(far)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in plan_of(zonal_mean(skewed, weights, by, weight_rows=None))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_unbounded_joins_keep_their_meaning(spark, how):
    big = spark.range(3000).selectExpr("if(id < 1000, 7, id % 50) AS k", "id")
    small = spark.range(0, 60, 2).selectExpr("id AS k", "id * 10 AS payload")
    plain = big.join(small, "k", how)
    shuffled = joins.join_checked(big, small, ["k"], None, how)
    assert sorted(map(tuple, shuffled.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_join_type_that_would_repeat_rows_is_refused(spark):
    with pytest.raises(ValueError):
        joins.join_checked(spark.range(1), spark.range(1), ["id"], None, "full")


def test_frame_is_the_whole_product(spark):
    left = spark.range(7).withColumnRenamed("id", "a")
    right = spark.range(11).withColumnRenamed("id", "b")
    frame = joins.frame_of(left, right, ["b"], buckets=4)
    assert frame.count() == frame.distinct().count() == 77
    plan = plan_of(frame)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_pruning_changes_nothing(spark):
    zones = views.zones(spark, SF).filter("zone_id = 7")
    box = footprint(zones, views.GRID)
    weights = store_weights(zones, views.GRID, fresh_path(spark, "weights"))
    obs = views.grid_obs(spark, SF)
    boxed = prune_to_box(obs, box)
    pruned = prune_to_cells(boxed, weights, box.rows)
    assert 0 < pruned.count() < obs.count()
    by = ["variable", "date"]
    result = lambda d: sorted(map(tuple, zonal_mean(daily_cell_stats(d, ["mean"]), weights, by, "v_mean", box.rows).collect()))
    assert result(pruned) == result(boxed) == result(obs)


def test_stored_weights_give_the_same_table(spark):
    zones = views.zones(spark, SF)
    weights = store_weights(zones, views.GRID, fresh_path(spark, "weights"))
    obs = views.in_model_units(views.grid_obs(spark, SF))
    direct = zone_daily(obs, zones, views.GRID, units=views.UNITS)
    stored = zone_daily(obs, zones, views.GRID, weights=weights, units=views.UNITS)
    assert direct.exceptAll(stored).count() == stored.exceptAll(direct).count() == 0


@pytest.mark.parametrize("partitions", [1, 3, 13])
def test_order_and_partitioning_do_not_matter(spark, partitions):
    obs = views.in_model_units(views.grid_obs(spark, SF))
    zones = views.zones(spark, SF)
    expected = zone_daily(obs, zones, views.GRID, units=views.UNITS)
    mixed = obs.repartition(partitions).orderBy(F.hash("value"))
    got = zone_daily(mixed, zones, views.GRID, units=views.UNITS)
    assert expected.exceptAll(got).count() == got.exceptAll(expected).count() == 0


def test_scattered_zones_are_pruned_by_cell(spark):
    """Two far corners fill little of their box, so the plan drops the cells between; the table is the same."""
    zones = views.zones(spark, SF).filter("zone_id in (0, 24)")
    weights = store_weights(zones, views.GRID, fresh_path(spark, "weights"))
    obs = views.in_model_units(views.grid_obs(spark, SF))
    pruned = zone_daily(obs, zones, views.GRID, weights, units=views.UNITS)
    direct = zone_daily(obs, zones, views.GRID, units=views.UNITS)
    some = zone_daily(obs, zones, views.GRID, weights, units=views.UNITS, all_zones=False)
    assert "LeftSemi" in plan_of(some) and "_touched" in plan_of(pruned) and "_touched" not in plan_of(direct)
    assert direct.exceptAll(pruned).count() == pruned.exceptAll(direct).count() == 0


def test_series_views(spark):
    stored = spark.createDataFrame(
        [("pm25", "mean", 1, dt.date(2024, 1, 1), 5.0), ("pm25", "max", 1, dt.date(2024, 1, 1), 9.0)],
        "variable string, stat string, code_muni bigint, date date, value double",
    )
    assert register_series_views(stored, ["pm25"]) == ["pm25_mean_mean", "pm25_max_mean", "pm25_min_mean"]
    assert [tuple(r) for r in spark.table("pm25_max_mean").collect()] == [(1, dt.date(2024, 1, 1), 9.0)]
    assert spark.table("pm25_min_mean").count() == 0


def test_forecast_of_one_run(spark, zones):
    rows = [
        ("o3", dt.datetime(2025, 7, 9, 12), lead, 0, ix, value)
        for lead in (0, 120)
        for ix, value in ((0, 0.0067), (1, 0.0067))
    ]
    obs = spark.createDataFrame(
        rows, "variable string, run_time timestamp_ntz, lead_hour int, iy int, ix int, value double"
    )
    table = zone_forecast(obs, zones, UNIT)
    rows = table.orderBy("lead_hour", "code_muni").collect()
    assert [(r.lead_hour, r.value) for r in rows if r.code_muni == 2] == [(0, None), (120, None)]
    got = [(r.lead_hour, r.valid_time, r.local_time, r.value) for r in rows if r.code_muni == 1]
    assert got == [
        (0, dt.datetime(2025, 7, 9, 12), dt.datetime(2025, 7, 9, 9), 299.48),
        (120, dt.datetime(2025, 7, 14, 12), dt.datetime(2025, 7, 14, 9), 299.48),
    ]
    assert register_forecast_views(table, ["o3"]) == ["o3_mun_forecast"]
    assert spark.table("o3_mun_forecast").columns == ["code_muni", "date", "value"]


def test_current_run_per_variable(spark):
    rows = [("a", dt.datetime(2025, 1, 1), 1), ("a", dt.datetime(2025, 1, 2), 2), ("b", dt.datetime(2025, 1, 1), 3)]
    table = spark.createDataFrame(rows, "variable string, run_time timestamp_ntz, n int")
    assert sorted(r.n for r in current_run(table).collect()) == [2, 3]


def test_current_run_reads_only_recent_partitions(spark):
    path = fresh_path(spark, "forecasts")
    table = views.grid_forecast(spark, SF)
    table.write.partitionBy("run_time").parquet(path)
    stored = spark.read.schema(table.schema).parquet(path)
    newest = current_run(stored)
    assert "dynamicpruning" in plan_of(newest).split("PartitionFilters")[1]
    expected = current_run(table)
    assert newest.select(*table.columns).exceptAll(expected).count() == 0
    assert newest.count() == expected.count() > 0


def test_current_run_of_nothing(spark):
    empty = spark.createDataFrame([], "variable string, run_time timestamp_ntz, n int")
    assert current_run(empty).count() == 0


def weighted_quantile(pairs, p):
    pairs = sorted(pairs)
    n, places, before = len(pairs), [], 0.0
    for k, (_value, weight) in enumerate(pairs):
        places.append(k * weight + (n - 1) * before)
        before += weight
    if n == 1:
        return pairs[0][0]
    at = p * places[-1]
    for k in range(n - 1):
        if places[k] <= at <= places[k + 1] and places[k] < places[k + 1]:
            return pairs[k][0] + (pairs[k + 1][0] - pairs[k][0]) * (at - places[k]) / (places[k + 1] - places[k])
    return pairs[-1][0]


def test_quantiles_next_to_brute_force(spark):
    import random

    import numpy as np

    rng = random.Random(3)
    weights = [(z, iy, ix, rng.choice([1.0, 1.0, 0.5, rng.random() + 0.01])) for z in range(6) for iy in range(5) for ix in range(5) if rng.random() < 0.4]
    weights.append((9, 4, 4, 0.25))
    cells = [(d, iy, ix, rng.choice([None, 1.5, 2.0, rng.random() * 9])) for d in range(3) for iy in range(5) for ix in range(5)]
    cells += [(7, iy, ix, None) for iy in range(5) for ix in range(5)]
    asked = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.9, "e": 1.0}
    wt = spark.createDataFrame(weights, "zone_id long, iy int, ix int, fraction double")
    found = zonal_quantiles(spark.createDataFrame(cells, "day int, iy int, ix int, v double"), wt, ["day"], asked, "v", len(weights))
    got = {(r.day, r.zone_id): [r[name] for name in asked] for r in found.collect()}
    groups = {}
    for day, iy, ix, value in cells:
        for zone, wy, wx, fraction in weights:
            if (iy, ix) == (wy, wx):
                groups.setdefault((day, zone), []).append((value, fraction))
    assert set(got) == set(groups)
    for key, pairs in groups.items():
        pairs = [(v, w) for v, w in pairs if v is not None]
        want = [weighted_quantile(pairs, p) if pairs else None for p in asked.values()]
        assert got[key] == pytest.approx(want), key
    # Equal fractions give the usual quantiles.
    even = spark.createDataFrame([(1, 0, ix, 0.5) for ix in range(7)], "zone_id long, iy int, ix int, fraction double")
    values = [rng.random() for _ in range(7)]
    df = spark.createDataFrame([(0, 0, ix, v) for ix, v in enumerate(values)], "day int, iy int, ix int, v double")
    row = zonal_quantiles(df, even, ["day"], asked, "v").first()
    assert [row[name] for name in asked] == pytest.approx([np.quantile(values, p) for p in asked.values()])
    with pytest.raises(ValueError, match="probabilities"):
        zonal_quantiles(df, even, ["day"], {"x": 1.5}, "v")
