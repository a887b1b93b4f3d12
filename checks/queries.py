"""One callable per operator of the inventory: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as v
from gridzonal import sinks
from gridzonal.functions import names, times
from gridzonal.functions.numeric import convert_units, round_to
from gridzonal.operators import grid, series, zonal
from gridzonal.operators.coverage import footprint, validate_zones, zone_edges, zone_weights
from gridzonal.plans.export import daily_report as report_by_day
from gridzonal.plans.export import monthly_report as report_by_month
from gridzonal.plans.forecast import current_run, zone_forecast
from gridzonal.plans.reanalysis import register_series_views, zone_daily
from gridzonal.schema import DAY_STEPS_O3, GridSpec
from gridzonal.sources import grid_files, layers, manifest, tables
from gridzonal.storage import fresh_path, materialise
from gridzonal.streaming.daily import daily_stats, grow_daily_states
from gridzonal.streaming.ingest import append_new, replace_runs, stored_runs, stream_parquet

FIRST_DAY, LAST_DAY = dt.date(2023, 12, 25), dt.date(2024, 2, 4)
OBS_COLUMNS = ["variable", "valid_time", "date", "iy", "ix", "value"]
FINE_GRID = GridSpec("fine", -0.5, -0.5, 0.5, 0.5, 26, 18)
TARGET_ZONE = 5100003


def exact(value: Column) -> Column:
    """Nine decimals, so that the order of a floating-point sum does not show."""
    return value.cast("decimal(28,9)").cast("double")


# Sources and manifests


def parquet_scan(spark: SparkSession, sf: str) -> DataFrame:
    return tables.scan_parquet(spark, f"{sf}/orders.parquet").select(
        "o_orderkey", F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("value")
    )


def table_scan(spark: SparkSession, sf: str) -> DataFrame:
    stored = v.zone_daily(spark, sf).withColumn("variable", F.lit("price"))
    register_series_views(stored, ["price"])
    return tables.scan_table(spark, "price_max_mean")


def zone_edge_table(spark: SparkSession, sf: str) -> DataFrame:
    return zone_edges(v.zones(spark, sf)).select(
        "zone_id", "edge", *[exact(F.col(c)).alias(c) for c in ("lon_a", "lat_a", "lon_b", "lat_b")], "weight"
    )


def _variables(spark: SparkSession, sf: str) -> DataFrame:
    return v.table(spark, sf, "events").select(F.col("event_type").alias("variable")).distinct()


def request_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Days given as texts; one variable stands for ozone, which has six steps a day."""
    ozone = F.when(F.col("variable") == "purchase", "o3").otherwise(F.col("variable"))
    return manifest.request_manifest(_variables(spark, sf).withColumn("variable", ozone), "2023-12-25", "2024-02-04")


def lead_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return manifest.lead_manifest(v.grid_forecast(spark, sf).select("run_time").distinct())


def first_marker(spark: SparkSession, sf: str) -> DataFrame:
    """Markers are written as files; the first of the listing tells the run."""
    folder = fresh_path(spark, "markers")
    sinks.write_run_markers(v.grid_forecast(spark, sf), folder)
    return grid_files.first_match(grid_files.list_markers(spark, folder))


def missing_days(spark: SparkSession, sf: str) -> DataFrame:
    planned = manifest.day_manifest(_variables(spark, sf), FIRST_DAY, LAST_DAY)
    todo = manifest.missing(planned, v.present_days(spark, sf), ["variable", "date"])
    return manifest.newest_first(todo, "variable")


def missing_steps(spark: SparkSession, sf: str) -> DataFrame:
    hours = [f"{hour:02d}:00" for hour in range(24)]
    planned = manifest.request_manifest(_variables(spark, sf), FIRST_DAY, LAST_DAY, hours)
    hour = F.lpad(F.hour("valid_time").cast("string"), 2, "0")
    seen = v.grid_obs(spark, sf).select("variable", "date", F.concat(hour, F.lit(":00")).alias("step"))
    return manifest.missing(planned, seen, ["variable", "date", "step"]).select("variable", "date", "step")


# Grid files: the daily grids are written as files and read back


def _daily_files(spark: SparkSession, sf: str, time_axis: bool = True) -> str:
    folder = fresh_path(spark, "daily-grids")
    sinks.write_grid_files(grid.daily_cell_stats(v.grid_obs(spark, sf)), folder, v.GRID, time_axis=time_axis)
    return folder


def _scanned(spark: SparkSession, folder: str) -> DataFrame:
    return grid_files.scan_grid_files(spark, folder, v.GRID).select(
        "variable", "date", "stat", "iy", "ix", "lat", "lon", exact(F.col("value")).alias("value")
    )


def grid_file_scan(spark: SparkSession, sf: str) -> DataFrame:
    """All three statistics side by side, from one scan."""
    return _scanned(spark, _daily_files(spark, sf))


def grid_file_scan_undated(spark: SparkSession, sf: str) -> DataFrame:
    """The files have no times; the day comes from the name."""
    return _scanned(spark, _daily_files(spark, sf, time_axis=False))


def forecast_file_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Files of one run beside a marker that names it: the layer is the lead hour."""
    folder = fresh_path(spark, "forecast-files")
    sinks.write_grid_files(grid.daily_cell_stats(v.grid_obs(spark, sf), ["max"]), folder, v.GRID, ["max"], time_axis=False)
    sinks.write_run_markers(v.grid_forecast(spark, sf).agg(F.max("run_time").alias("run_time")), folder)
    run = grid_files.marker_run_time(spark, folder)
    scanned = grid_files.scan_grid_files(spark, folder, v.GRID, run_time=run)
    return scanned.groupBy("variable", "run_time", "lead_hour", "valid_time").agg(
        F.count("value").alias("n"), F.max("value").alias("largest")
    )


def scan_by_pattern(spark: SparkSession, sf: str) -> DataFrame:
    return grid_files.list_files(spark, _daily_files(spark, sf), r"min\.nc$").select(
        "name",
        names.variable_from_name(F.col("name")).alias("variable"),
        names.date_from_name(F.col("name")).alias("date"),
    )


def missing_files(spark: SparkSession, sf: str) -> DataFrame:
    """Days of the manifest for which no daily file of the mean was written."""
    written = grid_files.days_of(grid_files.list_files(spark, _daily_files(spark, sf), r"_mean\.nc$"))
    planned = manifest.day_manifest(_variables(spark, sf), FIRST_DAY, LAST_DAY)
    return manifest.missing(planned, written, ["variable", "date"])


# Sinks


def append_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "append")
    obs = v.grid_obs(spark, sf)
    half = F.lit(dt.date(2024, 1, 16))
    sinks.append(obs.filter(F.col("date") < half), path, ["variable", "date"])
    sinks.append(obs.filter(F.col("date") >= half), path, ["variable", "date"])
    return tables.scan_parquet(spark, path).select(*OBS_COLUMNS)


def mixed_appends(spark: SparkSession, sf: str) -> DataFrame:
    """The streaming ingest makes the table, a batch append adds to it, and the ingest goes on."""
    work = fresh_path(spark, "mixed")
    obs = v.grid_obs(spark, sf).select(*OBS_COLUMNS)
    days = [F.lit(dt.date(2024, 1, day)) for day in (11, 21)]

    def ingest(part: DataFrame, drop: str) -> None:
        part.write.parquet(f"{work}/landing/{drop}")
        landed = stream_parquet(spark, f"{work}/landing", obs.schema).drop("source_file", "drop", "delivered")
        append_new(landed, f"{work}/table", f"{work}/checkpoint").awaitTermination()

    ingest(obs.filter(F.col("date") < days[0]), "first")
    sinks.append(obs.filter(F.col("date").between(days[0], days[1])), f"{work}/table", ["variable", "date"])
    ingest(obs.filter(F.col("date") > days[1]), "second")
    return spark.read.parquet(f"{work}/table").select(*OBS_COLUMNS)


def rebuild_table(spark: SparkSession, sf: str) -> DataFrame:
    """A stored table is rebuilt from itself."""
    name = f"prices_{uuid.uuid4().hex}"
    sinks.rebuild_table(v.zone_daily(spark, sf), name)
    doubled = tables.scan_table(spark, name).withColumn("value", F.col("value") * 2)
    sinks.rebuild_table(doubled, name)
    return tables.scan_table(spark, name).withColumn("value", round_to(F.col("value")))


def list_tables(spark: SparkSession, sf: str) -> DataFrame:
    """One stored table for each variable, found again in the catalog."""
    database = f"series_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    obs = v.grid_obs(spark, sf)
    for variable in v.UNITS:
        daily = obs.filter(F.col("variable") == variable).groupBy("date").agg(F.count("value").alias("n"))
        sinks.rebuild_table(daily, f"{database}.{variable}_daily")
    return sinks.list_tables(spark, database)


def replace_table(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "replace")
    daily = v.zone_daily(spark, sf)
    sinks.replace(daily.withColumn("value", F.col("value") * 2), path, ["stat"])
    sinks.replace(daily, path, ["stat"])
    return tables.scan_parquet(spark, path).select(
        "code_muni", "date", "stat", round_to(F.col("value")).alias("value")
    )


def grid_daily_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "grid-daily")
    obs = v.grid_obs(spark, sf)
    later = obs.filter(F.col("date") >= F.lit(dt.date(2024, 1, 16)))
    wrong = grid.daily_cell_stats(obs.withColumn("value", F.lit(-1.0)))
    sinks.replace_partitions(wrong, path, ["variable", "date"])
    sinks.replace_partitions(grid.daily_cell_stats(later), path, ["variable", "date"])
    return tables.scan_parquet(spark, path).select(
        "variable", "date", "iy", "ix", exact(F.col("v_mean")).alias("v_mean"), "v_max", "v_min", "n_steps"
    )


def export_parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "export-parquet")
    sinks.export_parquet(v.zone_daily(spark, sf), path)
    return tables.scan_parquet(spark, path).withColumn("value", round_to(F.col("value")))


def export_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "export-csv")
    wide = series.pivot_stats(v.stacked(spark, sf), ["code_muni", "date"])
    sparse = wide.withColumn("max", F.when(F.col("max") > F.col("min"), F.col("max")))
    sinks.export_csv(sparse, path, null_value="NA")
    schema = "code_muni bigint, date date, mean double, max double, min double"
    return (
        spark.read.schema(schema).option("header", True).option("nullValue", "NA").csv(path)
        .withColumn("mean", round_to(F.col("mean")))
    )


# Grid operators


def grid_normalise(spark: SparkSession, sf: str) -> DataFrame:
    world = GridSpec("world", -180.0, -90.0, 24.0, 18.0, 15, 10)
    raw = v.grid_obs(spark, sf).select(
        "variable", "valid_time", (F.col("ix") * 24.0).alias("lon"), (F.col("iy") * 18.0 - 81.0).alias("lat"), "value"
    )
    return grid.normalise_grid(raw, world)


def bbox_filter(spark: SparkSession, sf: str) -> DataFrame:
    return v.grid_obs(spark, sf).filter(grid.in_area(5.0, 2.0, 1.5, 8.0)).select(*OBS_COLUMNS)


def lead_slice(spark: SparkSession, sf: str) -> DataFrame:
    return v.grid_forecast(spark, sf).filter(grid.at_layer(25))


def _run_files(spark: SparkSession, sf: str) -> tuple[str, Column]:
    """A file for every variable and run, with a layer for every lead hour, and the run time that a file's name tells."""
    folder = fresh_path(spark, "run-files")
    stamp = F.date_format("run_time", "yyyyMMddHH")
    cells = v.grid_forecast(spark, sf).groupBy("variable", "run_time", "lead_hour", "iy", "ix").agg(F.max("value").alias("value"))
    named = cells.select(
        F.concat(F.lit("run_"), "variable", F.lit("_"), stamp, F.lit(".nc")).alias("source_file"),
        "variable", F.col("lead_hour").alias("layer"), "iy", "ix", "value",
    )
    layers.write_grid_layers(named, folder, v.GRID)
    return folder, F.to_timestamp_ntz(F.regexp_extract("path", r"_(\d{10})\.nc$", 1), F.lit("yyyyMMddHH"))


RUN_COLUMNS = ("variable", "run_time", "lead_hour", "valid_time", "iy", "ix", "value")


def lead_slice_files(spark: SparkSession, sf: str) -> DataFrame:
    """One layer of each of the runs' files: only its bytes are read."""
    folder, run_time = _run_files(spark, sf)
    runs = layers.scan_run_layers(spark, folder, v.GRID, run_time)
    return runs.filter(grid.at_layer(25)).filter("value IS NOT NULL").select(*RUN_COLUMNS)


def run_files_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The runs' files, read back whole in ranges of a few rows."""
    folder, run_time = _run_files(spark, sf)
    runs = layers.scan_run_layers(spark, folder, v.GRID, run_time, range_bytes=1 << 16)
    return runs.filter("value IS NOT NULL").select(*RUN_COLUMNS)


def step_filter(spark: SparkSession, sf: str) -> DataFrame:
    return v.grid_obs(spark, sf).filter(grid.at_steps(DAY_STEPS_O3)).select(*OBS_COLUMNS)


def variable_filter(spark: SparkSession, sf: str) -> DataFrame:
    return v.grid_obs(spark, sf).filter(F.col("variable") == "purchase").select(*OBS_COLUMNS)


def _cell_stats(spark: SparkSession, sf: str, strict: bool) -> DataFrame:
    daily = grid.daily_cell_stats(v.grid_obs(spark, sf, with_nulls=True), strict=strict)
    return daily.withColumn("v_mean", exact(F.col("v_mean")))


def daily_cell_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _cell_stats(spark, sf, strict=False)


def daily_cell_stats_strict(spark: SparkSession, sf: str) -> DataFrame:
    return _cell_stats(spark, sf, strict=True)


def layer_minmax(spark: SparkSession, sf: str) -> DataFrame:
    return grid.layer_minmax(v.grid_forecast(spark, sf))


def value_domain(spark: SparkSession, sf: str) -> DataFrame:
    return grid.value_domain(v.grid_forecast(spark, sf))


def regrid_bilinear(spark: SparkSession, sf: str) -> DataFrame:
    daily = grid.daily_cell_stats(v.grid_obs(spark, sf), ["mean"])
    fine = grid.regrid_bilinear(daily, v.GRID, FINE_GRID, "v_mean")
    return fine.withColumn("v_mean", exact(F.col("v_mean")))


def regrid_global(spark: SparkSession, sf: str) -> DataFrame:
    """A closed grid is resampled across its seam."""
    daily = grid.daily_cell_stats(v.grid_obs(spark, sf), ["mean"])
    target = GridSpec("target", -179.3, -89.3, 9.9, 9.9, 36, 18)
    return grid.regrid_bilinear(daily, v.WORLD, target, "v_mean").withColumn("v_mean", exact(F.col("v_mean")))


# Zones


def zone_weights_global(spark: SparkSession, sf: str) -> DataFrame:
    return zone_weights(v.zones_world(spark, sf), v.WORLD).withColumn("fraction", exact(F.col("fraction")))


def zone_weights_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Zones with a hole and a second part, stored as files and read back."""
    path = fresh_path(spark, "zones")
    sinks.export_parquet(v.zones_parts(spark, sf), path)
    return zone_weights(tables.scan_zones(spark, path), v.GRID).withColumn("fraction", exact(F.col("fraction")))


def zonal_shuffle_join(spark: SparkSession, sf: str) -> DataFrame:
    """With no bound on the weights nothing is broadcast for being small."""
    daily = grid.daily_cell_stats(v.grid_obs(spark, sf), ["mean"])
    return zonal.zonal_mean(daily, zone_weights(v.zones(spark, sf), v.GRID), ["variable", "date"], "v_mean", None)


def zonal_stored_weights(spark: SparkSession, sf: str) -> DataFrame:
    """Weights of two grids in one table; scattered zones, so that cells are pruned by cell."""
    path = fresh_path(spark, "weights")
    zones = v.zones_small(spark, sf)
    tables.store_weights(zones, v.GRID, f"{path}/grid=demo")
    tables.store_weights(zones, FINE_GRID, f"{path}/grid=fine")
    stored = spark.read.parquet(path).drop("grid")
    obs = v.in_model_units(v.grid_obs(spark, sf))
    return zone_daily(obs, zones, v.GRID, stored, units=v.UNITS)


def zone_weight_table(spark: SparkSession, sf: str) -> DataFrame:
    return zone_weights(v.zones(spark, sf), v.GRID).withColumn("fraction", exact(F.col("fraction")))


def zone_validate(spark: SparkSession, sf: str) -> DataFrame:
    # Moved far enough east that some zones leave the valid range of longitudes.
    moved = v.zones(spark, sf).withColumn(
        "rings",
        F.transform(
            "rings",
            lambda r: F.struct(
                r["role"].alias("role"),
                F.transform(
                    r["pts"], lambda p: F.struct((p["lon"] + 172.0).alias("lon"), p["lat"].alias("lat"))
                ).alias("pts"),
            ),
        ),
    )
    return validate_zones(moved)


def zonal_daily_mean(spark: SparkSession, sf: str) -> DataFrame:
    zones = v.zones(spark, sf)
    box = footprint(zones, v.GRID)
    cells = zonal.prune_to_box(v.grid_obs(spark, sf), box)
    daily = grid.daily_cell_stats(cells, ["mean"], strict=True)
    weights = zone_weights(zones, v.GRID)
    return zonal.zonal_mean(daily, weights, ["variable", "date"], "v_mean", box.rows)


def zonal_daily_max_min(spark: SparkSession, sf: str) -> DataFrame:
    zones = v.zones(spark, sf)
    box = footprint(zones, v.GRID)
    daily = grid.daily_cell_stats(v.grid_obs(spark, sf), ["max", "min"], strict=True)
    outputs = {"max": ("mean", "v_max"), "min": ("mean", "v_min")}
    result = zonal.zonal_stats(daily, zone_weights(zones, v.GRID), ["variable", "date"], outputs, box.rows)
    return result.withColumns({name: round_to(F.col(name)) for name in outputs})


def zonal_multi_stat(spark: SparkSession, sf: str) -> DataFrame:
    zones = v.zones(spark, sf)
    box = footprint(zones, v.GRID)
    daily = grid.daily_cell_stats(v.grid_obs(spark, sf, with_nulls=True), ["mean"], strict=True)
    outputs = {f"z_{stat}": (stat, "v_mean") for stat in zonal.ZONAL_STATS}
    result = zonal.zonal_stats(daily, zone_weights(zones, v.GRID), ["variable", "date"], outputs, box.rows)
    return result.withColumns({name: round_to(F.col(name), 6) for name in outputs})


def zonal_median(spark: SparkSession, sf: str) -> DataFrame:
    """Median, lower quartile and ends of the cells of a zone and day."""
    zones = v.zones(spark, sf)
    daily = grid.daily_cell_stats(v.grid_obs(spark, sf, with_nulls=True), ["max"], strict=True)
    asked = {"median": 0.5, "lower": 0.25, "least": 0.0, "most": 1.0}
    by, rows = ["variable", "date"], footprint(zones, v.GRID).rows
    found = zonal.zonal_quantiles(daily, zone_weights(zones, v.GRID), by, asked, "v_max", rows)
    return found.withColumns({name: round_to(F.col(name), 6) for name in asked})


def zonal_left_complete(spark: SparkSession, sf: str) -> DataFrame:
    zones = v.zones_wide(spark, sf)
    box = footprint(zones, v.GRID)
    daily = grid.daily_cell_stats(v.grid_obs(spark, sf), ["mean"])
    by = ["variable", "date"]
    means = zonal.zonal_mean(daily, zone_weights(zones, v.GRID), by, "v_mean", box.rows, keep_groups=True)
    return zonal.complete_zones(means, zones, by, box.zones)


def zonal_forecast(spark: SparkSession, sf: str) -> DataFrame:
    zones = v.zones(spark, sf)
    box = footprint(zones, v.GRID)
    by = ["variable", "run_time", "lead_hour"]
    return zonal.zonal_mean(
        v.grid_forecast(spark, sf), zone_weights(zones, v.GRID), by, weight_rows=box.rows
    )


def reanalysis_zone_daily(spark: SparkSession, sf: str) -> DataFrame:
    obs = v.in_model_units(v.grid_obs(spark, sf, with_nulls=True))
    return zone_daily(obs, v.zones(spark, sf), v.GRID, units=v.UNITS)


def forecast_zone_table(spark: SparkSession, sf: str) -> DataFrame:
    obs = v.in_model_units(v.grid_forecast(spark, sf))
    return zone_forecast(obs, v.zones(spark, sf), v.GRID, units=v.UNITS)


def current_run_table(spark: SparkSession, sf: str) -> DataFrame:
    return current_run(v.grid_forecast(spark, sf))


# Series


def stack_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Three stored tables, one per statistic."""
    stored = materialise(v.zone_daily_wide(spark, sf), "price-stats")
    parts = {
        stat: stored.select("code_muni", "date", F.col(stat).alias("value"))
        for stat in series.STATS
    }
    return series.stack_stats(parts).withColumn("value", round_to(F.col("value")))


def monthly_mean(spark: SparkSession, sf: str) -> DataFrame:
    return series.monthly_mean(v.stacked(spark, sf)).withColumn("value", round_to(F.col("value")))


def export_monthly(spark: SparkSession, sf: str) -> DataFrame:
    recent = v.stacked(spark, sf).filter(times.from_year(F.col("date"), 1998))
    return series.export_monthly(recent).withColumn("pm25", round_to(F.col("pm25")))


def export_daily(spark: SparkSession, sf: str) -> DataFrame:
    return series.export_daily(v.stacked(spark, sf), 2000).withColumn("med", round_to(F.col("med")))


def _report_table(spark: SparkSession, sf: str) -> DataFrame:
    """The stored zone-day table, partitioned by variable and statistic."""
    path = fresh_path(spark, "series")
    sinks.append(v.zone_daily(spark, sf).withColumn("variable", F.lit("pm25")), path, ["variable", "stat"], ["code_muni", "date"])
    return tables.scan_parquet(spark, path)


def monthly_report(spark: SparkSession, sf: str) -> DataFrame:
    return report_by_month(_report_table(spark, sf), "pm25", 1998).withColumn("pm25", round_to(F.col("pm25")))


def daily_report(spark: SparkSession, sf: str) -> DataFrame:
    return report_by_day(_report_table(spark, sf), "pm25", 2000).withColumn("med", round_to(F.col("med")))


def pivot_stats(spark: SparkSession, sf: str) -> DataFrame:
    return series.pivot_stats(v.stacked(spark, sf), ["code_muni", "date"]).withColumn("mean", round_to(F.col("mean")))


def zone_series(spark: SparkSession, sf: str) -> DataFrame:
    means = v.zone_daily(spark, sf).filter("stat = 'mean'").drop("stat")
    return series.zone_series(means, TARGET_ZONE).withColumn("value", round_to(F.col("value")))


def year_from(spark: SparkSession, sf: str) -> DataFrame:
    daily = v.zone_daily(spark, sf).filter(times.from_year(F.col("date"), 1998))
    return daily.withColumn("year", F.year("date")).withColumn("value", round_to(F.col("value")))


def zone_monthly_2024(spark: SparkSession, sf: str) -> DataFrame:
    means = v.zone_daily(spark, sf).filter("stat = 'mean'").drop("stat")
    return series.zone_monthly(means, TARGET_ZONE, 2000).withColumn("value", round_to(F.col("value")))


def code6(spark: SparkSession, sf: str) -> DataFrame:
    return v.zone_daily(spark, sf).select(
        "code_muni", "date", "stat", names.code6(F.col("code_muni")).alias("cod6")
    )


def row_count(spark: SparkSession, sf: str) -> DataFrame:
    return series.row_count(v.grid_forecast(spark, sf))


def head_rows(spark: SparkSession, sf: str) -> DataFrame:
    return series.head_rows(
        v.grid_forecast(spark, sf), ["variable", "run_time", "lead_hour", "iy", "ix", "value"]
    )


# Scalar functions


def unit_convert(spark: SparkSession, sf: str) -> DataFrame:
    converted = convert_units(F.col("value"), F.col("variable"), v.UNITS)
    return v.grid_obs(spark, sf).select("variable", "valid_time", round_to(converted).alias("value"))


def round2(spark: SparkSession, sf: str) -> DataFrame:
    third = F.col("value") / 8
    return v.grid_obs(spark, sf).select("variable", "valid_time", round_to(third).alias("value"))


def date_from_name(spark: SparkSession, sf: str) -> DataFrame:
    return v.file_names(spark, sf).select(
        "name",
        names.variable_from_name(F.col("name")).alias("variable"),
        names.date_from_name(F.col("name")).alias("date"),
    )


def run_time_parse(spark: SparkSession, sf: str) -> DataFrame:
    marked = v.table(spark, sf, "events").select("event_id", names.run_marker(F.col("ts")).alias("marker"))
    return marked.select(
        "event_id",
        "marker",
        names.run_hour(F.col("marker")).alias("run_hour"),
        names.run_time_from_marker(F.col("marker")).alias("run_time"),
    )


def file_parts(spark: SparkSession, sf: str) -> DataFrame:
    paths = v.file_names(spark, sf).select(F.concat(F.lit("/data/daily.v1/"), "name").alias("path"))
    return paths.select(
        "path", names.base_name(F.col("path")).alias("base"), names.file_stem(F.col("path")).alias("stem")
    )


def expected_file_name(spark: SparkSession, sf: str) -> DataFrame:
    return v.present_days(spark, sf).withColumn(
        "target", names.grid_file_name(F.col("variable"), F.col("date"))
    )


def valid_time(spark: SparkSession, sf: str) -> DataFrame:
    return v.grid_forecast(spark, sf).select(
        "variable", "run_time", "lead_hour", times.valid_time(F.col("run_time"), F.col("lead_hour")).alias("valid_time")
    )


def local_time(spark: SparkSession, sf: str) -> DataFrame:
    instants = v.grid_forecast(spark, sf).select(
        "variable", times.valid_time(F.col("run_time"), F.col("lead_hour")).alias("valid_time")
    )
    # The same instants in a year with summer time as well.
    earlier = F.timestamp_add("DAY", F.lit(-2191), F.col("valid_time"))
    return instants.select(
        "variable",
        "valid_time",
        times.local_time(F.col("valid_time")).alias("local_time"),
        times.local_time(earlier).alias("local_time_earlier"),
    )


def latest_cycle(spark: SparkSession, sf: str) -> DataFrame:
    return v.table(spark, sf, "events").select("event_id", times.latest_cycle(F.col("ts")).alias("run_time"))


# Incremental ingestion


def incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Two drops land in a folder and the ingest runs three times; every row arrives once."""
    work = fresh_path(spark, "ingest")
    obs = v.grid_obs(spark, sf).select(*OBS_COLUMNS)
    half = F.lit(dt.date(2024, 1, 16))

    def ingest() -> None:
        landed = stream_parquet(spark, f"{work}/landing", obs.schema).drop("source_file", "drop", "delivered")
        append_new(landed, f"{work}/table", f"{work}/checkpoint").awaitTermination()

    obs.filter(F.col("date") < half).write.mode("append").parquet(f"{work}/landing/first")
    ingest()
    obs.filter(F.col("date") >= half).write.mode("append").parquet(f"{work}/landing/second")
    ingest()
    ingest()
    return spark.read.schema(obs.schema).parquet(f"{work}/table").select(*OBS_COLUMNS)


def daily_stats_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Three drops, the third with late steps of days that are there; each merges with the states of its own days."""
    work = fresh_path(spark, "daily")
    obs = v.grid_obs(spark, sf, with_nulls=True).select(*OBS_COLUMNS)
    late = F.hour("valid_time") >= 18
    drop = F.when(late, 3).when(F.col("date") < F.lit(dt.date(2024, 1, 16)), 1).otherwise(2)
    for number in (1, 2, 3):
        obs.filter(drop == number).write.parquet(f"{work}/landing/drop-{number}")
        landed = stream_parquet(spark, f"{work}/landing", obs.schema)
        grow_daily_states(landed, f"{work}/states", f"{work}/checkpoint").awaitTermination()
    return daily_stats(spark, f"{work}/states").withColumn("v_mean", exact(F.col("v_mean")))


def replace_runs_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Runs delivered twice before one trigger, the second time corrected, keep only their later rows."""
    work = fresh_path(spark, "runs")
    runs = v.grid_forecast(spark, sf)
    early = runs.filter(F.col("run_time") < F.lit("2024-01-08").cast("timestamp_ntz"))
    early.withColumn("value", F.lit(-1.0)).write.parquet(f"{work}/landing/drop-1")
    runs.write.parquet(f"{work}/landing/drop-2")
    landed = stream_parquet(spark, f"{work}/landing", runs.schema).drop("source_file", "delivered")
    replace_runs(landed, f"{work}/table", f"{work}/checkpoint", part=None, delivered="drop").awaitTermination()
    return stored_runs(spark, f"{work}/table", part=None, delivered="drop", schema=landed.schema).select(*runs.columns)


def split_run(spark: SparkSession, sf: str) -> DataFrame:
    """Every run comes in several files, one file to a micro-batch."""
    work = fresh_path(spark, "split")
    runs = v.grid_forecast(spark, sf)
    runs.repartition(3, "ix", "iy").write.parquet(f"{work}/landing/drop-1")
    landed = stream_parquet(spark, f"{work}/landing", runs.schema, max_files=1).drop("drop")
    replace_runs(landed, f"{work}/table", f"{work}/checkpoint").awaitTermination()
    return stored_runs(spark, f"{work}/table", schema=landed.schema).select(*runs.columns)


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "zonal_daily_mean": zonal_daily_mean,
    "grid_file_scan": grid_file_scan,
    "grid_file_scan_undated": grid_file_scan_undated,
    "forecast_file_scan": forecast_file_scan,
    "scan_by_pattern": scan_by_pattern,
    "parquet_scan": parquet_scan,
    "zone_edges": zone_edge_table,
    "table_scan": table_scan,
    "request_manifest": request_manifest,
    "lead_manifest": lead_manifest,
    "first_marker": first_marker,
    "append_roundtrip": append_roundtrip,
    "replace_table": replace_table,
    "export_parquet_roundtrip": export_parquet_roundtrip,
    "export_csv_roundtrip": export_csv_roundtrip,
    "grid_daily_roundtrip": grid_daily_roundtrip,
    "stack_stats": stack_stats,
    "monthly_mean": monthly_mean,
    "export_monthly": export_monthly,
    "export_daily": export_daily,
    "zone_series": zone_series,
    "year_from": year_from,
    "zone_monthly_2024": zone_monthly_2024,
    "bbox_filter": bbox_filter,
    "lead_slice": lead_slice,
    "lead_slice_files": lead_slice_files,
    "run_files_roundtrip": run_files_roundtrip,
    "step_filter": step_filter,
    "variable_filter": variable_filter,
    "zone_weights": zone_weight_table,
    "missing_days": missing_days,
    "missing_steps": missing_steps,
    "missing_files": missing_files,
    "zonal_left_complete": zonal_left_complete,
    "zonal_median": zonal_median,
    "daily_cell_stats": daily_cell_stats,
    "daily_cell_stats_strict": daily_cell_stats_strict,
    "zonal_multi_stat": zonal_multi_stat,
    "zonal_daily_max_min": zonal_daily_max_min,
    "zonal_forecast": zonal_forecast,
    "row_count": row_count,
    "layer_minmax": layer_minmax,
    "value_domain": value_domain,
    "head_rows": head_rows,
    "pivot_stats": pivot_stats,
    "unit_convert": unit_convert,
    "round2": round2,
    "code6": code6,
    "date_from_name": date_from_name,
    "run_time_parse": run_time_parse,
    "file_parts": file_parts,
    "expected_file_name": expected_file_name,
    "valid_time": valid_time,
    "local_time": local_time,
    "latest_cycle": latest_cycle,
    "grid_normalise": grid_normalise,
    "regrid_bilinear": regrid_bilinear,
    "zone_validate": zone_validate,
    "incremental_ingest": incremental_ingest,
    "daily_stats_incremental": daily_stats_incremental,
    "replace_runs": replace_runs_stream,
    "split_run": split_run,
    "mixed_appends": mixed_appends,
    "rebuild_table": rebuild_table,
    "list_tables": list_tables,
    "zone_weights_global": zone_weights_global,
    "zone_weights_parts": zone_weights_parts,
    "regrid_global": regrid_global,
    "zonal_shuffle_join": zonal_shuffle_join,
    "zonal_stored_weights": zonal_stored_weights,
    "monthly_report": monthly_report,
    "daily_report": daily_report,
    "current_run": current_run_table,
    "reanalysis_zone_daily": reanalysis_zone_daily,
    "forecast_zone_table": forecast_zone_table,
}
