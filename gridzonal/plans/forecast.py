"""Forecast runs: every lead hour of every variable to zones, in one plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridzonal.functions.numeric import convert_units, present, round_to
from gridzonal.functions.times import DEFAULT_ZONE, local_time, valid_time
from gridzonal.operators.coverage import footprint, require_valid, zone_weights
from gridzonal.operators.joins import BROADCAST_ROWS
from gridzonal.operators.zonal import collapse_to_box, complete_zones, prune_to_box, zonal_mean
from gridzonal.schema import GridSpec


def zone_forecast(
    obs: DataFrame,
    zones: DataFrame,
    spec: GridSpec,
    weights: DataFrame | None = None,
    units: Mapping[str, tuple[float, float, str]] | None = None,
    profile: str = "default",
    zone_name: str = DEFAULT_ZONE,
    digits: int = 2,
    all_zones: bool = True,
) -> DataFrame:
    """(variable, run_time, lead_hour, code_muni, valid_time, local_time, value).

    All runs, lead hours and variables are one join and one shuffle of the observations, and
    ``all_zones`` adds NULL rows for zones without a cell. A zone that fails validation stops the job.
    """
    layer = ["variable", "run_time", "lead_hour"]
    zones = require_valid(zones)
    box = footprint(zones, spec)
    weight_rows = box.rows
    if weights is None:
        weights = zone_weights(zones, spec)
    else:
        # Stored weights may be those of other zones too, so they are counted.
        weights = weights.filter(F.col("grid_id") == spec.grid_id)
        weight_rows = weights.count()
    means = zonal_mean(
        (collapse_to_box if all_zones else prune_to_box)(obs, box).withColumn("value", present(F.col("value"))),
        weights,
        layer,
        weight_rows=weight_rows,
        digits=None,
        grid_id=spec.grid_id,
        keep_groups=all_zones,
    )
    if all_zones:
        means = complete_zones(means, zones, layer, box.zones)
    value = round_to(convert_units(F.col("value"), F.col("variable"), units, profile), digits)
    instant = valid_time(F.col("run_time"), F.col("lead_hour"))
    return means.select(
        "variable",
        "run_time",
        "lead_hour",
        F.col("zone_id").alias("code_muni"),
        instant.alias("valid_time"),
        local_time(instant, zone_name).alias("local_time"),
        value.alias("value"),
    )


def current_run(table: DataFrame, by: Sequence[str] = ("variable",)) -> DataFrame:
    """The rows of the newest run of each variable.

    The newest run per variable is an aggregate that reads two columns. It is broadcast, because variables are few: with
    more than ``BROADCAST_ROWS`` of them the job stops. Nothing runs before the action. Over a table
    partitioned by run, only the partitions of those runs are read, for each variable its own.
    """
    newest = table.groupBy(*by).agg(F.max("run_time").alias("run_time"))
    # The window holds a row per variable. The comparison is what lets Spark prune partitions by the broadcast.
    number = F.count(F.lit(1)).over(Window.partitionBy())
    few = F.when(number <= BROADCAST_ROWS, F.col("run_time")).otherwise(F.raise_error(F.lit("too many variables")))
    newest = newest.withColumn("run_time", few).filter(F.col("run_time") > F.lit("0001-01-01").cast("timestamp_ntz"))
    return table.join(F.broadcast(newest), [*by, "run_time"], "left_semi")


def register_forecast_views(table: DataFrame, variables: list[str]) -> list[str]:
    """One temporary view (code_muni, date, value) per variable: ``o3_mun_forecast``."""
    names = []
    for variable in variables:
        name = f"{variable}_mun_forecast"
        (
            table.filter(F.col("variable") == variable)
            .select("code_muni", F.col("local_time").alias("date"), "value")
            .createOrReplaceTempView(name)
        )
        names.append(name)
    return names
