"""Historical record: sub-daily grids to zone-day series."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridzonal.functions.numeric import convert_units, present, round_to
from gridzonal.operators.coverage import footprint, require_valid, zone_weights
from gridzonal.operators.grid import daily_cell_stats
from gridzonal.operators.series import STATS, melt_stats
from gridzonal.operators.zonal import collapse_to_box, complete_zones, prune_to_box, prune_to_cells, zonal_stats
from gridzonal.schema import GridSpec

# Zones that touch less of their common bounding box than this are worth a semi-join on cells.
SPARSE = 0.5


def zone_daily(
    obs: DataFrame,
    zones: DataFrame,
    spec: GridSpec,
    weights: DataFrame | None = None,
    units: Mapping[str, tuple[float, float, str]] | None = None,
    profile: str = "default",
    strict: bool = True,
    digits: int = 2,
    all_zones: bool = True,
) -> DataFrame:
    """Grid observations to (variable, stat, code_muni, date, value).

    Time first, then space: daily mean, max and min per cell, then the coverage-weighted mean of each
    over the zones, then unit conversion and rounding. All variables, days and statistics are one
    plan with two shuffles of the observations. Pass stored ``weights`` when the zone layer is large; with them, and zones
    scattered over their box, cells outside every zone are left out before the first shuffle.
    ``all_zones`` gives zones without a cell a row with NULL for every day on record: cells outside the zones'
    bounding box are then collapsed into one per day, and the result is exchanged once more. Without it they are dropped
    in the scan. A zone that fails validation stops the job.
    """
    zones = require_valid(zones)
    box = footprint(zones, spec)
    cells = (collapse_to_box if all_zones else prune_to_box)(obs, box).withColumn("value", present(F.col("value")))
    weight_rows = box.rows
    if weights is None:
        weights = zone_weights(zones, spec)
    else:
        # Stored weights may be those of other zones too, so they are counted.
        weights = weights.filter(F.col("grid_id") == spec.grid_id)
        weight_rows = weights.count()
        if box.rows < SPARSE * box.cells:
            cells = prune_to_cells(cells, weights, weight_rows, collapse=all_zones)
    daily = daily_cell_stats(cells, STATS, strict=strict)
    by_zone = zonal_stats(
        daily,
        weights,
        ["variable", "date"],
        {stat: ("mean", f"v_{stat}") for stat in STATS},
        weight_rows,
        spec.grid_id,
        keep_groups=all_zones,
    )
    if all_zones:
        by_zone = complete_zones(by_zone, zones, ["variable", "date"], box.zones)
    reported = [
        round_to(convert_units(F.col(stat), F.col("variable"), units, profile), digits).alias(stat)
        for stat in STATS
    ]
    wide = by_zone.select("variable", F.col("zone_id").alias("code_muni"), "date", *reported)
    return melt_stats(wide, ["variable", "code_muni", "date"]).select(
        "variable", "stat", "code_muni", "date", "value"
    )


def register_series_views(table: DataFrame, variables: list[str]) -> list[str]:
    """One temporary view (code_muni, date, value) per variable and statistic: ``pm25_max_mean``."""
    names = []
    for variable in variables:
        for stat in STATS:
            name = f"{variable}_{stat}_mean"
            (
                table.filter((F.col("variable") == variable) & (F.col("stat") == stat))
                .select("code_muni", "date", "value")
                .createOrReplaceTempView(name)
            )
            names.append(name)
    return names
