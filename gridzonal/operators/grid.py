"""Grid observations: normalising, selecting, daily reduction, value range, resampling."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridzonal.functions.numeric import REDUCERS, reducer
from gridzonal.schema import GridSpec


def wrap_longitude(lon: Column) -> Column:
    """Longitude in [-180, 180)."""
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def normalise_grid(cells: DataFrame, spec: GridSpec) -> DataFrame:
    """Wrap ``lon`` and derive ``iy``/``ix`` (south to north, west to east) from cell centres.

    On a closed grid every longitude has a column, wherever the grid begins.
    """
    east = F.col("lon") - spec.lon0
    if spec.closed:
        east = F.pmod(east, F.lit(360.0))
    return (
        cells.withColumn("lon", wrap_longitude(F.col("lon")))
        .withColumn("ix", F.least(F.floor(east / spec.dlon), F.lit(spec.nx - 1) if spec.closed else F.lit(2**31 - 1)).cast("int"))
        .withColumn("iy", F.floor((F.col("lat") - spec.lat0) / spec.dlat).cast("int"))
    )


def in_area(north: float, west: float, south: float, east: float) -> Column:
    """Bounding box on cell centres, edges included; plain ranges, so Parquet scans prune by it."""
    return F.col("lat").between(south, north) & F.col("lon").between(west, east)


def at_steps(steps: Sequence[str], time: str = "valid_time") -> Column:
    """Rows whose hour of day is one of the ``HH:MM`` steps."""
    return F.hour(time).isin([int(step[:2]) for step in steps])


def at_layer(layer: int) -> Column:
    """Layer by 1-based position; layer 1 is lead hour 0."""
    return F.col("lead_hour") == layer - 1


def daily_cell_stats(
    obs: DataFrame,
    stats: Sequence[str] = ("mean", "max", "min"),
    strict: bool = False,
    by: Sequence[str] = ("variable", "date"),
) -> DataFrame:
    """Reduce a day's steps per cell: ``v_<stat>`` for each stat, and ``n_steps``.

    All statistics come from one pass and one shuffle, after partial aggregation in the scan
    stage. ``strict`` gives NULL for a cell-day with any missing step.
    """
    columns = [reducer(stat, strict)(F.col("value")).alias(f"v_{stat}") for stat in stats]
    return obs.groupBy(*by, "iy", "ix").agg(
        *columns, F.count(F.lit(1)).cast("int").alias("n_steps")
    )


def layer_minmax(obs: DataFrame, layer: Sequence[str] = ("variable", "lead_hour")) -> DataFrame:
    return obs.groupBy(*layer).agg(
        REDUCERS["min"](F.col("value")).alias("v_min"), REDUCERS["max"](F.col("value")).alias("v_max")
    )


def value_domain(obs: DataFrame) -> DataFrame:
    """Smallest and largest value over all layers, as for a colour scale."""
    return obs.agg(F.min("value").alias("domain_min"), F.max("value").alias("domain_max"))


def regrid_bilinear(
    cells: DataFrame,
    source: GridSpec,
    target: GridSpec,
    value: str = "value",
    by: Sequence[str] = ("variable", "date"),
) -> DataFrame:
    """Resample ``value`` onto ``target`` with bilinear weights.

    Each source cell is sent to the target cells whose centre lies within one source step of its
    own; that is index arithmetic, so the only exchange is the final sum and no target
    table is joined. Missing neighbours are left out and the other weights scaled up, as at the
    grid's border. Targets centred outside the source grid get no row. A closed source is continued beyond both ends, so
    that targets at its seam have neighbours on either side.
    """

    def targets(index: str, s0: float, ds: float, n: int, t0: float, dt: float, nt: int, turns=None):
        centre = F.lit(s0) + (F.col(index) + 0.5) * F.lit(ds)
        if turns is not None:
            centre = centre + turns
        # Target centres t0 + (j + 0.5) * dt strictly within one step of the source centre.
        first = F.floor((centre - F.lit(ds) - F.lit(t0)) / F.lit(dt) - 0.5).cast("int") + 1
        last = F.ceil((centre + F.lit(ds) - F.lit(t0)) / F.lit(dt) - 0.5).cast("int") - 1
        inside_first = 0 if turns is not None else max(0, math.ceil((s0 - t0) / dt - 0.5))
        inside_last = nt - 1 if turns is not None else min(nt - 1, math.floor((s0 + n * ds - t0) / dt - 0.5))
        return centre, F.greatest(first, F.lit(inside_first)), F.least(last, F.lit(inside_last))

    if source.closed:
        cells = cells.withColumn("_turn", F.explode(F.array(*[F.lit(turn) for turn in (-360.0, 0.0, 360.0)])))
    x, x_first, x_last = targets(
        "ix", source.lon0, source.dlon, source.nx, target.lon0, target.dlon, target.nx, F.col("_turn") if source.closed else None
    )
    y, y_first, y_last = targets(
        "iy", source.lat0, source.dlat, source.ny, target.lat0, target.dlat, target.ny
    )
    v = F.col(value)
    spread = (
        cells.filter(v.isNotNull())
        .select(
            *by,
            v.alias("_v"),
            x.alias("_x"),
            y.alias("_y"),
            x_first.alias("_x1"),
            x_last.alias("_x2"),
            y_first.alias("_y1"),
            y_last.alias("_y2"),
        )
        .filter("_x1 <= _x2 and _y1 <= _y2")
        .withColumn("ix", F.explode(F.sequence("_x1", "_x2")))
        .withColumn("iy", F.explode(F.sequence("_y1", "_y2")))
    )
    near_x = 1 - F.abs(F.lit(target.lon0) + (F.col("ix") + 0.5) * target.dlon - F.col("_x")) / source.dlon
    near_y = 1 - F.abs(F.lit(target.lat0) + (F.col("iy") + 0.5) * target.dlat - F.col("_y")) / source.dlat
    return (
        # A weight within the rounding of the coordinates is zero.
        spread.withColumns({"_wx": near_x, "_wy": near_y, "_w": near_x * near_y})
        .filter((F.col("_wx") > max(source.rounding, target.rounding)) & (F.col("_wy") > max(source.rounding, target.rounding)))
        .groupBy(*by, "iy", "ix")
        .agg((F.sum(F.col("_w") * F.col("_v")) / F.sum("_w")).alias(value))
    )
