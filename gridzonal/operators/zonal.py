"""Coverage-weighted statistics of grid cells over zones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridzonal.functions.numeric import round_to
from gridzonal.operators.coverage import Footprint
from gridzonal.operators.joins import BROADCAST_ROWS, frame_of, join_checked


def prune_to_box(cells: DataFrame, box: Footprint) -> DataFrame:
    """Drop cells outside the zones' bounding cells; literal ranges that reach the scan."""
    return cells.filter(
        F.col("iy").between(box.iy_min, box.iy_max) & F.col("ix").between(box.ix_min, box.ix_max)
    )


def collapse_to_box(cells: DataFrame, box: Footprint) -> DataFrame:
    """Cells outside the zones' bounding cells become one cell (-1, -1) without value.

    What remains of them after partial aggregation is a row per group and task. It keeps the groups on record, such
    as days, without a second scan.
    """
    inside = F.col("iy").between(box.iy_min, box.iy_max) & F.col("ix").between(box.ix_min, box.ix_max)
    return _collapse(cells, inside)


def _collapse(cells: DataFrame, inside: Column) -> DataFrame:
    return cells.withColumns(
        {
            "iy": F.when(inside, F.col("iy")).otherwise(-1),
            "ix": F.when(inside, F.col("ix")).otherwise(-1),
            "value": F.when(inside, F.col("value")),
        }
    )


def prune_to_cells(cells: DataFrame, weights: DataFrame, weight_rows: int | None, collapse: bool = False) -> DataFrame:
    """Keep cells that some zone touches, before the daily reduction rather than after it.

    The optimiser cannot move this join below the aggregate itself. On a global grid with
    national zones nearly all rows fall away here, and with them the first shuffle. ``collapse`` turns the
    others into one cell, as ``collapse_to_box`` does.
    """
    touched = weights.select("iy", "ix").distinct()
    if not collapse:
        return join_checked(cells, touched, ["iy", "ix"], weight_rows, how="left_semi")
    marked = join_checked(cells, touched.withColumn("_touched", F.lit(True)), ["iy", "ix"], weight_rows, how="left")
    return _collapse(marked, F.col("_touched").isNotNull()).drop("_touched")


def attach_weights(
    cells: DataFrame, weights: DataFrame, weight_rows: int | None, grid_id: str | None = None, how: str = "inner"
) -> DataFrame:
    """One row per (cell row, zone touching that cell), with the covered fraction.

    ``grid_id`` picks one grid from weights that hold several.
    """
    own = weights if grid_id is None else weights.filter(F.col("grid_id") == grid_id)
    return join_checked(cells, own.select("zone_id", "iy", "ix", "fraction"), ["iy", "ix"], weight_rows, how)


def _mean(fraction: Column, value: Column) -> Column:
    return F.sum(fraction * value) / F.sum(F.when(value.isNotNull(), fraction))


# Zonal statistics by name: (fraction, value) -> aggregate. Missing cells are ignored.
ZONAL_STATS = {
    "mean": _mean,
    "sum": lambda f, v: F.sum(f * v),
    "count": lambda f, v: F.coalesce(F.sum(F.when(v.isNotNull(), f)), F.lit(0.0)),
    "min": lambda f, v: F.min(v),
    "max": lambda f, v: F.max(v),
}


def zonal_stats(
    cells: DataFrame,
    weights: DataFrame,
    by: Sequence[str],
    outputs: dict[str, tuple[str, str]],
    weight_rows: int | None = None,
    grid_id: str | None = None,
    keep_groups: bool = False,
) -> DataFrame:
    """Aggregate cells over zones: ``outputs`` maps a result name to (statistic, value column).

    Weights are cell fractions alone. However many outputs are asked for, there is one join and one
    shuffle on ``(*by, zone_id)``, after partial aggregation. ``weight_rows`` is the proven
    bound on the weights (``Footprint.rows``); without it the join is a shuffle. Weights that hold several
    grids need ``grid_id``. ``keep_groups`` keeps cells outside every zone as a zone NULL, so that every group has a
    row; ``complete_zones`` builds on it.
    """
    unknown = {stat for stat, _ in outputs.values()} - set(ZONAL_STATS)
    if unknown:
        raise ValueError(f"unknown zonal statistic {sorted(unknown)}; choose from {sorted(ZONAL_STATS)}")
    needed = [*by, "iy", "ix", *sorted({column for _, column in outputs.values()})]
    how = "left" if keep_groups else "inner"
    joined = attach_weights(cells.select(*needed), weights, weight_rows, grid_id, how)
    fraction = F.col("fraction")
    return joined.groupBy(*by, "zone_id").agg(
        *[ZONAL_STATS[stat](fraction, F.col(column)).alias(name) for name, (stat, column) in outputs.items()]
    )


def zonal_mean(
    cells: DataFrame,
    weights: DataFrame,
    by: Sequence[str],
    value: str = "value",
    weight_rows: int | None = None,
    digits: int | None = 2,
    grid_id: str | None = None,
    keep_groups: bool = False,
) -> DataFrame:
    """The weighted mean alone, rounded unless ``digits`` is None."""
    result = zonal_stats(cells, weights, by, {"value": ("mean", value)}, weight_rows, grid_id, keep_groups)
    if digits is None:
        return result
    return result.withColumn("value", round_to(F.col("value"), digits))


def zonal_quantiles(
    cells: DataFrame,
    weights: DataFrame,
    by: Sequence[str],
    outputs: dict[str, float],
    value: str = "value",
    weight_rows: int | None = None,
    grid_id: str | None = None,
) -> DataFrame:
    """Coverage-weighted quantiles of cells over zones, exact: ``outputs`` maps a result name to a probability in [0, 1].

    With the n values of a zone in ascending order and fractions w, value k stands at S(k) = (k - 1) w(k) + (n - 1) times the fractions
    before it, and a probability p at p S(n); between two values the result is interpolated. Equal fractions give the usual
    quantile. Missing cells are ignored; a zone without a value has NULL. All quantiles share a join and a sort by (*by, zone, value),
    whose groups hold at most one row per cell of the grid and spill to disk.
    """
    wrong = {name: p for name, p in outputs.items() if not 0 <= p <= 1}
    if wrong:
        raise ValueError(f"probabilities must be in [0, 1], not {wrong}")
    joined = attach_weights(cells.select(*by, "iy", "ix", F.col(value).alias("_v")), weights, weight_rows, grid_id)
    group = Window.partitionBy(*by, "zone_id")
    # Missing cells come last and weigh nothing; they keep their zone on record.
    order = group.orderBy(F.asc_nulls_last("_v"), "fraction")
    weight = F.when(F.col("_v").isNotNull(), F.col("fraction")).otherwise(0.0)
    ranked = joined.withColumns(
        {
            "_w": weight,
            "_n": F.count("_v").over(group),
            "_k": F.row_number().over(order),
            "_total": F.sum(weight).over(group),
            "_upto": F.sum(weight).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        }
    )
    last = F.col("_k") == F.col("_n")
    place = (F.col("_k") - 1) * F.col("_w") + (F.col("_n") - 1) * (F.col("_upto") - F.col("_w"))
    # The last value stands at the end exactly, however the sums were rounded.
    placed = ranked.withColumn("_s", F.when(last, (F.col("_n") - 1) * F.col("_total")).otherwise(place))
    placed = placed.withColumns({"_s2": F.lead("_s").over(order), "_v2": F.lead("_v").over(order)})
    results = []
    for name, p in outputs.items():
        at = F.lit(float(p)) * (F.col("_n") - 1) * F.col("_total")
        inside = F.col("_v").isNotNull() & (F.col("_s") <= at) & (last | (at < F.col("_s2")))
        between = F.col("_v") + (F.col("_v2") - F.col("_v")) * (at - F.col("_s")) / (F.col("_s2") - F.col("_s"))
        results.append(F.max(F.when(inside, F.when(last, F.col("_v")).otherwise(between))).alias(name))
    return placed.groupBy(*by, "zone_id").agg(*results)


def complete_zones(
    result: DataFrame, zones: DataFrame, by: Sequence[str], zone_rows: int | None = None
) -> DataFrame:
    """Give every zone a row in every group of ``result``; NULL where it had no cell.

    ``result`` comes from ``zonal_stats`` with ``keep_groups``, so that a group in which no zone has a cell is there as
    well. Its rows stay where they are: zones have dense numbers, the numbers seen in a group are or-ed into words of 64
    bits before they are exchanged, and only the zones of absent bits are added. Both uses of ``result`` read the same
    exchange, so there is no second scan. Beyond ``BROADCAST_ROWS`` zones (``zone_rows``, from ``Footprint.zones``), or if
    their number is not known, the frame of groups x zones is joined instead.
    """
    values = [field for field in result.schema if field.name not in (*by, "zone_id")]
    if zone_rows is None or zone_rows > BROADCAST_ROWS:
        frame = frame_of(result.select(*by).distinct(), zones.select("zone_id"), ["zone_id"])
        return frame.join(result.filter("zone_id IS NOT NULL"), [*by, "zone_id"], "left")
    empty = [F.lit(None).cast(field.dataType).alias(field.name) for field in values]
    added = _absent_zones(result, zones, by, zone_rows).select(*by, "zone_id", *empty)
    # The partition keeps the filter from moving below the exchange, which would no longer be that of the other branch.
    rows = result.withColumn("_at", F.spark_partition_id()).filter("zone_id IS NOT NULL")
    return rows.select(*by, "zone_id", *[field.name for field in values]).unionByName(added)


def _absent_zones(result: DataFrame, zones: DataFrame, by: Sequence[str], zone_rows: int) -> DataFrame:
    """(*by, zone_id) of the zones that a group lacks, from one 64-bit word of zone numbers per 64 zones."""
    numbered = (
        zones.agg(F.sort_array(F.collect_set("zone_id")).alias("_zones"))
        .select(F.posexplode("_zones").alias("_n", "zone_id"))
        .select("zone_id", F.shiftright("_n", 6).alias("_word"), F.col("_n").bitwiseAND(63).alias("_bit"))
    )
    masks = numbered.groupBy("_word").agg(F.collect_list(F.struct("_bit", "zone_id")).alias("_members"))
    # Always true; all columns stay in use, so that Spark finds the exchange of the other branch again.
    read = result.filter(F.hash(*result.columns) >= -(2**31))
    words = (
        read.join(F.broadcast(numbered), "zone_id", "left")
        .groupBy(*by, "_word")
        .agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))
    )
    seen = F.collect_list(F.when(F.col("_word").isNotNull(), F.struct("_word", "_bits")))
    groups = words.groupBy(*by).agg(seen.alias("_seen"))
    every = F.sequence(F.lit(0), F.lit(max(zone_rows - 1, 0) >> 6))
    unseen = F.array_except(every, F.transform("_seen", lambda word: word["_word"]))
    blank = F.transform(unseen, lambda word: F.struct(word.alias("_word"), F.lit(0).cast("long").alias("_bits")))
    full = groups.select(*by, F.inline(F.concat("_seen", blank))).join(F.broadcast(masks), "_word")
    lacking = F.filter("_members", lambda member: F.getbit(F.col("_bits"), member["_bit"]) == 0)
    return full.filter(F.bit_count("_bits") < F.size("_members")).select(*by, F.explode(lacking).alias("_m")).select(
        *by, F.col("_m.zone_id").alias("zone_id")
    )
