"""The driver's tables seen through the library's data model (FIXTURES.md, section 3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridzonal.functions.names import grid_file_name
from gridzonal.functions.numeric import convert_units
from gridzonal.operators.series import STATS, melt_stats
from gridzonal.schema import GridSpec

GRID = GridSpec("demo", 0.0, 0.0, 0.75, 0.75, 15, 10)

# Vertex offsets of the demo zones from their centre.
OFFSETS = ((-1.1, -0.3), (0.2, -0.9), (1.2, 0.1), (0.3, 0.25), (-0.2, 0.95))

# Conversion per event type, standing in for the model variables.
UNITS = {
    "click": (1e9, 0.0, "µg/m³"),
    "error": (1e6, 0.0, "mg/m²"),
    "purchase": (44698.0, 0.0, "DU"),
    "signup": (1.0, -273.15, "°C"),
    "view": (40.0, 0.0, "UV index"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Where an event falls on the demo grid.
CELL = ("CAST(floor(pmod(event_id, 150) / 15) AS INT) AS iy", "CAST(pmod(pmod(event_id, 150), 15) AS INT) AS ix")


def grid_obs(spark: SparkSession, sf_dir: str, with_nulls: bool = False) -> DataFrame:
    value = "if(pmod(event_id, 97) <> 0, value, NULL)" if with_nulls else "value"
    cells = table(spark, sf_dir, "events").selectExpr(
        "event_type AS variable", "ts AS valid_time", "CAST(ts AS DATE) AS date", *CELL, f"{value} AS value"
    )
    return cells.selectExpr(
        "variable",
        "valid_time",
        "date",
        "iy",
        "ix",
        f"{GRID.lat0}D + (iy + 0.5D) * {GRID.dlat}D AS lat",
        f"{GRID.lon0}D + (ix + 0.5D) * {GRID.dlon}D AS lon",
        "value",
    )


def grid_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even event ids belong to the 00 h run of their day, odd ones to the 12 h run."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_type AS variable",
        "timestampadd(HOUR, if(pmod(event_id, 2) = 0, 0, 12), CAST(CAST(ts AS DATE) AS TIMESTAMP_NTZ)) AS run_time",
        "CAST(pmod(event_id, 121) AS INT) AS lead_hour",
        *CELL,
        "value",
    )


def in_model_units(obs: DataFrame) -> DataFrame:
    """The values as a model would deliver them, so that conversion brings them to size again."""
    undo = {name: (1 / scale, 0.0, "") for name, (scale, _offset, _unit) in UNITS.items()}
    offset = convert_units(F.lit(0.0), F.col("variable"), UNITS)
    return obs.withColumn("value", convert_units(F.col("value") - offset, F.col("variable"), undo))


def _pentagon(shift: float = 0.0, scale: float = 1.0) -> str:
    lon = f"(pmod(n_nationkey, 5) * 2.2D + 1.3D + {shift}D)"
    lat = "(floor(n_nationkey / 5) * 1.4D + 0.9D)"
    points = ", ".join(
        f"named_struct('lon', {lon} + ({dx}D * {scale}D), 'lat', {lat} + ({dy}D * {scale}D))" for dx, dy in OFFSETS
    )
    return f"array(named_struct('role', 'shell', 'pts', array({points}))) AS rings"


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr("CAST(n_nationkey AS BIGINT) AS zone_id", _pentagon())


def zones_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zones shrunk to a tenth, so that they lie scattered and most cells touch none."""
    return table(spark, sf_dir, "nation").selectExpr("CAST(n_nationkey AS BIGINT) AS zone_id", _pentagon(scale=0.1))


def zones_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zones and a copy of each moved 8 degrees east, most of which lie off the grid."""
    moved = table(spark, sf_dir, "nation").selectExpr(
        "CAST(n_nationkey + 100 AS BIGINT) AS zone_id", _pentagon(8.0)
    )
    return zones(spark, sf_dir).unionByName(moved)


# A global grid moved by half a step, so that its seam lies inside a column of the usual one.
WORLD = GridSpec("world-shift", -192.0, -90.0, 24.0, 18.0, 15, 10)


def _rings(*rings: tuple[str, str, str, str, str]) -> str:
    """SQL of rings from (role, west, south, east, north)."""
    made = []
    for role, west, south, east, north in rings:
        corners = ((west, south), (east, south), (east, north), (west, north))
        points = ", ".join(f"named_struct('lon', CAST({x} AS DOUBLE), 'lat', CAST({y} AS DOUBLE))" for x, y in corners)
        made.append(f"named_struct('role', '{role}', 'pts', array({points}))")
    return f"array({', '.join(made)}) AS rings"


def zones_world(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zone on either side of 180 degrees per nation."""
    nations = table(spark, sf_dir, "nation").selectExpr("CAST(n_nationkey AS BIGINT) AS k")
    east = nations.selectExpr("k AS zone_id", _rings(("shell", "150.5 + k", "3 * k - 50", "180", "3 * k - 47.5")))
    west = nations.selectExpr("k + 100 AS zone_id", _rings(("shell", "-180", "3 * k - 50", "-179.75 + k", "3 * k - 47.5")))
    return east.unionByName(west)


def zones_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zone of two parts per customer, the first with a hole; their number grows with the data."""
    placed = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS zone_id", "pmod(c_custkey * 37, 89) / 10.0D AS x", "pmod(c_custkey * 53, 53) / 10.0D + 0.1D AS y"
    )
    return placed.selectExpr(
        "zone_id",
        _rings(
            ("shell", "x", "y", "x + 1.3D", "y + 1.1D"),
            ("hole", "x + 0.2D", "y + 0.3D", "x + 0.7D", "y + 0.9D"),
            ("shell", "x + 1.5D", "y + 0.2D", "x + 1.9D", "y + 2D"),
        ),
    )


def zone_daily_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(code_muni, date, mean, max, min): one shuffle, whatever the number of statistics."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS c_custkey", "CAST(o_orderdate AS DATE) AS date", "o_totalprice"
    )
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "CAST(5100000 + c_nationkey AS BIGINT) AS code_muni"
    )
    return (
        orders.join(customers, "c_custkey")
        .groupBy("code_muni", "date")
        .agg(
            F.avg("o_totalprice").alias("mean"),
            F.max("o_totalprice").alias("max"),
            F.min("o_totalprice").alias("min"),
        )
    )


def zone_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return melt_stats(zone_daily_wide(spark, sf_dir), ["code_muni", "date"], STATS)


def stacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``zone_daily`` with its statistic as ``name``, the shape the exports take."""
    return zone_daily(spark, sf_dir).withColumnRenamed("stat", "name")


def present_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.selectExpr("event_type AS variable", "CAST(ts AS DATE) AS date").distinct()


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        grid_file_name(F.col("event_type"), F.to_date("ts"), "mean").alias("name")
    )
