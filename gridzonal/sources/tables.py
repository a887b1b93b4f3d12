"""Stored Parquet datasets and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from gridzonal.operators.coverage import zone_weights
from gridzonal.schema import ZONES, GridSpec


def scan_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A Parquet dataset, lazily; a declared schema saves reading footers to infer one."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def scan_zones(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Zone polygons (zone_id, rings) in lon/lat degrees, from Parquet or JSON lines."""
    return spark.read.schema(ZONES).format(fmt).load(path)


def store_weights(zones: DataFrame, spec: GridSpec, path: str) -> DataFrame:
    """Compute the coverage weights once per (grid, zone layer), store them and read them back."""
    zone_weights(zones, spec).write.mode("overwrite").parquet(path)
    return zones.sparkSession.read.parquet(path)
