"""Writers: append, replace, daily grids, exports."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridzonal.functions.names import run_marker
from gridzonal.schema import GridSpec
from gridzonal.sources import netcdf
from gridzonal.storage import arrow_uri

# The last partition column of tables that grow by batches: which write a row came with.
BATCH = "batch"


def _arranged(
    df: DataFrame, keys: Sequence[str], sort_by: Sequence[str], clustered: bool
) -> DataFrame:
    """Rows arranged for a partitioned write.

    Unless they are ``clustered`` by key already (one input file per day, say), rows are rebalanced:
    few files per key, small keys sharing a task and a big key split over several. ``sort_by``
    orders rows inside each file, so that row-group statistics can answer later filters.
    """
    if keys and not clustered:
        df = df.hint("rebalance", *[F.col(key) for key in keys])
    return df.sortWithinPartitions(*keys, *sort_by) if sort_by else df


def append(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    clustered: bool = False,
    batches: bool = True,
) -> None:
    """Add a batch to a Parquet table, creating it if absent; one write for all batches.

    A table that the streaming ingest has made is partitioned by ``BATCH`` as well; the rows then get a batch of their own
    (``batches``: look for that).
    """
    if batches and _has_batches(df.sparkSession, path) and BATCH not in df.columns:
        df = df.withColumn(BATCH, F.lit(f"append-{uuid.uuid4().hex}"))
        partition_by = [*partition_by, BATCH]
    arranged = _arranged(df, partition_by, sort_by, clustered)
    arranged.write.mode("append").partitionBy(*partition_by).parquet(path)


def _has_batches(spark: SparkSession, path: str) -> bool:
    try:
        return BATCH in spark.read.parquet(path).columns
    except AnalysisException:  # nothing there yet
        return False


def replace(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    clustered: bool = False,
) -> None:
    """Replace the whole Parquet table."""
    writer = _arranged(df, partition_by, sort_by, clustered).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path)


def replace_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    sort_by: Sequence[str] = (),
    clustered: bool = False,
) -> None:
    """Replace only the partitions that ``df`` has rows for."""
    writer = _arranged(df, partition_by, sort_by, clustered).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def store_bucketed(
    obs: DataFrame, name: str, buckets: int, path: str, keys: Sequence[str] = ("variable", "date")
) -> None:
    """Store observations as a catalog table bucketed by day.

    Rows of a (variable, date) then share a bucket, and that partitioning serves the cell-day and the
    zone-day aggregation alike: the whole historical plan over such a table needs no shuffle of
    the observations. Worth its one shuffle when the table is read more than once. Where single days are
    too large for a task, add ``iy`` to the keys: a day is then split over buckets, the cell-day
    aggregation stays local and only partial zone sums are shuffled.
    """
    (
        obs.repartition(buckets, *[F.col(key) for key in keys])
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, keys[0], *keys[1:])
        .sortBy(*keys)
        .saveAsTable(name)
    )


def rebuild_table(df: DataFrame, name: str) -> None:
    """Replace a catalog table by ``df``, which may read that table.

    The new rows are written in full under another name before the old table goes.
    """
    spark, fresh = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    df.write.saveAsTable(fresh)
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", {"name": name})
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")


def append_table(df: DataFrame, name: str) -> None:
    df.write.mode("append").saveAsTable(name)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """(name) of the stored tables of a database, the current one by default; temporary views are left out."""
    shown = spark.sql("SHOW TABLES" if database is None else f"SHOW TABLES IN {database}")
    return shown.filter("NOT isTemporary").select(F.col("tableName").alias("name")).orderBy("name")


def export_csv(df: DataFrame, path: str, null_value: str = "") -> None:
    """Delimited text with a header; missing values as empty or, say, ``NA``."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("nullValue", null_value)
        .option("emptyValue", '""')
        .csv(path)
    )


def export_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_grid_files(
    daily: DataFrame,
    folder: str,
    spec: GridSpec,
    stats: Sequence[str] = ("mean", "max", "min"),
    prefix: str = "grid",
    time_axis: bool = True,
) -> None:
    """Daily grids as files ``<prefix>_<variable>_<yyyymmdd>_<stat>.nc``, overwriting.

    One task group is one (variable, date): at most one row per cell of the grid, whatever the
    size of the input. Each file is written under a temporary name and then moved, so a
    task that is lost or run twice leaves no torn file. The folder is resolved once, as Spark resolves it; two rows
    for one cell stop the job. Without ``time_axis`` the day is in the name only.
    """
    folder = arrow_uri(daily.sparkSession, folder)
    cloudpickle.register_pickle_by_value(netcdf)
    # Plain values only: a task must not need the package to unpickle the function.
    grid_id, ny, nx = spec.grid_id, spec.ny, spec.nx
    lats = spec.lat0 + (np.arange(ny) + 0.5) * spec.dlat
    lons = spec.lon0 + (np.arange(nx) + 0.5) * spec.dlon

    def store(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        from pyarrow import fs

        variable, day = key
        if not (group["iy"].between(0, ny - 1).all() and group["ix"].between(0, nx - 1).all()):
            raise ValueError(f"{variable} {day}: cells outside grid {grid_id!r}")
        if group.duplicated(["iy", "ix"]).any():
            raise ValueError(f"{variable} {day}: two rows for one cell")
        hours = np.array([float((pd.Timestamp(day) - pd.Timestamp("1970-01-01")) / pd.Timedelta(hours=1))])
        filesystem, root = fs.FileSystem.from_uri(folder)
        for stat in stats:
            layer = np.full((1, ny, nx), np.nan)
            layer[0, group["iy"], group["ix"]] = group[f"v_{stat}"].astype("float64")
            target = f"{root}/{prefix}_{variable}_{pd.Timestamp(day):%Y%m%d}_{stat}.nc"
            # A leading underscore hides unfinished files from Spark's readers.
            parts = target.rsplit("/", 1)
            unfinished = f"{parts[0]}/_{parts[1]}.{uuid.uuid4().hex}"
            with filesystem.open_output_stream(unfinished) as out:
                out.write(netcdf.write_classic(variable, lats, lons, layer, hours, **({} if time_axis else {"epoch": None})))
            filesystem.move(unfinished, target)
        return pd.DataFrame({"variable": [variable], "date": [day]})

    from pyarrow import fs

    filesystem, root = fs.FileSystem.from_uri(folder)
    filesystem.create_dir(root, recursive=True)
    columns = ["variable", "date", "iy", "ix", *[f"v_{stat}" for stat in stats]]
    (
        daily.select(*columns)
        .groupBy("variable", "date")
        .applyInPandas(store, "variable string, date date")
        .write.format("noop")
        .mode("overwrite")
        .save()
    )


def write_run_markers(runs: DataFrame, folder: str) -> None:
    """An empty file ``datestamp_<yyyymmdd>_<HH:MM>`` for every run time (column ``run_time``) of ``runs``."""
    from pyarrow import fs

    folder = arrow_uri(runs.sparkSession, folder)
    filesystem, root = fs.FileSystem.from_uri(folder)
    filesystem.create_dir(root, recursive=True)

    def store(batches):
        from pyarrow import fs

        filesystem, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch["name"]:
                filesystem.open_output_stream(f"{root}/{name}").close()
            yield batch

    marked = runs.select(run_marker(F.col("run_time")).alias("name")).distinct()
    marked.mapInPandas(store, "name string").write.format("noop").mode("overwrite").save()
