"""Folders of grid files: listing by pattern and scanning into ``grid_obs`` rows."""

from __future__ import annotations

import re
from collections.abc import Iterator
from struct import error as StructError

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridzonal.functions.names import base_name, date_from_name, run_time_from_marker, stat_from_name, variable_from_name
from gridzonal.operators.grid import normalise_grid
from gridzonal.schema import GRID_OBS, GridSpec
from gridzonal.sources import netcdf
from gridzonal.storage import arrow_uri

BATCH_CELLS = 250_000

DECODED = (
    "variable string, run_time timestamp_ntz, source_file string, stat string, name_date date, "
    "modified timestamp, layer int, valid_time timestamp_ntz, "
    "lat double, lon double, value double"
)
_DECODED_ARROW = pa.schema(
    [
        ("variable", pa.string()),
        ("run_time", pa.timestamp("us")),
        ("source_file", pa.string()),
        ("stat", pa.string()),
        ("name_date", pa.date32()),
        ("modified", pa.timestamp("us", "UTC")),
        ("layer", pa.int32()),
        ("valid_time", pa.timestamp("us")),
        ("lat", pa.float64()),
        ("lon", pa.float64()),
        ("value", pa.float64()),
    ]
)


def list_files(spark: SparkSession, folder: str, pattern: str = ".*", recursive: bool = False) -> DataFrame:
    """Files whose base name matches the regular expression: path, name, length, modified.

    The content column is pruned, so no file is opened.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", str(recursive).lower())
        .load(folder)
        .select("path", base_name(F.col("path")).alias("name"), "length", F.col("modificationTime").alias("modified"))
        .filter(F.col("name").rlike(pattern))
    )


def first_match(files: DataFrame) -> DataFrame:
    """The alphabetically first name of a listing."""
    return files.orderBy("name").limit(1)


def days_of(files: DataFrame) -> DataFrame:
    """(variable, date) of listed files, read from their names; other names are left out.

    Set against a day manifest with ``manifest.missing``, this tells what has not been fetched.
    """
    name = F.col("name")
    named = files.select(variable_from_name(name).alias("variable"), date_from_name(name).alias("date"))
    return named.filter("variable IS NOT NULL AND date IS NOT NULL")


def _decode(area: tuple[float, float, float, float] | None, axes: tuple | None = None):
    """Arrow mapper from (path, what is known per file, content) to cell rows.

    One latitude band of one layer makes a batch. ``axes`` (lon0, lat0, dlon, dlat, nx, ny) is the grid that the file's
    cell centres must lie on.
    """

    def check(values: np.ndarray, origin: float, step: float, count: int, turn: float | None, what: str) -> None:
        distance = values - origin if turn is None else (values - origin) % turn
        place = distance / step - 0.5
        if len(values) and (np.abs(place - np.round(place)).max() > 0.01 or np.round(place).min() < 0 or np.round(place).max() > count - 1):
            raise ValueError(f"its {what} are not cell centres of the grid (origin {origin}, step {step}, {count} cells)")

    def cells(content: bytes, variable, run_time, source_file, stat, name_date, modified) -> Iterator[pa.RecordBatch]:
        for name, lats, lons, times, attrs, layers in netcdf.layers_of(content):
            if axes is not None:
                lon0, lat0, dlon, dlat, nx, ny = axes
                check(lats, lat0, dlat, ny, None, "latitudes")
                check(lons, lon0, dlon, nx, 360.0, "longitudes")
            if times is None and run_time is None and name_date is None:
                raise ValueError("it has no usable time axis, and there is neither a run time nor a date in its name")
            rows = np.arange(len(lats))
            cols = np.arange(len(lons))
            if area is not None:
                north, west, south, east = area
                wrapped = (lons + 180.0) % 360.0 - 180.0
                rows = rows[(lats >= south) & (lats <= north)]
                cols = cols[(wrapped >= west) & (wrapped <= east)]
            if not len(rows) or not len(cols):
                continue
            band = max(1, BATCH_CELLS // len(cols))
            for layer in range(len(layers)):
                for start in range(0, len(rows), band):
                    part = rows[start : start + band]
                    values = netcdf.unpack(layers[layer][np.ix_(part, cols)], attrs).ravel()
                    n = values.size

                    def same(value, kind):
                        return pa.repeat(pa.scalar(value, kind), n)

                    yield pa.RecordBatch.from_arrays(
                        [
                            same(name if variable is None else variable, pa.string()),
                            same(run_time, pa.timestamp("us")),
                            same(source_file, pa.string()),
                            same(stat, pa.string()),
                            same(name_date, pa.date32()),
                            same(modified, pa.timestamp("us", "UTC")),
                            same(layer, pa.int32()),
                            same(times[layer] if times else None, pa.timestamp("us")),
                            pa.array(np.repeat(lats[part], len(cols))),
                            pa.array(np.tile(lons[cols], len(part))),
                            pa.array(values, mask=np.isnan(values)),
                        ],
                        schema=_DECODED_ARROW,
                    )

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*batch.columns):
                path, *known, content = row
                try:
                    yield from cells(content.as_py(), *(value.as_py() for value in known))
                except (ValueError, KeyError, IndexError, OverflowError, StructError) as problem:
                    raise ValueError(f"cannot read grid file {path.as_py()}: {problem}") from problem

    return mapper


def decode_files(
    files: DataFrame,
    area: tuple[float, float, float, float] | None = None,
    variable: Column | None = None,
    run_time: Column | None = None,
    source_file: bool = False,
    spec: GridSpec | None = None,
) -> DataFrame:
    """Rows of ``binaryFile`` (batch or streaming) to cells; fill values and NaN become NULL.

    Statistic and day are taken from the name. A file without a usable time must have one of those days or a run
    time, and with ``spec`` its axes must lie on that grid; else the job stops with its path.

    ``variable`` and ``run_time`` may be expressions over ``path``; they are evaluated once per file.
    Without ``variable`` the name inside the file is used. ``area`` (north, west, south, east) is cut
    out of the arrays before rows are made.
    """
    # Workers get the decoder with the task, whether or not the package is installed there.
    cloudpickle.register_pickle_by_value(netcdf)
    missing = F.lit(None)
    axes = None if spec is None else (spec.lon0, spec.lat0, spec.dlon, spec.dlat, spec.nx, spec.ny)
    return files.select(
        "path",
        (missing if variable is None else variable).cast("string").alias("variable"),
        (missing if run_time is None else run_time).cast("timestamp_ntz").alias("run_time"),
        (base_name(F.col("path")) if source_file else missing).cast("string").alias("source_file"),
        stat_from_name(F.col("path")).alias("stat"),
        date_from_name(F.col("path")).alias("name_date"),
        (F.col("modificationTime") if source_file else missing).cast("timestamp").alias("modified"),
        "content",
    ).mapInArrow(_decode(area, axes), DECODED)


def to_observations(cells: DataFrame, spec: GridSpec, source_file: bool = False, is_forecast: bool = False) -> DataFrame:
    """Decoded cells in the ``grid_obs`` schema, plus ``date``, ``stat`` and, if asked for, ``source_file`` and ``delivered``.

    With a run time the layer position is the lead hour, and the valid time follows from it. The day is that of the
    valid time, or that in the name where the file has no time. ``delivered`` is when the file was last changed. With ``is_forecast``
    every file has a run time, and a filter on the lead hour is one on the layer.
    """
    forecast = F.col("run_time").isNotNull()
    located = (
        normalise_grid(cells, spec)
        .withColumn("lead_hour", F.col("layer") if is_forecast else F.when(forecast, F.col("layer")))
        .withColumn(
            "valid_time",
            F.coalesce(F.timestamp_add("HOUR", F.col("lead_hour"), F.col("run_time")), F.col("valid_time")),
        )
    )
    origin = ["source_file", F.unix_micros("modified").alias("delivered")] if source_file else []
    return located.select(
        *[F.col(field.name).cast(field.dataType).alias(field.name) for field in GRID_OBS],
        F.coalesce(F.col("valid_time").cast("date"), F.col("name_date")).alias("date"),
        "stat",
        *origin,
    )


def scan_grid_files(
    spark: SparkSession,
    folder: str,
    spec: GridSpec,
    pattern: str = r"\.nc$",
    variable: Column | None = None,
    run_time: Column | None = None,
    area: tuple[float, float, float, float] | None = None,
) -> DataFrame:
    """A folder of grid files as ``grid_obs`` rows; files are spread over tasks by size.

    The pattern is a condition on the file's name, which Spark knows from the listing: other files are not opened.
    """
    return to_observations(decode_files(_matching(spark, folder, pattern), area, variable, run_time, spec=spec), spec)


def _matching(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    return spark.read.format("binaryFile").load(folder).filter(F.col("_metadata.file_name").rlike(pattern))


def list_markers(spark: SparkSession, folder: str, pattern: str = r"^datestamp_") -> DataFrame:
    """(name) of the marker files of a folder. They are empty, and Spark's file sources leave empty files out."""
    filesystem, root = fs.FileSystem.from_uri(arrow_uri(spark, folder))
    names = [info.base_name for info in filesystem.get_file_info(fs.FileSelector(root)) if re.search(pattern, info.base_name)]
    return spark.createDataFrame([(name,) for name in names], "name string")


def marker_run_time(spark: SparkSession, folder: str, pattern: str = r"^datestamp_") -> Column:
    """The run time that the first marker file of a folder names, as an expression for the files beside it."""
    marker = first_match(list_markers(spark, folder, pattern)).first()
    if marker is None:
        raise ValueError(f"no marker matching {pattern!r} in {folder}")
    return run_time_from_marker(F.lit(marker["name"]))


def grid_specs(spark: SparkSession, folder: str, pattern: str = r"\.nc$") -> DataFrame:
    """The distinct grids found in a folder, one row each: edges, steps and sizes.

    Only the axes leave the task; cell values are not decoded.
    """
    cloudpickle.register_pickle_by_value(netcdf)

    def axes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for content in batch.column(0):
                for _name, lats, lons, *_ in netcdf.layers_of(content.as_py()):
                    lon, lat = np.sort((lons + 180.0) % 360.0 - 180.0), np.sort(lats)
                    dlon = float((lon[-1] - lon[0]) / max(1, len(lon) - 1))
                    dlat = float((lat[-1] - lat[0]) / max(1, len(lat) - 1))
                    found.append(
                        (float(lon[0]) - dlon / 2, float(lat[0]) - dlat / 2, dlon, dlat, len(lon), len(lat))
                    )
            names = ["lon0", "lat0", "dlon", "dlat", "nx", "ny"]
            kinds = [pa.float64()] * 4 + [pa.int32()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)], names=names
            )

    return (
        _matching(spark, folder, pattern).select("content")
        .mapInArrow(axes, "lon0 double, lat0 double, dlon double, dlat double, nx int, ny int")
        .distinct()
    )
