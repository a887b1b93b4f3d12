"""Grid files as a Spark data source that reads byte ranges and writes with a commit.

Reading opens the header of each file, plans (file, variable, layers, rows) byte ranges and spreads them over tasks, so that a file of any
size is read by many tasks, and one layer of a long forecast costs the bytes of that layer. Predicates on ``source_file``, ``variable``,
``layer`` and ``lat`` are used for planning, also those that Catalyst brings there from above; Spark applies them again to the rows. The required area cuts rows
of bytes, and columns before cells are made.

Writing streams the layers of a file one after the other, so a task holds one layer. Files are visible after the job has
committed: tasks write under hidden names, the commit moves them, and a failed job leaves nothing that a reader would list.
"""

from __future__ import annotations

import datetime as dt
import re
import sys
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from struct import error as StructError

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)

from gridzonal.functions.names import date_from_name, stat_from_name
from gridzonal.schema import GridSpec
from gridzonal.sources import netcdf
from gridzonal.sources.grid_files import BATCH_CELLS, to_observations
from gridzonal.storage import arrow_uri

RANGE_BYTES = 64 << 20
HEADER_BYTES = 16 << 10
OPENED_AT_ONCE = 32

SCHEMA = "source_file string, variable string, layer int, valid_time timestamp_ntz, lat double, lon double, value double"
_ARROW = pa.schema(
    [
        ("source_file", pa.string()),
        ("variable", pa.string()),
        ("layer", pa.int32()),
        ("valid_time", pa.timestamp("us")),
        ("lat", pa.float64()),
        ("lon", pa.float64()),
        ("value", pa.float64()),
    ]
)
WRITTEN = ("source_file", "variable", "layer", "valid_time", "iy", "ix", "value")
# Hides unfinished files from readers of the folder.
HIDDEN = "_unfinished-"


class GridFile:
    """A file opened for ranges of bytes; ``read_bytes`` counts what was read."""

    def __init__(self, filesystem: fs.FileSystem, path: str):
        self.source, self.path, self.read_bytes = filesystem.open_input_file(path), path, 0
        self.length = self.source.size()
        size = HEADER_BYTES
        while True:
            head = self.read(0, min(size, self.length))
            if head[:8] == netcdf.HDF5_MAGIC:
                netcdf.read_variables(head)  # says that the layout is not supported
            try:
                self.entries = netcdf.describe(head, self.length)
                return
            except (StructError, ValueError) as problem:
                cut_off = isinstance(problem, StructError) or "truncated header" in str(problem)
                if size >= self.length or not cut_off:
                    raise ValueError(str(problem)) from problem
                size *= 8

    def read(self, begin: int, size: int) -> bytes:
        self.source.seek(begin)
        self.read_bytes += size
        data = self.source.read(size)
        if len(data) < size:
            raise ValueError(f"truncated: {size} bytes at {begin} are not there")
        return data

    def values(self, name: str) -> np.ndarray:
        """All values of a variable that is small, such as an axis."""
        entry = self.entries[name]
        if not entry.record:
            return np.frombuffer(self.read(entry.begin, entry.slab), entry.dtype).reshape(entry.shape)
        slabs = [self.read(entry.begin + i * entry.stride, entry.slab) for i in range(entry.count)]
        return np.frombuffer(b"".join(slabs), entry.dtype).reshape((entry.count, *entry.shape))

    def grids(self) -> dict[str, "Grid"]:
        found = {}
        for name, entry in self.entries.items():
            if len(entry.dims) > 1 and entry.dims[-2].startswith("lat") and entry.dims[-1].startswith("lon"):
                found[name] = Grid(self, name, entry)
        if not found:
            raise ValueError("no variable on a (lat, lon) grid")
        return found


class Grid:
    """One variable of a file: its axes and where its layers lie."""

    def __init__(self, file: GridFile, name: str, entry: netcdf.Entry):
        self.file, self.name, self.entry = file, name, entry
        self.ny, self.nx = entry.shape[-2:]
        self.row_bytes = self.nx * entry.dtype.itemsize
        self.inner = int(np.prod(entry.shape[:-2], dtype=np.int64))
        self.layers = self.inner * entry.count

    def begin_of(self, layer: int) -> int:
        record, rest = divmod(layer, self.inner) if self.inner else (0, 0)
        return self.entry.begin + record * self.entry.stride + rest * self.ny * self.row_bytes

    def axis(self, at: int) -> np.ndarray:
        return self.file.values(self.entry.dims[at]).astype(np.float64)

    def times(self) -> list[dt.datetime] | None:
        entries = self.file.entries
        for name in ("valid_time", *self.entry.dims[:-2]):
            entry = entries.get(name)
            if entry is not None and int(np.prod(entry.shape, dtype=np.int64)) * entry.count == self.layers:
                times = netcdf.times_of(self.file.values(name), entry.attrs)
                if times is not None:
                    return times
        return None

    def rows(self, layer: int, first: int, last: int) -> np.ndarray:
        data = self.file.read(self.begin_of(layer) + first * self.row_bytes, (last - first) * self.row_bytes)
        return np.frombuffer(data, self.entry.dtype).reshape(last - first, self.nx)


@dataclass
class LayerRange(InputPartition):
    """Rows [first_row, last_row) of the layers [first, last) of a variable."""

    file: str
    variable: str
    first: int
    last: int
    first_row: int
    last_row: int
    bytes: int


class LayerReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.folder, self.pattern = options["path"], options.get("pattern", r"\.nc$")
        self.range_bytes = int(options.get("range_bytes", RANGE_BYTES))
        self.area = [float(x) for x in options["area"].split(",")] if "area" in options else None
        self.axes = [float(x) for x in options["axes"].split(",")] if "axes" in options else None
        self.tests: list = []

    def pushFilters(self, filters):
        known = (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)
        for item in filters:
            if isinstance(item, known) and len(item.attribute) == 1 and item.attribute[0] in ("source_file", "variable", "layer", "lat"):
                self.tests.append((item.attribute[0], type(item).__name__, item.value))
            # Planning leaves out what can't match; Spark tests the rows that remain.
            yield item

    def _keeps(self, column: str, values: np.ndarray) -> np.ndarray:
        """Which of ``values`` may be asked for."""
        keep = np.ones(len(values), dtype=bool)
        for name, kind, wanted in self.tests:
            if name != column:
                continue
            if kind == "EqualTo":
                keep &= values == wanted
            elif kind == "In":
                keep &= np.isin(values, [v for v in wanted if v is not None])
            elif kind == "GreaterThan":
                keep &= values > wanted
            elif kind == "GreaterThanOrEqual":
                keep &= values >= wanted
            elif kind == "LessThan":
                keep &= values < wanted
            else:
                keep &= values <= wanted
        return keep

    def _rows(self, lats: np.ndarray) -> np.ndarray:
        keep = self._keeps("lat", lats)
        return keep if self.area is None else keep & (lats >= self.area[2]) & (lats <= self.area[0])

    def _columns(self, lons: np.ndarray) -> np.ndarray:
        if self.area is None:
            return np.arange(len(lons))
        wrapped = (lons + 180.0) % 360.0 - 180.0
        return np.flatnonzero((wrapped >= self.area[1]) & (wrapped <= self.area[3]))

    def _check(self, grid: Grid) -> None:
        if self.axes is None:
            return
        lon0, lat0, dlon, dlat, nx, ny = self.axes
        for values, origin, step, count, turn in ((grid.axis(-2), lat0, dlat, ny, None), (grid.axis(-1), lon0, dlon, nx, 360.0)):
            place = ((values - origin) if turn is None else (values - origin) % turn) / step - 0.5
            if len(values) and (np.abs(place - np.round(place)).max() > 0.01 or np.round(place).min() < 0 or np.round(place).max() > count - 1):
                raise ValueError(f"its axes are not cell centres of the grid (origin {origin}, step {step}, {count} cells)")

    def _plan(self, filesystem: fs.FileSystem, path: str) -> list[LayerRange]:
        name = path.rsplit("/", 1)[-1]
        try:
            found = []
            for variable, grid in GridFile(filesystem, path).grids().items():
                if not self._keeps("variable", np.array([variable], dtype=object))[0]:
                    continue
                self._check(grid)
                rows = np.flatnonzero(self._rows(grid.axis(-2)))
                layers = np.flatnonzero(self._keeps("layer", np.arange(grid.layers)))
                if not len(rows) or not len(layers):
                    continue
                # Rows between the first and the last that matter are read in one go.
                first_row, last_row = int(rows[0]), int(rows[-1]) + 1
                size = (last_row - first_row) * grid.row_bytes
                band = max(1, min(last_row - first_row, self.range_bytes // max(1, grid.row_bytes)))
                together = max(1, self.range_bytes // max(1, size)) if band == last_row - first_row else 1
                runs = np.split(layers, np.flatnonzero(np.diff(layers) > 1) + 1)
                for run in runs:
                    for first in range(int(run[0]), int(run[-1]) + 1, together):
                        last = min(first + together, int(run[-1]) + 1)
                        for row in range(first_row, last_row, band):
                            stop = min(row + band, last_row)
                            held = (last - first) * (stop - row) * grid.row_bytes
                            found.append(LayerRange(name, variable, first, last, row, stop, held))
            return found
        except (ValueError, KeyError, IndexError, OverflowError, StructError) as problem:
            raise ValueError(f"cannot read grid file {path}: {problem}") from problem

    def partitions(self) -> list[LayerRange]:
        filesystem, root = fs.FileSystem.from_uri(self.folder)
        infos = filesystem.get_file_info(fs.FileSelector(root))
        names = [i.base_name for i in infos if i.type == fs.FileType.File and not i.base_name.startswith(("_", "."))]
        names = np.array(sorted(n for n in names if re.search(self.pattern, n)), dtype=object)
        wanted = names[self._keeps("source_file", names)] if len(names) else names
        with ThreadPoolExecutor(OPENED_AT_ONCE) as pool:
            planned = pool.map(lambda name: self._plan(filesystem, f"{root}/{name}"), wanted)
            found = [part for parts in planned for part in parts]
        return found or [LayerRange("", "", 0, 0, 0, 0, 0)]

    def read(self, partition: LayerRange) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        filesystem, root = fs.FileSystem.from_uri(self.folder)
        path = f"{root}/{partition.file}"
        try:
            file = GridFile(filesystem, path)
            grid = file.grids()[partition.variable]
            lats, lons, times = grid.axis(-2), grid.axis(-1), grid.times()
            keep, columns = self._rows(lats), self._columns(lons)
            if not len(columns):
                return
            step = max(1, BATCH_CELLS // max(len(columns), grid.nx))
            for layer in range(partition.first, partition.last):
                for first in range(partition.first_row, partition.last_row, step):
                    last = min(first + step, partition.last_row)
                    inside = np.flatnonzero(keep[first:last])
                    if len(inside):
                        raw = grid.rows(layer, first, last)[np.ix_(inside, columns)]
                        values = netcdf.unpack(raw, grid.entry.attrs).ravel()
                        time = times[layer] if times else None
                        yield self._batch(partition, layer, time, lats[first + inside], lons[columns], values)
        except (ValueError, KeyError, IndexError, OverflowError, StructError) as problem:
            raise ValueError(f"cannot read grid file {path}: {problem}") from problem

    @staticmethod
    def _batch(partition: LayerRange, layer: int, time, lats: np.ndarray, lons: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        def same(value, kind):
            return pa.repeat(pa.scalar(value, kind), values.size)

        return pa.RecordBatch.from_arrays(
            [
                same(partition.file, pa.string()),
                same(partition.variable, pa.string()),
                same(layer, pa.int32()),
                same(time, pa.timestamp("us")),
                pa.array(np.repeat(lats, len(lons))),
                pa.array(np.tile(lons, len(lats))),
                pa.array(values, mask=np.isnan(values)),
            ],
            schema=_ARROW,
        )


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class LayerWriter(DataSourceArrowWriter):
    """Rows must come by file and layer, as ``write_grid_layers`` arranges them."""

    def __init__(self, options: dict[str, str]):
        self.folder = options["path"]
        lon0, lat0, dlon, dlat, nx, ny = (float(x) for x in options["axes"].split(","))
        self.ny, self.nx = int(ny), int(nx)
        self.lats = lat0 + (np.arange(self.ny) + 0.5) * dlat
        self.lons = lon0 + (np.arange(self.nx) + 0.5) * dlon

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        filesystem, root = fs.FileSystem.from_uri(self.folder)
        filesystem.create_dir(root, recursive=True)
        files: list[tuple[str, str]] = []
        out, at, parts = None, None, []

        def finish_layer() -> None:
            """Write the layer at hand, and empty ones for the numbers that were passed over."""
            nonlocal written
            name, _variable, layer, time = at
            iy, ix, value = (np.concatenate(column) for column in zip(*parts))
            if ((iy < 0) | (iy >= self.ny) | (ix < 0) | (ix >= self.nx)).any():
                raise ValueError(f"{name}: cells outside the grid")
            if len(np.unique(iy.astype(np.int64) * self.nx + ix)) < len(iy):
                raise ValueError(f"{name}: two rows for one cell of layer {layer}")
            empty = np.full((self.ny, self.nx), np.nan)
            while written < layer:
                out.write(netcdf.stream_layer(np.nan, empty))
                written += 1
            empty[iy, ix] = value
            hours = (time - dt.datetime(1970, 1, 1)) / dt.timedelta(hours=1) if time is not None else float(layer)
            out.write(netcdf.stream_layer(hours, empty))
            written += 1
            parts.clear()

        written = 0
        for batch in iterator:
            keys = list(zip(*(batch.column(c).to_pylist() for c in WRITTEN[:4])))
            edges = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            iy, ix = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("iy", "ix"))
            value = batch.column("value").cast(pa.float64()).to_numpy(zero_copy_only=False)
            for first, last in zip(edges, edges[1:]):
                if first == last:
                    continue
                key = keys[first]
                if at is not None and key != at:
                    finish_layer()
                    if key[:1] == at[:1] and (key[1] != at[1] or key[2] == at[2]):
                        raise ValueError(f"{key[0]}: two variables, or two times of layer {key[2]}")
                if at is None or key[0] != at[0]:
                    if out is not None:
                        out.close()
                    hidden = f"{HIDDEN}{uuid.uuid4().hex}-{key[0]}"
                    files.append((hidden, key[0]))
                    out, written = filesystem.open_output_stream(f"{root}/{hidden}", compression=None), 0
                    out.write(netcdf.stream_header(key[1], self.lats, self.lons, None if key[3] is None else "1970-01-01 00:00:00"))
                at = key
                parts.append((iy[first:last], ix[first:last], value[first:last]))
        if at is not None:
            finish_layer()
            out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        filesystem, root = fs.FileSystem.from_uri(self.folder)
        moves = [move for message in messages if message is not None for move in message.files]
        with ThreadPoolExecutor(OPENED_AT_ONCE) as pool:
            list(pool.map(lambda move: filesystem.move(f"{root}/{move[0]}", f"{root}/{move[1]}"), moves))

    def abort(self, messages: list[Written | None]) -> None:
        filesystem, root = fs.FileSystem.from_uri(self.folder)
        for message in messages:
            for hidden, _name in message.files if message is not None else ():
                filesystem.delete_file(f"{root}/{hidden}")


class GridLayers(DataSource):
    @classmethod
    def name(cls) -> str:
        return "gridlayers"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LayerReader:
        return LayerReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> LayerWriter:
        return LayerWriter(dict(self.options))


def _register(spark: SparkSession) -> None:
    # Workers get the source with the task, whether or not the package is installed there.
    for module in (netcdf, sys.modules[__name__]):
        cloudpickle.register_pickle_by_value(module)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(GridLayers)


def _axes(spec: GridSpec) -> str:
    return ",".join(map(repr, (spec.lon0, spec.lat0, spec.dlon, spec.dlat, spec.nx, spec.ny)))


def scan_layers(
    spark: SparkSession,
    folder: str,
    spec: GridSpec | None = None,
    pattern: str = r"\.nc$",
    area: tuple[float, float, float, float] | None = None,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """(source_file, variable, layer, valid_time, lat, lon, value) of the grid files of a folder, read by ranges of bytes.

    ``layer`` counts from 0. With ``spec`` the axes of every file must lie on that grid. ``area`` is (north, west, south, east).
    """
    _register(spark)
    options = {"pattern": pattern, "range_bytes": str(range_bytes)}
    if spec is not None:
        options["axes"] = _axes(spec)
    if area is not None:
        options["area"] = ",".join(map(repr, map(float, area)))
    return spark.read.format("gridlayers").options(**options).load(arrow_uri(spark, folder))


def scan_run_layers(
    spark: SparkSession,
    folder: str,
    spec: GridSpec,
    run_time: Column,
    pattern: str = r"\.nc$",
    area: tuple[float, float, float, float] | None = None,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Files of forecast runs as ``grid_obs`` rows; ``run_time`` is an expression over the file's name, ``path``.

    The layer is the lead hour, so a filter on ``lead_hour`` reads the bytes of those layers, and one on ``lat`` those rows.
    """
    cells = scan_layers(spark, folder, spec, pattern, area, range_bytes).withColumn("path", F.col("source_file"))
    nothing = F.lit(None)
    known = cells.withColumns(
        {
            "run_time": run_time.cast("timestamp_ntz"),
            "stat": stat_from_name(F.col("path")),
            "name_date": date_from_name(F.col("path")),
            "modified": nothing.cast("timestamp"),
        }
    )
    return to_observations(known, spec, is_forecast=True)


def write_grid_layers(cells: DataFrame, folder: str, spec: GridSpec) -> None:
    """Write (source_file, variable, layer, iy, ix, value[, valid_time]) as one file per ``source_file``, replacing files of that name.

    Layers count from 0; those without a row are empty. Without ``valid_time`` the files have no times.
    """
    spark = cells.sparkSession
    _register(spark)
    time = F.col("valid_time") if "valid_time" in cells.columns else F.lit(None)
    arranged = cells.select(
        F.col("source_file").cast("string"),
        F.col("variable").cast("string"),
        F.col("layer").cast("int"),
        time.cast("timestamp_ntz").alias("valid_time"),
        F.col("iy").cast("int"),
        F.col("ix").cast("int"),
        F.col("value").cast("double"),
    )
    arranged = arranged.repartition("source_file").sortWithinPartitions(*WRITTEN[:4])
    arranged.write.format("gridlayers").option("axes", _axes(spec)).mode("append").save(arrow_uri(spark, folder))
