"""One classic NetCDF file <-> numpy arrays, used inside Spark tasks only.

Covers the three classic layouts (32-bit offsets, 64-bit offsets, 64-bit data) as published in the
NetCDF file format specification. Files in the newer HDF5-based layout are refused.
"""

from __future__ import annotations

import datetime as dt
import re
import struct
from dataclasses import dataclass, replace

import numpy as np

# Fixed values of the file format: list tags and external types.
TAG_DIMENSION, TAG_VARIABLE, TAG_ATTRIBUTE = 10, 11, 12
DTYPES = {
    1: ">i1",
    2: "S1",
    3: ">i2",
    4: ">i4",
    5: ">f4",
    6: ">f8",
    7: ">u1",
    8: ">u2",
    9: ">u4",
    10: ">i8",
    11: ">u8",
}
# What fills unwritten values of each type where a file declares no fill; single bytes have none.
DEFAULT_FILLS = {
    "i2": -32767,
    "i4": -2147483647,
    "f4": 9.9692099683868690e36,
    "f8": 9.9692099683868690e36,
    "u2": 65535,
    "u4": 4294967295,
    "i8": -9223372036854775806,
    "u8": 18446744073709551614,
}
HDF5_MAGIC = b"\x89HDF\r\n\x1a\n"
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


class _Header:
    """Cursor over the big-endian header."""

    def __init__(self, data: bytes) -> None:
        if data[:3] != b"CDF" or len(data) < 4 or data[3] not in (1, 2, 5):
            raise ValueError("not a classic NetCDF file")
        self.data, self.at = data, 4
        self.count = ">q" if data[3] == 5 else ">i"
        self.offset = ">i" if data[3] == 1 else ">q"

    def read(self, fmt: str) -> int:
        (value,) = struct.unpack_from(fmt, self.data, self.at)
        self.at += struct.calcsize(fmt)
        return value

    def take(self, size: int) -> bytes:
        chunk = self.data[self.at : self.at + size]
        if len(chunk) < size:
            raise ValueError("truncated header")
        self.at += size + -size % 4
        return chunk

    def name(self) -> str:
        return self.take(self.read(self.count)).decode("utf-8")

    def items(self, tag: int) -> range:
        found, n = self.read(">i"), self.read(self.count)
        if found not in (0, tag):
            raise ValueError(f"bad header: list tag {found} instead of {tag}")
        return range(n)

    def attributes(self) -> dict:
        result = {}
        for _ in self.items(TAG_ATTRIBUTE):
            key, kind, n = self.name(), self.read(">i"), self.read(self.count)
            raw = self.take(n * np.dtype(DTYPES[kind]).itemsize)
            result[key] = (
                raw.decode("utf-8", "replace").rstrip("\0")
                if kind == 2
                else np.frombuffer(raw, DTYPES[kind])
            )
        return result


@dataclass(frozen=True)
class Entry:
    """Where a variable lies in its file. A record variable has ``count`` slabs of ``shape``, ``stride`` bytes apart."""

    dims: tuple[str, ...]
    attrs: dict
    dtype: np.dtype
    begin: int
    count: int
    shape: tuple[int, ...]
    stride: int
    record: bool

    @property
    def slab(self) -> int:
        return int(np.prod(self.shape, dtype=np.int64)) * self.dtype.itemsize

    @property
    def end(self) -> int:
        return self.begin + (self.count - 1) * self.stride + self.slab if self.record and self.count else self.begin + self.slab


def describe(data: bytes, length: int) -> dict[str, Entry]:
    """The variables of a file of ``length`` bytes, from its header alone."""
    head = _Header(data)
    records = head.read(head.count)
    dims = [(head.name(), head.read(head.count)) for _ in head.items(TAG_DIMENSION)]
    head.attributes()
    found = []
    for _ in head.items(TAG_VARIABLE):
        name = head.name()
        ids = [head.read(head.count) for _ in range(head.read(head.count))]
        attrs, kind, _size = head.attributes(), head.read(">i"), head.read(head.count)
        begin = head.read(head.offset)
        record = bool(ids) and dims[ids[0]][1] == 0
        shape = tuple(dims[i][1] for i in (ids[1:] if record else ids))
        names = tuple(dims[i][0] for i in ids)
        found.append((name, Entry(names, attrs, np.dtype(DTYPES[kind]), begin, 1, shape, 0, record)))
    slabs = [entry.slab for _name, entry in found if entry.record]
    # A lone record variable is stored without padding between records.
    stride = slabs[0] if len(slabs) == 1 else sum(size + -size % 4 for size in slabs)
    result = {}
    for name, entry in found:
        if entry.record:
            # A negative number of records: as many as the file holds.
            count = records if records >= 0 else (length - entry.begin + stride - entry.slab) // stride
            entry = replace(entry, count=count, stride=stride)
        if entry.count and entry.end > length:
            raise ValueError(f"truncated: variable {name!r} needs {entry.end} bytes, file has {length}")
        result[name] = entry
    return result


def read_classic(data: bytes) -> dict[str, tuple[tuple[str, ...], np.ndarray, dict]]:
    """Variables by name: (dimension names, array, attributes). Arrays are views where possible."""
    result = {}
    for name, entry in describe(data, len(data)).items():
        if entry.record:
            steps = (entry.stride, *np.empty(entry.shape, entry.dtype).strides)
            array = np.ndarray((entry.count, *entry.shape), entry.dtype, buffer=data, offset=entry.begin, strides=steps)
        else:
            size = entry.slab // entry.dtype.itemsize
            array = np.frombuffer(data, entry.dtype, size, entry.begin).reshape(entry.shape)
        result[name] = (entry.dims, array, entry.attrs)
    return result


def read_variables(data: bytes) -> dict[str, tuple[tuple[str, ...], np.ndarray, dict]]:
    if data[:8] == HDF5_MAGIC:
        raise ValueError("HDF5-based NetCDF is not supported; convert the file to a classic layout")
    return read_classic(data)


def unpack(raw: np.ndarray, attrs: dict) -> np.ndarray:
    """Doubles with fill values as NaN and packing undone."""
    values = raw.astype(np.float64)
    fills = [np.asarray(attrs[key]).ravel()[0] for key in ("_FillValue", "missing_value") if key in attrs]
    default = DEFAULT_FILLS.get(raw.dtype.str[1:])
    if "_FillValue" not in attrs and default is not None:
        fills.append(np.array(default, raw.dtype))
    for fill in fills:
        # Compare in the stored type: a float32 fill is not its double literal.
        values[raw == fill.astype(raw.dtype)] = np.nan
    scale = float(np.asarray(attrs.get("scale_factor", 1.0)).ravel()[0])
    offset = float(np.asarray(attrs.get("add_offset", 0.0)).ravel()[0])
    return values if (scale, offset) == (1.0, 0.0) else values * scale + offset


def times_of(raw: np.ndarray, attrs: dict) -> list[dt.datetime] | None:
    """``<unit> since <instant>`` coordinates as UTC datetimes; None when they are not of that form."""
    match = re.match(
        r"\s*(second|minute|hour|day)s?\s+since\s+(\d{4})-(\d{1,2})-(\d{1,2})"
        r"(?:[T ](\d{1,2}):(\d{2})(?::(\d{2}))?)?",
        str(attrs.get("units", "")),
    )
    if match is None:
        return None
    unit, *parts = match.groups(default="0")
    origin = dt.datetime(*map(int, parts))
    return [
        None if np.isnan(float(t)) else origin + dt.timedelta(seconds=round(float(t) * UNIT_SECONDS[unit])) for t in np.ravel(raw)
    ]


def layers_of(data: bytes):
    """(variable, lats, lons, times or None, attrs, layers x lat x lon array) of each grid variable."""
    variables = read_variables(data)
    grids = 0
    for name, (dims, array, attrs) in variables.items():
        if len(dims) < 2 or not (dims[-2].startswith("lat") and dims[-1].startswith("lon")):
            continue
        grids += 1
        lats, lons = variables[dims[-2]][1], variables[dims[-1]][1]
        layers = array.reshape((-1, *array.shape[-2:]))
        times = None
        for coordinate in ("valid_time", *dims[:-2]):
            if coordinate in variables and variables[coordinate][1].size == len(layers):
                times = times_of(variables[coordinate][1], variables[coordinate][2])
                if times is not None:
                    break
        yield name, lats.astype(np.float64), lons.astype(np.float64), times, attrs, layers
    if not grids:
        raise ValueError("no variable on a (lat, lon) grid")


def _text(value: str) -> bytes:
    raw = value.encode("utf-8")
    return struct.pack(">i", len(raw)) + raw + b"\0" * (-len(raw) % 4)


def _attribute_list(**attrs) -> bytes:
    body = struct.pack(">ii", TAG_ATTRIBUTE if attrs else 0, len(attrs))
    for key, value in attrs.items():
        if isinstance(value, str):
            body += _text(key) + struct.pack(">i", 2) + _text(value)
        else:
            body += _text(key) + struct.pack(">iid", 6, 1, value)
    return body


def write_classic(
    variable: str,
    lats: np.ndarray,
    lons: np.ndarray,
    layers: np.ndarray,
    hours: np.ndarray | None = None,
    epoch: str | None = "1970-01-01 00:00:00",
) -> bytes:
    """A 64-bit-offset file with one double variable on (time, latitude, longitude); NaN is the fill.

    Without ``epoch`` the layers have numbers but no times.
    """

    hours = np.zeros(len(layers)) if hours is None else hours
    sizes = {"time": len(layers), "latitude": len(lats), "longitude": len(lons)}
    dims = struct.pack(">ii", TAG_DIMENSION, len(sizes))
    dims += b"".join(_text(name) + struct.pack(">i", n) for name, n in sizes.items())
    plan = [
        ("time", [0], _attribute_list(**({} if epoch is None else {"units": f"hours since {epoch}"})), hours),
        ("latitude", [1], _attribute_list(units="degrees_north"), lats),
        ("longitude", [2], _attribute_list(units="degrees_east"), lons),
        (variable, [0, 1, 2], _attribute_list(_FillValue=float("nan")), layers),
    ]

    def header(offsets: list[int]) -> bytes:
        out = b"CDF\x02" + struct.pack(">i", 0) + dims + struct.pack(">ii", 0, 0)
        out += struct.pack(">ii", TAG_VARIABLE, len(plan))
        for (name, ids, attrs, array), begin in zip(plan, offsets):
            out += _text(name) + struct.pack(f">i{len(ids)}i", len(ids), *ids) + attrs
            # The size field saturates for large variables; readers derive it from the shape.
            out += struct.pack(">iIq", 6, min(array.size * 8, 2**32 - 1), begin)
        return out

    at, offsets = len(header([0] * len(plan))), []
    for *_, array in plan:
        offsets.append(at)
        at += array.size * 8
    return header(offsets) + b"".join(np.ascontiguousarray(a, ">f8").tobytes() for *_, a in plan)


def stream_header(variable: str, lats: np.ndarray, lons: np.ndarray, epoch: str | None = "1970-01-01 00:00:00") -> bytes:
    """The start of a file whose layers follow one by one, each from ``stream_layer``; their number need not be known."""
    sizes = {"time": 0, "latitude": len(lats), "longitude": len(lons)}
    dims = struct.pack(">ii", TAG_DIMENSION, len(sizes)) + b"".join(_text(n) + struct.pack(">i", k) for n, k in sizes.items())
    plan = [
        ("latitude", [1], _attribute_list(units="degrees_north"), 8 * len(lats)),
        ("longitude", [2], _attribute_list(units="degrees_east"), 8 * len(lons)),
        ("time", [0], _attribute_list(**({} if epoch is None else {"units": f"hours since {epoch}"})), 8),
        (variable, [0, 1, 2], _attribute_list(_FillValue=float("nan")), 8 * len(lats) * len(lons)),
    ]

    def header(offsets: list[int]) -> bytes:
        out = b"CDF\x02" + struct.pack(">i", -1) + dims + struct.pack(">ii", 0, 0) + struct.pack(">ii", TAG_VARIABLE, len(plan))
        for (name, ids, attrs, size), begin in zip(plan, offsets):
            out += _text(name) + struct.pack(f">i{len(ids)}i", len(ids), *ids) + attrs
            out += struct.pack(">iIq", 6, min(size, 2**32 - 1), begin)
        return out

    at, offsets = len(header([0] * len(plan))), []
    for *_, size in plan:
        offsets.append(at)
        at += size
    return header(offsets) + np.ascontiguousarray(lats, ">f8").tobytes() + np.ascontiguousarray(lons, ">f8").tobytes()


def stream_layer(hours: float, layer: np.ndarray) -> bytes:
    return np.array([hours], ">f8").tobytes() + np.ascontiguousarray(layer, ">f8").tobytes()
