"""Declared schemas, the grid description and the fixed lookup values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class GridSpec:
    """A regular lon/lat grid.

    ``lon0``/``lat0`` are the western and southern *edges*; cell ``(iy, ix)`` spans
    ``[lon0 + ix*dlon, lon0 + (ix+1)*dlon] x [lat0 + iy*dlat, lat0 + (iy+1)*dlat]``.
    """

    grid_id: str
    lon0: float
    lat0: float
    dlon: float
    dlat: float
    nx: int
    ny: int

    def __post_init__(self) -> None:
        if abs(self.nx * self.dlon - 360.0) > 1e-6 * self.dlon and self.nx * self.dlon > 360.0:
            raise ValueError(f"grid {self.grid_id!r} goes more than once around the globe")
        if self.dlon <= 0 or self.dlat <= 0 or self.nx < 1 or self.ny < 1:
            raise ValueError(f"grid {self.grid_id!r} needs positive steps and at least one cell")

    @property
    def rounding(self) -> float:
        """The error of a position on the grid, in steps, that comes from rounding its coordinates alone."""
        ends = (self.lon0, self.lon0 + self.nx * self.dlon, self.lat0, self.lat0 + self.ny * self.dlat)
        return 16 * 2.0**-52 * max(map(abs, ends)) / min(self.dlon, self.dlat)

    @property
    def closed(self) -> bool:
        """Whether the last column is next to the first one, as on a global grid."""
        return abs(self.nx * self.dlon - 360.0) <= 1e-6 * self.dlon


GRID_OBS = T.StructType(
    [
        T.StructField("variable", T.StringType()),
        T.StructField("run_time", T.TimestampNTZType()),
        T.StructField("valid_time", T.TimestampNTZType()),
        T.StructField("lead_hour", T.IntegerType()),
        T.StructField("iy", T.IntegerType()),
        T.StructField("ix", T.IntegerType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("value", T.DoubleType()),
    ]
)

POINT = T.StructType([T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])

RING = T.StructType(
    [T.StructField("role", T.StringType()), T.StructField("pts", T.ArrayType(POINT))]
)

ZONES = T.StructType(
    [T.StructField("zone_id", T.LongType()), T.StructField("rings", T.ArrayType(RING))]
)

ZONE_DAILY = T.StructType(
    [
        T.StructField("variable", T.StringType()),
        T.StructField("stat", T.StringType()),
        T.StructField("code_muni", T.LongType()),
        T.StructField("date", T.DateType()),
        T.StructField("value", T.DoubleType()),
    ]
)

# Requested variable name of each short variable name.
REQUEST_NAMES = {
    "pm25": "particulate_matter_2.5um",
    "pm10": "particulate_matter_10um",
    "pm1": "particulate_matter_1um",
    "co": "total_column_carbon_monoxide",
    "no2": "total_column_nitrogen_dioxide",
    "o3": "total_column_ozone",
    "temp": "2m_temperature",
    "uv": "uv_biologically_effective_dose",
}

# Steps of a day in the historical record; ozone starts at 06:00.
DAY_STEPS = ("00:00", "03:00", "06:00", "09:00", "12:00", "15:00", "18:00", "21:00")
DAY_STEPS_O3 = ("06:00", "09:00", "12:00", "15:00", "18:00", "21:00")
SPECIAL_STEPS = {"o3": DAY_STEPS_O3}

# Last lead hour of a forecast run, and its area (north, west, south, east).
LAST_LEAD_HOUR = 120
FORECAST_AREA = (33.0, -118.0, -56.0, -30.0)

# reported = model * scale + offset, and the reported unit.
CONVERSIONS = {
    "pm25": (1e9, 0.0, "µg/m³"),
    "pm10": (1e9, 0.0, "µg/m³"),
    "pm1": (1e9, 0.0, "µg/m³"),
    "co": (1e9, 0.0, "µg/m²"),
    "no2": (1e6, 0.0, "mg/m²"),
    "o3": (44698.0, 0.0, "DU"),
    "temp": (1.0, -273.15, "°C"),
    "uv": (40.0, 0.0, "UV index"),
}


def conversions(profile: str = "default") -> dict[str, tuple[float, float, str]]:
    """The conversion table; ``profile="reference"`` keeps the historical Kelvin offset of 272.15."""
    if profile == "default":
        return dict(CONVERSIONS)
    if profile == "reference":
        return {**CONVERSIONS, "temp": (1.0, -272.15, "°C")}
    raise ValueError(f"unknown conversion profile {profile!r}")
