"""Gridded time series and zonal statistics as lazy Spark DataFrame operators."""

from gridzonal.schema import GridSpec
from gridzonal.session import build_session

__all__ = ["GridSpec", "build_session"]
