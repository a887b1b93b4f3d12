"""File names, run markers and zone codes as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def base_name(path: Column) -> Column:
    return F.regexp_replace(path, r"^.*/", "")


def file_stem(path: Column) -> Column:
    """Base name without its last extension."""
    return F.regexp_replace(base_name(path), r"[.][^.]*$", "")


def date_from_name(name: Column) -> Column:
    """The eight digits after an underscore, as a date; NULL when there is no valid one.

    Found by pattern, not by position, so variable names of any length work.
    """
    return F.try_to_date(F.regexp_extract(base_name(name), r"_([0-9]{8})", 1), "yyyyMMdd")


def variable_from_name(name: Column) -> Column:
    """The part between the prefix and the date: ``grid_pm25_20240102_mean.nc`` gives ``pm25``.

    ``forecast_`` before it is left out, and a forecast file may have no date: ``grid_forecast_pm25.nc``.
    """
    base = base_name(name)
    dated = F.regexp_extract(base, r"^[^_]+_(?:forecast_)?(.+)_[0-9]{8}", 1)
    undated = F.regexp_extract(base, r"^[^_]+_forecast_([^_.]+)[.][^.]+$", 1)
    return F.when(dated != "", dated).when(undated != "", undated)


def stat_from_name(name: Column) -> Column:
    """``mean``, ``max`` or ``min`` at the end of a daily file's stem; NULL elsewhere."""
    found = F.regexp_extract(base_name(name), r"_(mean|max|min)[.][^.]*$", 1)
    return F.when(found != "", found)


def run_hour(text: Column) -> Column:
    """The hour of ``HH:MM`` wherever it stands in a marker or time string."""
    return F.regexp_extract(text, r"([0-9]{2}):", 1).try_cast("int")


def run_time_from_marker(marker: Column) -> Column:
    """``datestamp_20250709_12:00`` gives 2025-07-09 12:00 (UTC)."""
    return F.timestamp_add("HOUR", run_hour(marker), date_from_name(marker).cast("timestamp_ntz"))


def clock(time: Column) -> Column:
    """``HH:MM`` of a TIMESTAMP_NTZ, untouched by the session's time zone."""
    return F.concat_ws(
        ":",
        F.lpad(F.hour(time).cast("string"), 2, "0"),
        F.lpad(F.minute(time).cast("string"), 2, "0"),
    )


def run_marker(run_time: Column) -> Column:
    day = F.date_format(run_time.cast("date"), "yyyyMMdd")
    return F.concat(F.lit("datestamp_"), day, F.lit("_"), clock(run_time))


def grid_file_name(
    variable: Column, date: Column, stat: str | None = None, prefix: str = "grid"
) -> Column:
    """``<prefix>_<variable>_<yyyymmdd>[_<stat>].nc``."""
    tail = ".nc" if stat is None else f"_{stat}.nc"
    return F.concat(
        F.lit(f"{prefix}_"), variable, F.lit("_"), F.date_format(date, "yyyyMMdd"), F.lit(tail)
    )


def code6(code: Column) -> Column:
    """First six digits of a seven-digit zone code.

    The cast to BIGINT comes first: a code held as double would print as ``5103403.0`` or in
    scientific notation.
    """
    return F.substring(code.cast("bigint").cast("string"), 1, 6).cast("bigint")
