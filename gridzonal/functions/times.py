"""Model-run clocks and calendar filters. Times are TIMESTAMP_NTZ holding UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_ZONE = "America/Sao_Paulo"


def valid_time(run_time: Column, lead_hour: Column) -> Column:
    """Run time plus the lead, on the UTC time line."""
    return F.timestamp_add("HOUR", lead_hour, run_time)


def local_time(utc: Column, zone: str = DEFAULT_ZONE) -> Column:
    """Wall clock of a UTC instant in ``zone``, summer time included."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def latest_cycle(now_utc: Column) -> Column:
    """Newest run available at a UTC time: yesterday 12 h before noon, today 00 h after."""
    day = now_utc.cast("date")
    before_noon = F.timestamp_add("HOUR", F.lit(12), F.date_sub(day, 1).cast("timestamp_ntz"))
    return F.when(F.hour(now_utc) < 12, before_noon).otherwise(day.cast("timestamp_ntz"))


def month_start(date: Column) -> Column:
    return F.trunc(date, "month")


def from_year(date: Column, year: int) -> Column:
    """``year(date) >= year`` written as a range, which Parquet statistics can prune."""
    return date >= F.lit(dt.date(year, 1, 1))


def in_year(date: Column, year: int) -> Column:
    return (date >= F.lit(dt.date(year, 1, 1))) & (date < F.lit(dt.date(year + 1, 1, 1)))
