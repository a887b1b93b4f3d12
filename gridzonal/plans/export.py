"""Reports from the stored zone-day table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridzonal.functions.times import from_year
from gridzonal.operators import series


def stacked_series(table: DataFrame, variable: str, first_year: int) -> DataFrame:
    """One variable's rows since a year, with the statistic as ``name``.

    Both conditions are plain comparisons: over a table partitioned by variable they become a
    partition filter and a pushed date range.
    """
    chosen = table.filter((F.col("variable") == variable) & from_year(F.col("date"), first_year))
    return chosen.select("code_muni", "date", F.col("stat").alias("name"), "value")


def monthly_report(table: DataFrame, variable: str = "pm25", first_year: int = 2018) -> DataFrame:
    """(cod6, ano_mes, <variable>): monthly mean of the daily means."""
    return series.export_monthly(stacked_series(table, variable, first_year), variable)


def daily_report(table: DataFrame, variable: str = "pm25", first_year: int = 2024) -> DataFrame:
    """(cod6, ano_mes, min, med, max) per day."""
    return series.export_daily(stacked_series(table, variable, first_year), first_year)
