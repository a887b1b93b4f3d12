"""Zone series in long form (zone, date, statistic, value): filter, stack, summarise, widen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridzonal.functions.names import code6
from gridzonal.functions.times import from_year, in_year, month_start

STATS = ("mean", "max", "min")


def label(table: DataFrame, name: str) -> DataFrame:
    return table.withColumn("name", F.lit(name))


def stack_stats(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Stack same-shaped tables, each labelled with its key in column ``name``."""
    stacked = None
    for name, table in tables.items():
        labelled = label(table, name)
        stacked = (
            labelled if stacked is None else stacked.unionByName(labelled, allowMissingColumns=True)
        )
    if stacked is None:
        raise ValueError("nothing to stack")
    return stacked


def melt_stats(wide: DataFrame, ids: Sequence[str], stats: Sequence[str] = STATS) -> DataFrame:
    """Wide statistics to long in one pass over ``wide``: columns ``stat`` and ``value``."""
    return wide.unpivot([F.col(c) for c in ids], [F.col(s) for s in stats], "stat", "value")


def zone_series(table: DataFrame, code: int, year: int | None = None) -> DataFrame:
    """One zone's rows in date order, optionally of one year."""
    chosen = table.filter(F.col("code_muni") == code)
    if year is not None:
        chosen = chosen.filter(in_year(F.col("date"), year))
    return chosen.orderBy("date")


def zone_monthly(table: DataFrame, code: int, year: int) -> DataFrame:
    """Monthly mean of one zone's daily values in one year, in order."""
    return (
        table.filter((F.col("code_muni") == code) & in_year(F.col("date"), year))
        .groupBy(month_start(F.col("date")).alias("date"))
        .agg(F.avg("value").alias("value"))
        .orderBy("date")
    )


def monthly_mean(stacked: DataFrame) -> DataFrame:
    return stacked.groupBy("code_muni", month_start(F.col("date")).alias("date"), "name").agg(
        F.avg("value").alias("value")
    )


def pivot_stats(stacked: DataFrame, ids: Sequence[str], names: Sequence[str] = STATS) -> DataFrame:
    """Long to wide: one column per name, NULL where a group lacks it.

    Conditional aggregation keeps it to one shuffle and one hash aggregate. A repeated (ids, name)
    has no single value to show, so it stops the job.
    """

    def only(name: str):
        hit = F.col("name") == name
        clash = F.raise_error(F.lit(f"more than one {name!r} value for the same {list(ids)}"))
        return (
            F.when(F.count_if(hit) > 1, clash.cast("double"))
            .otherwise(F.max(F.when(hit, F.col("value"))))
            .alias(name)
        )

    return stacked.groupBy(*ids).agg(*[only(name) for name in names])


def export_monthly(stacked: DataFrame, value_name: str = "pm25") -> DataFrame:
    """Monthly export (cod6, ano_mes, <value_name>) from stacked daily statistics.

    Monthly mean, pivot and dropping of the min and max columns are fused into one aggregation.
    Zone-months that have only min or max rows stay, with the value NULL.
    """
    return (
        stacked.groupBy("code_muni", month_start(F.col("date")).alias("date"))
        .agg(F.avg(F.when(F.col("name") == "mean", F.col("value"))).alias("mean"))
        .withColumn("code_muni", code6(F.col("code_muni")))
        .withColumnsRenamed({"code_muni": "cod6", "date": "ano_mes", "mean": value_name})
    )


def export_daily(stacked: DataFrame, first_year: int = 2024) -> DataFrame:
    """Daily export (cod6, ano_mes, min, med, max)."""
    recent = stacked.filter(from_year(F.col("date"), first_year))
    return (
        pivot_stats(recent, ["code_muni", "date"])
        .withColumn("code_muni", code6(F.col("code_muni")))
        .withColumnsRenamed({"code_muni": "cod6", "date": "ano_mes", "mean": "med"})
        .select("cod6", "ano_mes", "min", "med", "max")
    )


def row_count(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("n"))


def head_rows(table: DataFrame, order: Sequence[str], n: int = 6) -> DataFrame:
    """The first rows in a stated order; a top-n, so no full sort."""
    return table.orderBy(*order).limit(n)
