"""Planned work as tables: which (variable, day, step) or (run, lead) should exist."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridzonal.functions.names import grid_file_name
from gridzonal.functions.times import valid_time
from gridzonal.schema import DAY_STEPS, LAST_LEAD_HOUR, REQUEST_NAMES, SPECIAL_STEPS


def day_manifest(variables: DataFrame, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """Every day from start to end for every row of ``variables``, with the file to expect.

    Days may be texts (``2003-01-01``); one that is no date stops the job.
    """
    first, last = (F.to_date(F.lit(day), "yyyy-MM-dd") if isinstance(day, str) else F.lit(day) for day in (start, end))
    days = F.sequence(first, last, F.expr("interval 1 day"))
    return variables.select("variable", F.explode(days).alias("date")).withColumn(
        "target", grid_file_name(F.col("variable"), F.col("date"))
    )


def request_manifest(
    variables: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    steps: Sequence[str] = DAY_STEPS,
    special: Mapping[str, Sequence[str]] = SPECIAL_STEPS,
) -> DataFrame:
    """``day_manifest`` times the steps of a day; ``special`` lists variables with steps of their own."""

    def times(values: Sequence[str]):
        return F.array(*[F.lit(value) for value in values])

    chosen = times(steps)
    for name, own in special.items():
        chosen = F.when(F.col("variable") == name, times(own)).otherwise(chosen)
    return day_manifest(variables, start, end).withColumn("step", F.explode(chosen))


def describe_requests(
    work: DataFrame,
    area: tuple[float, float, float, float] | None = None,
    names: Mapping[str, str] = REQUEST_NAMES,
) -> DataFrame:
    """Manifest rows with the provider's variable name and the area asked for.

    A variable without a known name is passed on under its own.
    """
    requested = F.col("variable")
    for short, full in names.items():
        requested = F.when(F.col("variable") == short, F.lit(full)).otherwise(requested)
    described = work.withColumn("request_name", requested)
    if area is not None:
        for edge, degrees in zip(("north", "west", "south", "east"), area):
            described = described.withColumn(edge, F.lit(float(degrees)))
    return described


def lead_manifest(runs: DataFrame, last: int = LAST_LEAD_HOUR) -> DataFrame:
    """Every lead hour from 0 to ``last`` for every row of ``runs`` (column ``run_time``)."""
    return runs.withColumn("lead_hour", F.explode(F.sequence(F.lit(0), F.lit(last)))).withColumn(
        "valid_time", valid_time(F.col("run_time"), F.col("lead_hour"))
    )


def missing(manifest: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Manifest rows with nothing behind them yet.

    ``existing`` may be the observations themselves: an anti-join ignores repeats, and reducing to
    distinct keys first means a key that holds many rows is shuffled once.
    """
    return manifest.join(existing.select(*keys).distinct(), list(keys), "left_anti")


def newest_first(work: DataFrame, *then: str) -> DataFrame:
    return work.orderBy(F.col("date").desc(), *then)
