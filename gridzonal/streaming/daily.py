"""Daily statistics of cells that grow with the steps that arrive, without reducing earlier ones again.

A cell-day is kept as a state that merges: sum, number of values, smallest, largest and number of steps. A micro-batch reduces
its own rows, merges them with the states of the days it touches and writes those days as a new version. Which version of a day is the current
one is noted in a small table beside the states, by batch: a batch that is repeated after a failure starts from the versions that
earlier batches noted, so no step counts twice. Versions that no repeat can need are deleted.

Rows without a day are a day of their own; a step that is delivered twice in different batches counts twice, as it does for
``daily_cell_stats`` over both; states hold no other column.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from gridzonal import sinks
from gridzonal.storage import remove_below

KEYS = ("variable", "date", "iy", "ix")
VERSIONS = "-versions"

# How each part of a state merges.
MERGED = {"v_sum": F.sum, "n_values": F.sum, "v_min": F.min, "v_max": F.max, "n_steps": F.sum}


def cell_states(obs: DataFrame) -> DataFrame:
    """(variable, date, iy, ix, v_sum, n_values, v_min, v_max, n_steps) of observations; one shuffle after partial aggregation."""
    value = F.col("value").cast("double")
    return obs.groupBy(*KEYS).agg(
        F.sum(value).alias("v_sum"),
        F.count(value).alias("n_values"),
        F.min(value).alias("v_min"),
        F.max(value).alias("v_max"),
        F.count(F.lit(1)).alias("n_steps"),
    )


def merge_states(states: DataFrame) -> DataFrame:
    """One state per cell-day from several."""
    return states.groupBy(*KEYS).agg(*[merge(name).alias(name) for name, merge in MERGED.items()])


def stats_of_states(states: DataFrame, stats: Sequence[str] = ("mean", "max", "min"), strict: bool = False) -> DataFrame:
    """The columns of ``daily_cell_stats``: ``v_<stat>`` and ``n_steps``; ``strict`` gives NULL for a day with a missing step."""
    known = {"mean": F.try_divide("v_sum", "n_values"), "max": F.col("v_max"), "min": F.col("v_min"), "sum": F.col("v_sum")}
    unknown = set(stats) - set(known)
    if unknown:
        raise ValueError(f"states don't hold {sorted(unknown)}; choose from {sorted(known)}")
    whole = F.col("n_values") == F.col("n_steps")
    columns = [(F.when(whole, known[stat]) if strict else known[stat]).alias(f"v_{stat}") for stat in stats]
    return states.select(*KEYS, *columns, F.col("n_steps").cast("int").alias("n_steps"))


def _day() -> Column:
    return F.coalesce(F.col("date").cast("string"), F.lit("none"))


def _current(spark: SparkSession, table: str, before: int | None = None) -> DataFrame:
    """(day, version, number) of the newest version of each day, of those noted by batches before ``before``."""
    noted = spark.read.schema("day string, version string, number bigint").parquet(f"{table}{VERSIONS}")
    if before is not None:
        noted = noted.filter(F.col("number") < before)
    return noted.groupBy("day").agg(F.max_by("version", "number").alias("version"), F.max("number").alias("number"))


def _states_of(spark: SparkSession, table: str, versions: DataFrame) -> DataFrame:
    """The states of some versions; there is a row per day in ``versions``, and only their partitions are read."""
    schema = f"{', '.join(f'{k} {t}' for k, t in _STATE_TYPES.items())}, day string, version string"
    stored = spark.read.schema(schema).parquet(table)
    # True of every row; a comparison is what lets Spark prune partitions by the broadcast.
    chosen = versions.filter(F.col("number") >= 0).select("day", "version")
    return stored.join(F.broadcast(chosen), ["day", "version"], "left_semi").select(*_STATE_TYPES)


# Types of the stored states.
_STATE_TYPES = {
    "variable": "string", "date": "date", "iy": "int", "ix": "int", "v_sum": "double", "n_values": "bigint",
    "v_min": "double", "v_max": "double", "n_steps": "bigint",
}


def grow_daily_states(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Merge everything not seen yet into the states stored at ``table`` and stop.

    The work of a batch is its own rows and the states of the days they fall on; other days are not read.
    """
    spark = stream.sparkSession
    if not _exists(spark, f"{table}{VERSIONS}"):
        spark.createDataFrame([], "day string, version string, number bigint").write.parquet(f"{table}{VERSIONS}/number_of=none")

    def store(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        version = f"{batch_id:06d}-{uuid.uuid4().hex}"
        days = batch.select(_day().alias("day")).distinct()
        # One row for each day of the batch, however many rows it has.
        days = session.createDataFrame(days.collect(), "day string")
        earlier = _current(session, table, batch_id).join(F.broadcast(days), "day", "left_semi")
        states = cell_states(batch).select(*[F.col(c).cast(t) for c, t in _STATE_TYPES.items()])
        if _exists(session, table):
            states = merge_states(states.unionByName(_states_of(session, table, earlier)))
        named = states.withColumns({"day": _day(), "version": F.lit(version)})
        sinks.append(named, table, ["day", "version"], ["variable", "iy", "ix"], batches=False)
        noted = days.withColumns({"version": F.lit(version), "number": F.lit(batch_id).cast("long")})
        sinks.replace_partitions(noted.withColumn("number_of", F.lit(f"{batch_id:06d}")), f"{table}{VERSIONS}", ["number_of"])
        _forget(session, table, days, batch_id)

    return (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _forget(spark: SparkSession, table: str, days: DataFrame, batch_id: int) -> None:
    """Delete the versions of a batch's days that are neither current nor what a repeat of the batch would start from."""
    noted = spark.read.schema("day string, version string, number bigint").parquet(f"{table}{VERSIONS}")
    later = Window.partitionBy("day").orderBy(F.desc("number"))
    # The newest version before this batch, and this batch's own, stay.
    noted = noted.join(F.broadcast(days), "day", "left_semi")
    old = noted.filter(F.col("number") < batch_id).withColumn("_age", F.row_number().over(later)).filter("_age = 2")
    for row in old.collect():
        remove_below(spark, table, f"day={row['day']}/version={row['version']}")


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def stored_states(spark: SparkSession, table: str) -> DataFrame:
    """The current states of all days."""
    return _states_of(spark, table, _current(spark, table))


def daily_stats(
    spark: SparkSession, table: str, stats: Sequence[str] = ("mean", "max", "min"), strict: bool = False
) -> DataFrame:
    """What ``daily_cell_stats`` gives for all steps that have arrived."""
    return stats_of_states(stored_states(spark, table), stats, strict)
