"""Process each landed file once, and keep the newest forecast run current."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

from gridzonal import sinks
from gridzonal.functions.names import base_name
from gridzonal.operators.joins import BROADCAST_ROWS, join_checked
from gridzonal.schema import GridSpec
from gridzonal.sources.grid_files import decode_files, to_observations
from gridzonal.storage import materialise

# The schema of Spark's binaryFile source, which a stream must be given.
BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def stream_grid_files(
    spark: SparkSession,
    folder: str,
    spec: GridSpec,
    pattern: str = r"\.nc$",
    variable: Column | None = None,
    run_time: Column | None = None,
    area: tuple[float, float, float, float] | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """New grid files of a folder as a stream of observations, with their ``source_file`` and when it was ``delivered``."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    files = reader.load(folder).filter(base_name(F.col("path")).rlike(pattern))
    cells = decode_files(files, area, variable, run_time, source_file=True, spec=spec)
    return to_observations(cells, spec, source_file=True)


def stream_parquet(
    spark: SparkSession, folder: str, schema: StructType, max_files: int | None = None
) -> DataFrame:
    """New Parquet files below a folder, with ``source_file``, ``drop`` (the folder it lies in) and ``delivered``."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    path = F.col("_metadata.file_path")
    return reader.parquet(folder).select(
        "*",
        F.col("_metadata.file_name").alias("source_file"),
        F.regexp_extract(path, r"([^/]+)/[^/]+$", 1).alias("drop"),
        F.unix_micros("_metadata.file_modification_time").alias("delivered"),
    )


# Names the write that a row came with; the last partition column of tables that grow by batches.
BATCH = sinks.BATCH


def append_new(
    stream: DataFrame, table: str, checkpoint: str, partition_by: Sequence[str] = ("variable", "date")
) -> StreamingQuery:
    """Append everything not seen yet and stop.

    The checkpoint remembers which files were read. Each micro-batch has partitions of its own (column ``BATCH``)
    and overwrites them if it is repeated after a failure, so re-runs and restarts neither repeat nor lose rows, and
    rows that ``sinks.append`` adds to the same table are seen as well.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        named = batch.withColumn(BATCH, F.lit(f"stream-{batch_id:06d}"))
        sinks.replace_partitions(named, table, [*partition_by, BATCH])

    return (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


# Where ``replace_runs`` notes which deliveries a batch brought: a small table beside that of the rows.
DELIVERIES = "-deliveries"


def replace_runs(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    keys: Sequence[str] = ("variable", "run_time"),
    part: str | None = "source_file",
    delivered: str = "delivered",
    partition_by: str = "run_time",
) -> StreamingQuery:
    """Store forecast runs of which deliveries may come again; ``stored_runs`` reads the newest ones.

    ``keys`` name a run, ``part`` the piece of it that a delivery replaces (None: the whole run) and ``delivered`` orders
    deliveries. Rows are partitioned by ``partition_by`` alone, one of ``keys``; variable, file, delivery and batch are columns, and a batch adds
    one file or few to each run it has rows of. Which (run, part, delivery) a batch brought is noted in a small table beside
    the rows, after them: what is not noted is not read. So nothing depends on which files share a micro-batch: two versions that
    land before one trigger, a run in several files and any ``max_files`` give the same table, and a batch that is repeated
    after a failure is noted under the name of its last attempt only.
    """
    pieces = [*keys, *([part] if part else []), delivered]

    def store(batch: DataFrame, batch_id: int) -> None:
        # An attempt has a name of its own, so rows of one that failed are never read.
        named = batch.withColumn(BATCH, F.lit(f"stream-{batch_id:06d}-{uuid.uuid4().hex}"))
        sinks.append(named, table, [partition_by], [c for c in pieces if c != partition_by], batches=False)
        noted = named.groupBy(*pieces, BATCH).agg(F.count(F.lit(1)).alias("rows"))
        sinks.replace_partitions(noted.withColumn("note", F.lit(f"stream-{batch_id:06d}")), f"{table}{DELIVERIES}", ["note"])

    return (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def newest_deliveries(
    spark: SparkSession,
    table: str,
    keys: Sequence[str] = ("variable", "run_time"),
    part: str | None = "source_file",
    delivered: str = "delivered",
) -> DataFrame:
    """(keys, part, delivered, batch): the newest delivery of every (run, part), and the batch that brought it last.

    Read from the notes beside the rows, a row per delivery and batch.
    """
    noted = spark.read.parquet(f"{table}{DELIVERIES}")
    pieces = [*keys, *([part] if part else [])]
    # A delivery that several batches brought in parts has several batches.
    top = F.max(delivered).over(Window.partitionBy(*pieces))
    return noted.withColumn("_top", top).filter(F.col(delivered) == F.col("_top")).select(*pieces, delivered, BATCH)


def stored_runs(
    spark: SparkSession,
    table: str,
    keys: Sequence[str] = ("variable", "run_time"),
    part: str | None = "source_file",
    delivered: str = "delivered",
    schema: StructType | None = None,
    runs: Column | None = None,
    partition_by: str = "run_time",
) -> DataFrame:
    """The newest delivery of every (run, part) that ``replace_runs`` has stored; ``runs`` is a condition on keys that chooses some.

    The notes are counted. If they are few they are broadcast: the rows are not exchanged, and the partitions of the chosen
    runs alone are read, which Spark finds out when the notes are there (dynamic partition pruning).
    """
    newest = newest_deliveries(spark, table, keys, part, delivered)
    if runs is not None:
        newest = newest.filter(runs)
    if schema is None:
        # The notes know the type of the column that is a folder's name in the table.
        kind = newest.schema[partition_by].dataType
        fields = spark.read.parquet(table).schema.fields
        schema = StructType([StructField(f.name, kind if f.name == partition_by else f.dataType) for f in fields])
    elif BATCH not in schema.names:
        schema = StructType([*schema.fields, StructField(BATCH, StringType())])
    stored = spark.read.schema(schema).parquet(table)
    pieces = [*keys, *([part] if part else []), delivered, BATCH]
    few, last = newest.agg(F.count(F.lit(1)), F.max(partition_by)).first()
    if few > BROADCAST_ROWS:
        return join_checked(stored, newest, pieces, None, how="left_semi").drop(BATCH)
    # True of every row; a comparison is what lets Spark prune partitions by the broadcast.
    chosen = newest.filter(F.col(partition_by) <= F.lit(last))
    return stored.join(F.broadcast(chosen), pieces, "left_semi").drop(BATCH)


def merge_runs(
    spark: SparkSession,
    table: str,
    runs: Sequence,
    keys: Sequence[str] = ("variable", "run_time"),
    part: str | None = "source_file",
    delivered: str = "delivered",
    partition_by: str = "run_time",
) -> None:
    """Rewrite the partitions ``runs`` with their newest deliveries alone, in few files; no stream may be storing these runs.

    The merged rows are written in full elsewhere and noted, then swapped in for each partition. The notes of batches merged away
    stay and name nothing any more; rows of failed attempts go.
    """
    pieces = [*keys, *([part] if part else []), delivered]
    attempt = f"merged-{uuid.uuid4().hex}"
    chosen = F.col(partition_by).isin(*runs)
    kept = materialise(stored_runs(spark, table, keys, part, delivered, runs=chosen, partition_by=partition_by), "merged-runs")
    merged = kept.withColumn(BATCH, F.lit(attempt))
    noted = merged.groupBy(*pieces, BATCH).agg(F.count(F.lit(1)).alias("rows"))
    # Noted first: until the rows are there, readers find those of the old batches, which are noted as well.
    sinks.replace_partitions(noted.withColumn("note", F.lit(attempt)), f"{table}{DELIVERIES}", ["note"])
    sinks.replace_partitions(merged, table, [partition_by], [c for c in pieces if c != partition_by])
