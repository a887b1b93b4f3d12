"""Where intermediate tables go, and how they get there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, tempfile.TemporaryDirectory] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``.

    Only a local session, where there is one machine, may fall back to a temporary folder, which is
    gone when Python exits.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.TemporaryDirectory(
            prefix="gridzonal-", ignore_cleanup_errors=True
        )
    return _LOCAL_ROOTS[context.applicationId].name


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``fresh_path`` named; other paths are refused."""
    if not path.startswith(f"{shared_dir(spark)}/"):
        raise ValueError(f"{path} is not below the shared folder")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def remove_below(spark: SparkSession, table: str, part: str) -> None:
    """Delete a part of a table that the library wrote; ``part`` is relative and can't lead out of the table."""
    if part.startswith("/") or ".." in part.split("/") or not part.strip("/"):
        raise ValueError(f"{part!r} is not a part of a table")
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{table.rstrip('/')}/{part}")
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


# Names of file systems in Spark paths and in those of the library that writes single files.
ARROW_SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "gs": "gs", "abfss": "abfss"}


def arrow_uri(spark: SparkSession, path: str) -> str:
    """The full URI of a path, with the file system that Spark would take for it.

    A path without scheme is on Spark's default file system, not on the disk of whichever machine opens it.
    """
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = found.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(found).toString()
    scheme, _colon, rest = full.partition(":")
    if scheme not in ARROW_SCHEMES:
        raise ValueError(f"cannot write single files to {scheme!r} ({path})")
    rest = "//" + rest if scheme == "file" and not rest.startswith("//") else rest
    return f"{ARROW_SCHEMES[scheme]}:{rest}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage of ``df`` by writing it as Parquet and reading it back.

    Unlike cached blocks, the written table survives the loss of executors, and its file
    sizes and row counts are known to the planner.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
