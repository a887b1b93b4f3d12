"""Joins whose small side is broadcast only when its size is known."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# About 64 bytes per row in a hashed relation, so at most some 64 MB on each executor.
BROADCAST_ROWS = 1_000_000


def join_checked(
    big: DataFrame, small: DataFrame, keys: list[str], small_rows: int | None, how: str = "inner"
) -> DataFrame:
    """Join on ``keys`` with the small side broadcast if it is proved to be small.

    ``small_rows`` is an upper bound that the caller has proved. Beyond ``BROADCAST_ROWS``, or with no bound
    (``None``), it is a shuffle join: adaptive execution measures its partitions as they arrive and splits those that a hot
    key has filled, by their size, over as many tasks as it takes.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"join type {how!r} would repeat rows of the small side")
    if small_rows is not None and small_rows <= BROADCAST_ROWS:
        return big.join(F.broadcast(small), keys, how)
    return big.join(small, keys, how)


def frame_of(
    left: DataFrame, right: DataFrame, spread_by: list[str], buckets: int | None = None
) -> DataFrame:
    """Every row of ``left`` with every row of ``right``, for results that *are* that product.

    ``right`` is spread over buckets by the hash of ``spread_by`` and ``left`` is repeated once
    per bucket, which makes it an equi-join with evenly filled keys. There are as many buckets as
    shuffle partitions unless stated.
    """
    if buckets is None:
        buckets = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = right.withColumn("_bucket", F.pmod(F.xxhash64(*spread_by), F.lit(buckets)).cast("int"))
    repeated = left.withColumn("_bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return repeated.join(spread, "_bucket").drop("_bucket")
