"""Joins and merges that stay balanced when one group holds a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1000


def attach_group(rows: DataFrame, groups: DataFrame, key: str, size: str, how: str = "inner") -> DataFrame:
    """Inner (or left) join of ``rows`` with one row per ``key`` in ``groups``, whose column ``size`` counts the rows of the key.

    Keys with more than a ``1/HOT_SHARE`` part of all rows are fewer than ``HOT_SHARE``, whatever the size
    of the input, and are broadcast; no other key can hold more than that part, so the rest is a plain
    shuffle join. Both sides should be written tables: each is read twice. In an inner join ``key`` is not null.
    """
    whole, mark = free_name(groups, "_total"), free_name(rows, "_hot")
    total = groups.agg(F.sum(size).alias(whole))
    hot = groups.join(F.broadcast(total), F.col(size) * HOT_SHARE > F.col(whole)).drop(whole).withColumn(mark, F.lit(True))
    marked = rows.join(F.broadcast(hot), key, "left")
    added = [c for c in groups.columns if c != key]
    common = marked.filter(F.col(mark)).select(*rows.columns, *added)
    rest = marked.filter(F.col(mark).isNull()).select(*rows.columns)
    return common.unionByName(rest.join(groups, key, how).select(*rows.columns, *added))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as it takes to differ from the columns of ``df``."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
