"""Run registered queries next to their SQL oracles and compare values exactly."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _normal(frame: pd.DataFrame, dates: set[str]) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for column in frame.columns:
        if column in dates:
            frame[column] = pd.to_datetime(frame[column]).dt.strftime("%Y-%m-%d")
        elif str(frame[column].dtype).startswith("datetime"):
            frame[column] = frame[column].dt.strftime("%Y-%m-%d %H:%M:%S.%f")
    return frame.sort_values(list(frame.columns), na_position="first").reset_index(drop=True)


# Engine type names that stand for the same type.
SAME_TYPE = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    relation = con.sql(sql)
    theirs_types = {c: SAME_TYPE.get(str(t), str(t)) for c, t in zip(relation.columns, relation.types)}
    ours_types = {field.name: field.dataType.simpleString() for field in df.schema}
    problems = []
    if ours_types != theirs_types:
        problems.append(f"schema {ours_types} != {theirs_types}")
    dates = {name for name, kind in ours_types.items() if kind == "date"}
    ours, theirs = _normal(df.toPandas(), dates), _normal(relation.df(), dates)
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} != {len(theirs)}")
    elif not problems and not ours.equals(theirs.astype(ours.dtypes.to_dict())):
        changed = ours.compare(theirs.astype(ours.dtypes.to_dict()))
        problems.append(f"{len(changed)} of {len(ours)} rows differ:\n{changed.head()}")
    return problems
