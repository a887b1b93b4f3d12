"""Stored forecast runs and daily states: folders, pruning, repeats after failures and merges."""

import datetime as dt
import glob
import os

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from gridzonal.operators.grid import daily_cell_stats
from gridzonal.storage import fresh_path, remove_below
from gridzonal.streaming import daily
from gridzonal.streaming.daily import cell_states, daily_stats, grow_daily_states, merge_states, stats_of_states, stored_states
from gridzonal.streaming.ingest import merge_runs, replace_runs, stored_runs, stream_parquet

RUNS = "variable string, run_time timestamp_ntz, n int"


def runs(spark, drop, count=20):
    rows = [(f"v{k % 2}", dt.datetime(2025, 7, 1 + k % 4, 12 * (k % 2)), drop * 1000 + k) for k in range(count)]
    return spark.createDataFrame(rows, RUNS)


@pytest.fixture
def table(spark):
    """Two files per drop, two drops; the second replaces two of the four days."""
    work = fresh_path(spark, "runs")
    runs(spark, 1).repartition(2, "n").write.parquet(f"{work}/in/drop-1")
    runs(spark, 2).filter("day(run_time) < 3").repartition(2, "n").write.parquet(f"{work}/in/drop-2")
    stream = stream_parquet(spark, f"{work}/in", runs(spark, 1).schema, max_files=1)
    replace_runs(stream, f"{work}/t", f"{work}/c", part=None, delivered="drop").awaitTermination()
    return f"{work}/t"


def wanted(spark):
    return sorted([r.n for r in runs(spark, 1).filter("day(run_time) >= 3").collect()] + [r.n for r in runs(spark, 2).filter("day(run_time) < 3").collect()])


def test_a_folder_for_every_run_and_only_newest_rows(spark, table):
    assert len(glob.glob(f"{table}/*/")) == len({r.run_time for r in runs(spark, 1).collect()}) == 4
    found = stored_runs(spark, table, part=None, delivered="drop")
    assert sorted(r.n for r in found.collect()) == wanted(spark)
    assert dict(found.dtypes)["run_time"] == "timestamp_ntz" and "batch" not in found.columns


def test_partitions_are_pruned_without_exchanging_rows(spark, table):
    chosen = F.col("run_time") >= F.lit("2025-07-04").cast("timestamp_ntz")
    found = stored_runs(spark, table, part=None, delivered="drop", runs=chosen)
    plan = plan_of(found)
    assert "dynamicpruning" in plan and "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan
    # Below the join, the side of the rows is a scan alone.
    rows_side = plan[plan.index("dynamicpruning") - 2000 : plan.index("dynamicpruning")].rsplit("BroadcastHashJoin", 1)[-1]
    assert "Exchange" not in rows_side
    found.collect()
    scans = [line for line in found._jdf.queryExecution().executedPlan().toString().split("\n") if "PartitionFilters" in line]
    assert scans and found.select("run_time").distinct().count() == 1


def test_rows_of_a_failed_attempt_are_not_read(spark, table):
    path = glob.glob(f"{table}/*/*.parquet")[0]
    one = spark.read.parquet(path).withColumn("batch", F.lit("stream-000000-lost"))
    one.write.mode("append").parquet(os.path.dirname(path))
    assert sorted(r.n for r in stored_runs(spark, table, part=None, delivered="drop").collect()) == wanted(spark)


def test_merging_keeps_the_newest_in_few_files(spark, table):
    before = len(glob.glob(f"{table}/*/*.parquet"))
    some = [dt.datetime(2025, 7, 1), dt.datetime(2025, 7, 2, 12)]
    merge_runs(spark, table, some, part=None, delivered="drop")
    assert len(glob.glob(f"{table}/*/*.parquet")) < before
    assert sorted(r.n for r in stored_runs(spark, table, part=None, delivered="drop").collect()) == wanted(spark)
    merge_runs(spark, table, some, part=None, delivered="drop")
    assert sorted(r.n for r in stored_runs(spark, table, part=None, delivered="drop").collect()) == wanted(spark)
    assert spark.read.parquet(table).count() == 20


def test_many_notes_are_not_broadcast(spark, table, monkeypatch):
    monkeypatch.setattr("gridzonal.streaming.ingest.BROADCAST_ROWS", 1)
    assert sorted(r.n for r in stored_runs(spark, table, part=None, delivered="drop").collect()) == wanted(spark)


OBS = "variable string, date date, valid_time timestamp_ntz, iy int, ix int, value double"


def steps(seed, count=300):
    day = lambda k: None if k % 31 == 0 else dt.date(2024, 1, 1 + k % 5)
    value = lambda k: None if k % 11 == 0 else (k * 37 % 101) / 4
    return [("pm", day(seed + k), dt.datetime(2024, 1, 1, (seed + k) % 24), (seed + k) % 3, (seed + k) % 4, value(seed + k)) for k in range(count)]


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("strict", [False, True])
def test_states_merge_to_the_daily_statistics(spark, strict):
    parts = [spark.createDataFrame(steps(seed), OBS) for seed in (0, 7, 1000)]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    states = cell_states(parts[0]).unionByName(cell_states(parts[1])).unionByName(cell_states(parts[2]))
    assert as_set(stats_of_states(merge_states(states), strict=strict)) == as_set(daily_cell_stats(whole, strict=strict))
    with pytest.raises(ValueError, match="median"):
        stats_of_states(states, ["median"])


def test_states_grow_and_survive_repeats(spark):
    work = fresh_path(spark, "daily")
    schema = spark.createDataFrame([], OBS).schema
    whole = []

    def ingest(drop, rows):
        spark.createDataFrame(rows, OBS).repartition(1).write.parquet(f"{work}/in/drop-{drop}")
        whole.extend(rows)
        stream = stream_parquet(spark, f"{work}/in", schema, max_files=1)
        grow_daily_states(stream, f"{work}/s", f"{work}/c").awaitTermination()
        assert as_set(daily_stats(spark, f"{work}/s")) == as_set(daily_cell_stats(spark.createDataFrame(whole, OBS)))

    ingest(1, steps(0))
    ingest(2, [row for row in steps(500) if row[1] == dt.date(2024, 1, 2)])
    # Only the touched day has a new version.
    assert len(glob.glob(f"{work}/s/day=2024-01-02/*/")) == 2 and len(glob.glob(f"{work}/s/day=2024-01-03/*/")) == 1
    # A batch that failed after writing, before it was known to have finished, is repeated from the same versions.
    for name in ("commits/1", "commits/.1.crc"):
        if os.path.exists(f"{work}/c/{name}"):
            os.remove(f"{work}/c/{name}")
    stream = stream_parquet(spark, f"{work}/in", schema, max_files=1)
    grow_daily_states(stream, f"{work}/s", f"{work}/c").awaitTermination()
    assert as_set(daily_stats(spark, f"{work}/s")) == as_set(daily_cell_stats(spark.createDataFrame(whole, OBS)))
    ingest(3, [row for row in steps(900) if row[1] in (dt.date(2024, 1, 2), None)])
    plan = plan_of(stored_states(spark, f"{work}/s"))
    assert "dynamicpruning" in plan


def test_parts_of_tables_only_are_deleted(spark):
    for part in ("", "/", "../x", "a/../../b", "/etc"):
        with pytest.raises(ValueError):
            remove_below(spark, fresh_path(spark, "x"), part)
    assert daily.VERSIONS.startswith("-")
