"""Count tables: many partitions of few rows, written by the tasks and read by few."""

from __future__ import annotations

import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from barloom.operators.conform import RunContext
from barloom.sources import store
from barloom.sources.tables import TABLES

CTX = RunContext("research", "backtest", "s", "r1")
TABLE = "principles_context"
PARTITIONS = TABLES[TABLE].partitions
ODD = [" a b, c", "1/2:3=4", "50%", "∅", "x{y}[z]^\"'#?*\\", "tab\tend", "", None, "7"]


def counts(spark, days, principles=("p",), n=1):
    rows = [("ict", p, None, "all", str(i), date(2025, 1, 1) + timedelta(days=d), n) for p in principles for d in days for i in range(2)]
    return spark.createDataFrame(rows, "paradigm_id string, principle_id string, candidate_id string, cluster_id string, instrument string, dt date, trade_count int")


def folders(root):
    return {os.path.relpath(at, root) for at, _, files in os.walk(root) if any(f.endswith(".parquet") for f in files)}


def tasks_of(spark, group, run):
    """What run returns, and the tasks of its jobs."""
    context = spark.sparkContext
    context.setJobGroup(group, group)
    try:
        out = run()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    return out, [s.numTasks for s in stages if s]


def test_many_partitions_take_few_files_and_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        store.write_table(counts(spark, range(200)), TABLE, str(tmp_path), CTX)
        assert len(folders(tmp_path)) == 200
        for at in folders(tmp_path):  # no checksum file, for which a local disk takes a process
            assert len(os.listdir(tmp_path / at)) == 1
        most = 4 * spark.sparkContext.defaultParallelism
        back, listed = tasks_of(spark, "open counts", lambda: store.read_table(spark, str(tmp_path), TABLE, run_id="r1"))
        assert max(listed) <= most and sum(listed) <= most + 2
        n, read = tasks_of(spark, "read counts", back.count)
        assert n == 400 and max(read) <= most
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_only_written_partitions_are_replaced(spark, tmp_path):
    store.write_table(counts(spark, range(6), ("p", "q")), TABLE, str(tmp_path), CTX)
    store.write_table(counts(spark, range(3, 9), ("q", "r"), n=5), TABLE, str(tmp_path), CTX)
    back = store.read_table(spark, str(tmp_path), TABLE)
    found = {(r.principle_id, (r.dt - date(2025, 1, 1)).days, r.trade_count): r["count"] for r in back.groupBy("principle_id", "dt", "trade_count").count().collect()}
    kept = {("p", d, 1): 2 for d in range(6)} | {("q", d, 1): 2 for d in range(3)}
    assert found == kept | {(p, d, 5): 2 for p in "qr" for d in range(3, 9)}
    assert dict(back.dtypes)["dt"] == "date" and dict(back.dtypes)["trade_count"] == "bigint"
    one = store.read_table(spark, str(tmp_path), TABLE, principle_id="q", dt=[date(2025, 1, 4), date(2025, 1, 5)])
    assert one.count() == 4 and "PartitionFilters: [" in one._jdf.queryExecution().toString()


def test_folders_are_named_as_spark_names_them(spark, tmp_path):
    rows = counts(spark, [0], ODD).withColumn("dt", F.when(F.col("instrument") == "0", F.col("dt")))
    store.write_table(rows, TABLE, str(tmp_path / "ours"), CTX)
    store.prepare_rows(rows, TABLE, CTX).write.partitionBy(*PARTITIONS).parquet(str(tmp_path / "theirs" / TABLE))
    assert folders(tmp_path / "ours") == folders(tmp_path / "theirs")
    read = lambda root: store.read_table(spark, str(tmp_path / root), TABLE).select("principle_id", "dt", "instrument", "trade_count")
    ours, theirs = read("ours"), read("theirs")
    assert ours.count() == 2 * len(ODD)
    assert ours.exceptAll(theirs).count() == 0 and theirs.exceptAll(ours).count() == 0


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    store.write_table(counts(spark, range(4)), TABLE, str(tmp_path), CTX)
    bad = counts(spark, range(4), n=2).withColumn("trade_count", F.when(F.col("instrument") == "1", F.raise_error("no")).otherwise(F.col("trade_count")))
    with pytest.raises(Exception, match="no"):
        store.write_table(bad, TABLE, str(tmp_path), CTX)
    assert {r[0] for r in store.read_table(spark, str(tmp_path), TABLE).select("trade_count").collect()} == {1}
    assert not [n for n in os.listdir(tmp_path / TABLE) if n.startswith(".staged")]


def test_no_rows(spark, tmp_path):
    store.write_table(counts(spark, range(2)), TABLE, str(tmp_path), CTX)
    store.write_table(counts(spark, range(2)).where("false"), TABLE, str(tmp_path), CTX, covers=[{"dt": "2025-01-01"}])
    assert {r[0] for r in store.read_table(spark, str(tmp_path), TABLE).select("dt").distinct().collect()} == {date(2025, 1, 2)}
