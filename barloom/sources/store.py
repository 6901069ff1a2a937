"""One writer and one reader for every stored table."""

from __future__ import annotations

import os
import re
import shutil
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import date
from functools import partial, reduce
from itertools import groupby

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import column_or
from ..functions.timegrid import require_grid, snap_by
from ..operators.bars import keep_first, keep_last
from ..operators.conform import (
    RunContext,
    enforce_schema,
    normalise_evaluation,
    on_day,
    require_columns,
    stamp_identity,
    struct_type,
)
from ..operators.windows import row_order
from .tables import TABLES

# Groups of evaluations that counts are opened by.
OPENED = 32


def table_path(root: str, table: str) -> str:
    """Decision stages share one dataset, told apart by the stage partition."""
    name = "decisions" if table.startswith("decisions_") else table
    return f"{root.rstrip('/')}/{name}"


def prepare_rows(df: DataFrame, table: str, ctx: RunContext | None = None, trading_day: date | None = None, **identity) -> DataFrame:
    """Rows as the sink stores them: identity, evaluation ids, keys, declared types."""
    spec = TABLES[table]
    if table.startswith("decisions_"):
        df = decision_rows(df, table.removeprefix("decisions_"))
    if ctx is not None:
        df = stamp_identity(df, ctx, trading_day, **identity)
    df = normalise_evaluation(df, table)
    require_columns(df, [*spec.keys, *spec.partitions], table)
    df = df.withColumns({k: F.col(k).cast("string") for k in spec.keys if not k.endswith("ts")})
    if table == "windows" and trading_day is not None:
        df = on_day(df, trading_day, "anchor_ts")
    if spec.dedupe:
        df = keep_first(df, list(spec.keys), row_order(df, spec.keys))
    return enforce_schema(df, spec.columns, allow_extra=True)


def decision_rows(df: DataFrame, stage: str) -> DataFrame:
    """Stage, decision time from the first time column there is, anchor on its grid."""
    times = [F.col(c).cast("timestamp_ntz") for c in ("entry_ts", "window_ts", "ts", "anchor_ts") if c in df.columns]
    out = df.withColumn("stage", F.lit(stage))
    if "decision_ts" not in df.columns and times:
        out = out.withColumn("decision_ts", F.coalesce(*times))
    if {"anchor_ts", "anchor_tf"} <= set(df.columns):
        out = out.withColumn("anchor_ts", snap_by(F.col("anchor_ts"), F.col("anchor_tf")))
    return out


def write_partitioned(df: DataFrame, path: str, partitions: Sequence[str], sort: Sequence[str] = (), counted: bool = False) -> None:
    """Action: replace the partitions that df holds.

    The rebalance hint brings a partition's rows together and lets adaptive
    execution split a hot one over several files. Counts have many partitions of few
    rows, whose files take longer than their bytes: they (counted) keep all tasks, which
    write to a store that is mounted as a folder themselves.
    """
    if counted and (folder := _mounted(df.sparkSession, path)):
        return _write_folders(df, path, folder, partitions, sort)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = df.repartition(tasks, *partitions) if counted else df.hint("rebalance", *partitions)
    if sort:
        out = out.sortWithinPartitions(*partitions, *sort)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def _mounted(spark: SparkSession, path: str) -> str | None:
    """The folder of a path that driver and executors reach as files (file:)."""
    fs, where = _hadoop(spark, path)
    return fs.makeQualified(where).toUri().getPath() if fs.getUri().getScheme() == "file" else None


def _write_folders(df: DataFrame, path: str, folder: str, partitions: Sequence[str], sort: Sequence[str]) -> None:
    """As Spark's own dynamic overwrite, for many partitions of few rows in a mounted store.

    There Hadoop starts a process for each file, each checksum file and each folder, and the
    driver starts one for each new day of an evaluation, one after the other. Here a task
    writes its partitions' files to a hidden folder of its attempt; when all have ended, the
    driver puts the partitions of the attempts that succeeded in place.
    """
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = {p: F.col(p).cast("string") for p in partitions}
    out = df.withColumns({p: F.when(t != "", t) for p, t in texts.items()}).repartition(tasks, *partitions)
    staged = f"{folder}/.staged-{uuid.uuid4().hex}"
    os.makedirs(staged)
    try:
        write = partial(folder_files, staged=staged, partitions=tuple(partitions))
        written = out.sortWithinPartitions(*partitions, *sort).mapInArrow(write, "attempt string, partition string").collect()
        for attempt, partition in written:
            target = f"{folder}/{partition}"
            if os.path.exists(target):
                shutil.rmtree(target)
            os.makedirs(os.path.dirname(target), exist_ok=True)
            os.rename(f"{staged}/{attempt}/{partition}", target)
        open(f"{folder}/_SUCCESS", "w").close()
    finally:
        shutil.rmtree(staged, ignore_errors=True)  # an attempt that lost may still write
    spark.catalog.refreshByPath(path)


def folder_files(batches: Iterable[pa.RecordBatch], staged: str, partitions: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """A file for each partition of sorted rows; yields (attempt, partition folder) of each."""
    attempt = str(TaskContext.get().taskAttemptId())
    name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4()}.snappy.parquet"
    written: list[str] = []
    at, file = None, None
    for batch in batches:
        values = zip(*(batch.column(p).to_pylist() for p in partitions), strict=True)
        rows, start = pa.Table.from_batches([batch]).drop_columns(list(partitions)), 0
        for key, same in groupby(values):
            n = sum(1 for _ in same)
            if key != at or file is None:
                if file is not None:
                    file.close()
                at = key
                written.append("/".join(f"{path_name(p)}={path_name(v)}" for p, v in zip(partitions, key, strict=True)))
                os.makedirs(f"{staged}/{attempt}/{written[-1]}")
                file = pq.ParquetWriter(f"{staged}/{attempt}/{written[-1]}/{name}", rows.schema, compression="snappy", store_schema=False, write_page_checksum=True)
            file.write_table(rows.slice(start, n))
            start += n
    if file is not None:
        file.close()
    yield pa.RecordBatch.from_pydict({"attempt": [attempt] * len(written), "partition": written}, pa.schema([("attempt", pa.string()), ("partition", pa.string())]))


def path_name(value: str | None) -> str:
    """A partition value as Spark names its folder."""
    return "__HIVE_DEFAULT_PARTITION__" if value is None else re.sub(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]", lambda m: f"%{ord(m[0]):02X}", value)


def write_table(
    df: DataFrame,
    table: str,
    root: str,
    ctx: RunContext | None = None,
    trading_day: date | None = None,
    check_grid: bool = False,
    covers: Sequence[Mapping[str, object]] = (),
    **identity,
) -> None:
    """Action: conform and store; partitions of other days and runs stay.

    Partitions that the rows hold are replaced when all files are written; those named
    by ``covers`` (partition column → value, leading columns are enough) that got no row
    this time are then taken away, so that a run without rows leaves none of an earlier one.
    """
    spec = TABLES[table]
    rows = prepare_rows(df, table, ctx, trading_day, **identity)
    if check_grid:
        require_grid(rows)
    sort = [k for k in spec.keys if k not in spec.partitions]
    path = table_path(root, table)
    spark = rows.sparkSession
    before = {p: _stamp(spark, p) for c in covers for p in _stored_partitions(spark, path, spec.partitions, c)}
    write_partitioned(rows, path, spec.partitions, sort, "trade_count" in spec.columns)
    for partition, stamp in before.items():
        if _stamp(spark, partition) == stamp:  # not replaced by this write
            _hadoop(spark, partition)[0].delete(_hadoop(spark, partition)[1], True)


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of a stored folder, whichever store it is in."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _found(spark: SparkSession, statuses) -> list[str]:
    """Paths of listed files and folders, got as one text: a call for each takes longer than the listing."""
    if not statuses:
        return []
    paths = spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(statuses)
    return spark._jvm.scala.runtime.ScalaRunTime.genericWrapArray(paths).mkString("\n").split("\n")


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder."""
    fs, where = _hadoop(spark, path)
    return [p.rpartition("/")[2] for p in _found(spark, fs.listStatus(where))]


def _stored_partitions(spark: SparkSession, path: str, partitions: Sequence[str], values: Mapping[str, object]) -> list[str]:
    """Partition folders below path that carry the given values."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    parts = [f"{p}={escape(str(values[p]))}" if p in values else f"{p}=*" for p in partitions]
    exact = re.sub(r"([\\*?{}\[\]^])", r"\\\1", path)
    fs, where = _hadoop(spark, f"{exact}/{'/'.join(parts)}")
    return _found(spark, fs.globStatus(where))


def _stamp(spark: SparkSession, partition: str) -> tuple[str, ...]:
    """Names of a partition's files; a rewritten partition has others."""
    fs, where = _hadoop(spark, partition)
    return tuple(sorted(s.getPath().getName() for s in fs.listStatus(where))) if fs.exists(where) else ()


def read_table(spark: SparkSession, root: str, table: str, **filters) -> DataFrame:
    """Stored rows; filters on partition columns prune directories.

    A filter value may be a single value or a list. Partition columns are text but
    for dt, as they were written, whatever their values look like. A table of many small
    partitions is listed once and read by tasks that follow its bytes, four a core at least.
    Counts are opened by groups of evaluations, as Spark takes the square of an opened
    folder's partitions to find their values.
    """
    path, spec = table_path(root, table), TABLES[table]
    above = spec.partitions[: spec.partitions.index("dt")] if "trade_count" in spec.columns else ()
    folders = _stored_partitions(spark, path, above, {}) if above else []
    groups = [folders[i::OPENED] for i in range(min(OPENED, len(folders)))] or [[path]]
    all_files = spark.conf.get("spark.sql.parquet.mergeSchema") == "true"
    first = None if all_files else _first_file(spark, path, spec.partitions)
    kinds = {f.name: f.dataType for f in spark.read.parquet(first or path).schema}
    kinds |= struct_types({p: "date" if p == "dt" else "string" for p in spec.partitions})
    tasks = 4 * spark.sparkContext.defaultParallelism
    declared = spark.read.option("basePath", path).schema(T.StructType([T.StructField(n, k) for n, k in kinds.items()]))
    with _listing_tasks(spark, tasks):
        df = reduce(DataFrame.union, [declared.parquet(*group) for group in groups])
    query = df._jdf.queryExecution()
    parts = int(query.optimizedPlan().stats().sizeInBytes()) // int(query.sparkSession().sessionState().conf().filesMaxPartitionBytes())
    if table.startswith("decisions_"):
        filters.setdefault("stage", table.removeprefix("decisions_"))
    return _filtered(df.coalesce(max(tasks, 2 * parts)), filters)


def _first_file(spark: SparkSession, path: str, partitions: Sequence[str]) -> str | None:
    """The file below path whose columns Spark takes for the table's: the first by its whole path, without hidden ones."""
    fs, where = _hadoop(spark, path)
    if not fs.exists(where):
        return None
    if not partitions:
        return min((f"{path}/{n}" for n in _names(spark, path) if n[0] not in "._"), default=None)
    folders = (n for n in _names(spark, path) if n.startswith(f"{partitions[0]}="))
    below = (_first_file(spark, f"{path}/{n}", partitions[1:]) for n in sorted(folders, key=lambda n: f"{n}/"))
    return next((file for file in below if file), None)


@contextmanager
def _listing_tasks(spark: SparkSession, most: int) -> Iterator[None]:
    """Folders listed meanwhile are dealt out to so many tasks instead of up to one each."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), most)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def struct_types(columns: Mapping[str, str]) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in struct_type(columns)}


def _filtered(df: DataFrame, filters) -> DataFrame:
    for name, value in filters.items():
        values = list(value) if isinstance(value, (list, tuple, set)) else [value]
        df = df.where(F.col(name).isin(*values))
    return df


def scan(spark: SparkSession, path: str, columns, **filters) -> DataFrame:
    """Parquet directory with a declared schema; a missing path raises, an empty one is empty."""
    partition = {k: "string" for k in filters if k not in columns}
    kinds = {**columns, **{k: "date" if k == "dt" else v for k, v in partition.items()}}
    return _filtered(spark.read.schema(struct_type(kinds)).parquet(path), filters)


def scan_optional(spark: SparkSession, path: str, columns, **filters) -> DataFrame:
    """As scan, but a missing path gives an empty table."""
    try:
        return scan(spark, path, columns, **filters)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        kinds = {**columns, **{k: "date" if k == "dt" else "string" for k in filters if k not in columns}}
        return spark.createDataFrame([], struct_type(kinds))


def scan_candles(spark: SparkSession, root: str, mode: str, instruments, days) -> DataFrame:
    """Candles of instruments and days, pruned by partition."""
    columns = TABLES["candles"].columns
    return scan(spark, table_path(root, "candles"), columns, mode=mode, instrument=instruments, dt=days)


def scan_ticks(spark: SparkSession, root: str, mode: str, instruments, days, columns=None) -> DataFrame:
    columns = columns or TABLES["ticks"].columns
    return scan_optional(spark, table_path(root, "ticks"), columns, mode=mode, instrument=instruments, dt=days)


def scan_macro(spark: SparkSession, root: str, days) -> DataFrame:
    return scan_optional(spark, table_path(root, "macro"), TABLES["macro"].columns, dt=days)


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], tie: str | None = None) -> DataFrame:
    """Existing and incoming rows, one per key: incoming over existing, then the greatest tie value.

    Numeric types that differ are widened by the union.
    """
    tie_value = F.col(tie).cast("long") if tie else F.lit(0).cast("long")
    old = existing.withColumns({"_batch": F.lit(0), "_tie": F.lit(0).cast("long")})
    new = incoming.withColumns({"_batch": F.lit(1), "_tie": tie_value})
    both = old.select(*new.columns).unionByName(new)
    # Batch and tie in one number keeps the aggregate hash-based; ties fall back to the row hash.
    rest = [c for c in both.columns if c not in ("_batch", "_tie", *keys)]
    order = (
        F.col("_batch").cast("decimal(38,0)") * F.lit(10**18).cast("decimal(19,0)") + F.col("_tie").cast("decimal(19,0)")
        if tie
        else F.struct("_batch", F.xxhash64(*rest))
    )
    return keep_last(both, list(keys), order).drop("_batch", "_tie")


def upsert_table(incoming: DataFrame, table: str, root: str) -> None:
    """Action: merge incoming rows into the partitions they fall in; others are not read."""
    spec = TABLES[table]
    spark, path = incoming.sparkSession, table_path(root, table)
    touched = incoming.select(*spec.partitions).distinct()
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        merged = keep_last(incoming, list(spec.keys), row_order(incoming, spec.keys))
    else:
        stored = stored.withColumns({p: F.col(p).cast(dict(incoming.dtypes)[p]) for p in spec.partitions})
        stored = stored.join(touched, list(spec.partitions), "left_semi")
        merged = upsert(stored.select(*incoming.columns), incoming, spec.keys)
    write_partitioned(merged, path, spec.partitions, [k for k in spec.keys if k not in spec.partitions])


def with_text_default(df: DataFrame, name: str, value: str | None) -> DataFrame:
    """Column overridden by a given value; absent and not given raises."""
    if value is None:
        require_columns(df, [name], "import")
    return df.withColumn(name, F.lit(value) if value is not None else column_or(df, name, "string"))
