"""DataFrame helpers of the corpus operators: shards, shared tables, column names."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one only for a local session that names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="corpus-")


def kept_table(df: DataFrame, name: str, **options: str) -> DataFrame:
    """df written to the shared folder, with options of the writer, and read again: later work restarts from its files."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """name, with underscores added until no column of df has it (columns ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def trimmed(run):
    """run (batches → batches), after which the worker gives back the memory that it no longer uses: it goes on to other stages, and two of them share an executor with the JVM."""

    def go(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim:
            trim(0)

    return go


def extended(schema: T.StructType, **columns: str) -> T.StructType:
    """schema and more columns by name and simple type; schema itself stays as it is."""
    more = T.StructType()
    for name, kind in columns.items():
        more.add(name, kind)
    return T.StructType([*schema.fields, *more.fields])


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts."""
    return docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0


def shards_for(total: int, target: int) -> int:
    return max(1, -(-total // target))


def by_shard(docs: DataFrame, shards: int, *salt: str) -> DataFrame:
    """(shard, doc_id, text). The text is hashed too, so that an id on many different rows spreads; with columns of salt, equal rows as well."""
    key = F.pmod(F.xxhash64("doc_id", "text", *salt), F.lit(shards))
    return docs.select(key.cast("int").alias("shard"), "doc_id", "text")


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
