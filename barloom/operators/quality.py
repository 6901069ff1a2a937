"""Content hashes, key invariants, manifests and row-count summaries."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .conform import union_all


def content_hash(df: DataFrame, drop: Sequence[str] = ("run_id",)) -> DataFrame:
    """Order-free digest of a table: row count, sum and xor of row hashes."""
    columns = sorted(c for c in df.columns if c not in drop)
    row = F.xxhash64(*columns)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("hash_sum"),
        F.coalesce(F.bit_xor(row), F.lit(0)).alias("hash_xor"),
    )


#: Where a rounded double is cut, beside the middle: decimal data falls exactly on that.
CUT = 0.50013


def portable_digest(df: DataFrame, drop: Sequence[str] = ("run_id",), digits: int = 6) -> DataFrame:
    """Order-free digest that another engine can compute: rows, sums of two widths and xor of the rows' MD5.

    A row's text is its columns by name, each as its length, a colon and its text, n for null; times are microseconds,
    doubles whole units of the last digit. From the MD5's hex digits 1 to 8 and 9 to 23 come a 32-bit and a 60-bit number.
    """
    cells = []
    for name, kind in sorted(df.dtypes):
        x = F.col(f"`{name}`")
        if name in drop:
            continue
        if kind in ("double", "float"):
            x = F.floor(x * 10.0**digits + CUT).cast("long")
        elif kind.startswith("timestamp"):
            x = F.unix_micros(x.cast("timestamp"))
        text = x.cast("string")
        cells.append(F.when(text.isNull(), "n").otherwise(F.concat(F.length(text).cast("string"), F.lit(":"), text)))
    digest = F.md5(F.concat(*cells).cast("binary"))
    narrow, wide = (F.conv(F.substring(digest, a, n), 16, 10).cast("long") for a, n in ((1, 8), (9, 15)))
    return df.select(narrow.alias("a"), wide.alias("b")).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.coalesce(F.sum(F.col(c).cast("decimal(38,0)")), F.lit(0)).cast("string").alias(n) for c, n in (("a", "sum_32"), ("b", "sum_60"))],
        F.coalesce(F.bit_xor("b"), F.lit(0)).alias("xor_60"),
    )


def key_invariants(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, rows with a null key, and surplus copies of a key, in one row."""
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"missing key columns: {missing}")
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(null_key, F.col("_n"))), F.lit(0)).alias("null_key_rows"),
            F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
        )
    )


def schema_fingerprint(columns: Mapping[str, str]) -> str:
    """SHA-256 over the sorted column:type list."""
    text = "|".join(f"{n}:{t}" for n, t in sorted(columns.items()))
    return hashlib.sha256(text.encode()).hexdigest()


def table_counts(tables: Mapping[str, DataFrame], by: Sequence[str] = ()) -> DataFrame:
    """Rows per table, and per key columns if given, from one tagged union."""
    tagged = [df.select(F.lit(name).alias("table"), *by) for name, df in tables.items()]
    return union_all(tagged).groupBy("table", *by).agg(F.count(F.lit(1)).alias("rows"))


def manifest(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Row count and schema fingerprint per table; empty tables are listed too."""
    spark = next(iter(tables.values())).sparkSession
    described = spark.createDataFrame(
        [(n, schema_fingerprint(dict(df.dtypes)), ",".join((keys or {}).get(n, ()))) for n, df in tables.items()],
        "table string, schema_fingerprint string, key_columns string",
    )
    return described.join(table_counts(tables), "table", "left").withColumn(
        "rows", F.coalesce("rows", F.lit(0).cast("long"))
    )


def column_check(tables: Mapping[str, DataFrame], required: Mapping[str, Sequence[str]]) -> DataFrame:
    """Required columns present, and rows per table."""
    for name, columns in required.items():
        missing = [c for c in columns if c not in tables[name].columns]
        if missing:
            raise ValueError(f"{name}: missing columns {missing}")
    return manifest(tables).select("table", "rows")
