"""Run checks against DuckDB: python -m checks.compare [sf_dir] [key prefixes …]."""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from .base import CHECKS

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def session(cpus: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        # Windows and folds are bound by compute, not bytes: keep small shuffles on all cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def plain(value):
    if isinstance(value, float):
        return "nan" if value != value else f"{value:.9g}"
    if isinstance(value, (list, tuple)):
        return str([plain(v) for v in value])
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, key: str, folder: str) -> tuple[bool, str]:
    check = CHECKS[key]
    start = time.time()
    df = check.run(spark, folder)
    got_cols, got = rows_of(df.columns, df.collect())
    took = time.time() - start
    if check.sql is None:
        return len(got) > 0, f"rows {len(got)} (no oracle) {took:.1f}s"
    cursor = con.execute(check.sql)
    want_cols, want = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    if got_cols != want_cols:
        return False, f"columns differ: only here {set(got_cols) - set(want_cols)}, only oracle {set(want_cols) - set(got_cols)}"
    if got == want:
        return len(got) > 0, f"rows {len(got)} {took:.1f}s"
    mine, theirs = set(got), set(want)
    a, b = sorted(mine - theirs)[:2], sorted(theirs - mine)[:2]
    diff = [c for i, c in enumerate(got_cols) if a and b and a[0][i] != b[0][i]]
    return False, (
        f"rows {len(got)} / {len(want)}, {len(mine - theirs)} only here\n  cols {got_cols}\n  here {a}\n  oracle {b}\n  first pair differs in {diff}"
    )


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    bad = 0
    for key in CHECKS:
        if wanted and not any(key.startswith(w) for w in wanted):
            continue
        try:
            ok, text = compare(spark, con, key, folder)
        except Exception as e:  # report and go on with the next one
            ok, text = False, f"{type(e).__name__}: {str(e)[:1500]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {key}: {text}", flush=True)
    print(f"{bad} failures")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
