"""Schema conformance, identity columns, key handling."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import SENTINEL, is_blank, logical_type

EVAL_KEYS = ("paradigm_id", "principle_id", "candidate_id", "experiment_id")
RESERVED = ("snapshot_id", "run_id", "mode", "dt", "trading_day")


@dataclass(frozen=True)
class RunContext:
    """Identity of one run, stamped on every stored row."""

    env: str
    mode: str
    snapshot_id: str
    run_id: str
    experiment_id: str | None = None
    candidate_id: str | None = None
    base_seed: int = 0


def require_columns(df: DataFrame, columns: Iterable[str], where: str = "") -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{where}: missing required columns: {missing}")
    return df


def struct_type(columns: Mapping[str, str]) -> T.StructType:
    return T.StructType([T.StructField(n, logical_type(t)) for n, t in columns.items()])


def empty_table(spark: SparkSession, columns: Mapping[str, str]) -> DataFrame:
    return spark.createDataFrame([], struct_type(columns))


def enforce_schema(df: DataFrame, columns: Mapping[str, str], allow_extra=True, reorder=False) -> DataFrame:
    """Typed nulls for absent columns, lenient casts for present ones."""
    declared = {
        n: (F.col(n).try_cast(logical_type(t)) if n in df.columns else F.lit(None).cast(logical_type(t)))
        for n, t in columns.items()
    }
    extra = [c for c in df.columns if c not in declared] if allow_extra else []
    if reorder:
        names = [*declared, *extra]
    else:
        present = [c for c in df.columns if c in declared or c in extra]
        names = present + [n for n in declared if n not in df.columns]
    return df.select(*[declared[n].alias(n) if n in declared else F.col(n) for n in names])


def conform_to_family(df: DataFrame, columns: Sequence[str] | None, keys: Sequence[str], allow_extra=True) -> DataFrame:
    """Family output as declared: keys required, absent columns null, extras optional."""
    if not columns:
        return df
    require_columns(df, keys, "family output")
    df = df.withColumns({c: F.lit(None) for c in columns if c not in df.columns})
    return df if allow_extra else df.select(*[c for c in df.columns if c in set(columns)])


def merge_family_columns(families: Mapping[str, Mapping[str, str]]) -> dict[str, str]:
    """One column → type map over families; conflicting types and reserved names raise."""
    merged: dict[str, str] = {}
    for family, columns in families.items():
        for name, kind in columns.items():
            if name in RESERVED:
                raise ValueError(f"{family} may not own the reserved column {name}")
            if merged.setdefault(name, kind) != kind:
                raise ValueError(f"{family}.{name}: {kind} conflicts with {merged[name]}")
    return merged


def require_disjoint(frames: Mapping[str, DataFrame], keys: Sequence[str]) -> None:
    """Two families may not emit the same non-key column."""
    owner: dict[str, str] = {}
    for name, df in frames.items():
        for column in set(df.columns) - set(keys):
            if column in owner:
                raise ValueError(f"column {column} comes from {owner[column]} and {name}")
            owner[column] = name


def stamp_identity(df: DataFrame, ctx: RunContext, trading_day: date | None = None, **extra) -> DataFrame:
    """Run identity where absent; a null dt becomes the trading day."""
    literals = {
        n: F.lit(v)
        for n, v in {"snapshot_id": ctx.snapshot_id, "run_id": ctx.run_id, "mode": ctx.mode, **extra}.items()
        if n not in df.columns
    }
    day = F.lit(trading_day).cast("date")
    dt = F.coalesce(F.col("dt").try_cast("date"), day) if "dt" in df.columns else day
    return df.withColumns({**literals, "dt": dt})


def normalise_evaluation(df: DataFrame, where: str = "table") -> DataFrame:
    """Evaluation ids as strings; absent, null or blank candidate/experiment → ∅."""
    if "paradigm_id" not in df.columns:
        return df
    require_columns(df, ["principle_id"], where)
    return df.withColumns(
        {
            **{k: F.col(k).cast("string") for k in EVAL_KEYS[:2]},
            **{
                k: (
                    F.when(is_blank(F.col(k).cast("string")), F.lit(SENTINEL)).otherwise(F.col(k).cast("string"))
                    if k in df.columns
                    else F.lit(SENTINEL)
                )
                for k in EVAL_KEYS[2:]
            },
        }
    )


def fill_evaluation(df: DataFrame) -> DataFrame:
    """All four ids present and non-null (reports group by them)."""
    return df.withColumns(
        {
            k: F.coalesce(F.col(k).cast("string"), F.lit(SENTINEL)) if k in df.columns else F.lit(SENTINEL)
            for k in EVAL_KEYS
        }
    )


def on_day(df: DataFrame, day: date, ts="ts") -> DataFrame:
    return df.where(F.to_date(ts) == F.lit(day))


def cast_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """String ids, zone-less microsecond timestamps."""
    stamps = {"ts", "anchor_ts", "entry_ts", "pcr_window_ts", "decision_ts"}
    return df.withColumns(
        {k: F.col(k).cast("timestamp_ntz" if k in stamps else "string") for k in keys if k in df.columns}
    )


def order_columns(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys first, the rest by name."""
    return df.select(*keys, *sorted(c for c in df.columns if c not in keys))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Vertical union by name; columns missing on a side become null."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


INTEGERS = ("tinyint", "smallint", "int", "bigint")
FLOATS = ("float", "double")


def wider_type(a: str, b: str) -> str:
    """The type that holds both: the longer integer, double beside a float, decimal with room for both; else raises."""
    if a == b:
        return a
    if a in INTEGERS and b in INTEGERS:
        return max(a, b, key=INTEGERS.index)
    numeric = (*INTEGERS, *FLOATS)
    if all(t in numeric or t.startswith("decimal") for t in (a, b)):
        if a in FLOATS or b in FLOATS:
            return "double"
        whole = dict(zip(INTEGERS, (3, 5, 10, 19), strict=True))
        sizes = [(whole[t], 0) if t in whole else tuple(int(x) for x in t[8:-1].split(",")) for t in (a, b)]
        scale = max(s for _, s in sizes)
        digits = max(p - s for p, s in sizes) + scale
        if digits <= 38:
            return f"decimal({digits},{scale})"
    raise ValueError(f"no common type of {a} and {b}")


def union_widened(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union of equal columns; where types differ both sides take the type that holds both."""
    types_b = dict(b.dtypes)
    wide = {n: F.col(n).cast(wider_type(t, types_b[n])) for n, t in a.dtypes if t != types_b[n]}
    return a.withColumns(wide).unionByName(b.withColumns(wide)) if wide else a.unionByName(b)


def require_filled(df: DataFrame, flag: str, fields: Sequence[str], show: Sequence[str], sample=5) -> None:
    """Action: where flag is set the fields must be non-null; raises with a sample."""
    bad = rows_missing(df, flag, fields).select(*show).limit(sample).collect()
    if bad:
        raise ValueError(f"{flag} is set but a required field is null, e.g. {bad}")


def rows_missing(df: DataFrame, flag: str, fields: Sequence[str]) -> DataFrame:
    fields = [f for f in fields if f in df.columns]
    if flag not in df.columns or not fields:
        return df.limit(0)
    any_null = F.lit(False)
    for f in fields:
        any_null = any_null | F.col(f).isNull()
    return df.where(F.col(flag).isNotNull() & any_null)
