"""Scalar expressions shared by the operators."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SENTINEL = "∅"

# The logical type names and the Spark types they stand for.
LOGICAL_TYPES = {
    "string": T.StringType(),
    "utf8": T.StringType(),
    "str": T.StringType(),
    "int": T.LongType(),
    "int64": T.LongType(),
    "i64": T.LongType(),
    "double": T.DoubleType(),
    "float": T.DoubleType(),
    "float64": T.DoubleType(),
    "f64": T.DoubleType(),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
    "timestamp": T.TimestampNTZType(),
    "datetime": T.TimestampNTZType(),
    "date": T.DateType(),
    "array<string>": T.ArrayType(T.StringType()),
    "list<string>": T.ArrayType(T.StringType()),
}

# MAE edges used when none (or unreadable ones) are given.
DEFAULT_MAE_EDGES = [0.25, 0.5, 0.75, 1.0, 1.5, 2.0]


def logical_type(name: str) -> T.DataType:
    try:
        return LOGICAL_TYPES[name.strip().lower()]
    except KeyError:
        raise ValueError(f"unknown logical type {name!r}") from None


def settings(defaults: Mapping, cfg: Mapping | None) -> dict:
    """Defaults overridden by the entries of cfg that are set."""
    return {**defaults, **{k: v for k, v in (cfg or {}).items() if v is not None}}


def _lit(value):
    return value if isinstance(value, Column) else F.lit(value)


def safe_div(num: Column, den: Column, default=0.0) -> Column:
    """num / den; the default where den is null or zero (null default allowed)."""
    fallback = F.lit(default).cast("double")
    return F.when(den.isNull() | (den == 0), fallback).otherwise(num / den)


def zscore(x: Column, mean: Column, std: Column, default=0.0) -> Column:
    return safe_div(x - mean, std, default)


def clip(x: Column, lo: float, hi: float) -> Column:
    """Clamp to [lo, hi]; null stays null."""
    return F.when(x < lo, F.lit(lo)).when(x > hi, F.lit(hi)).otherwise(x)


def clamp01(x: Column) -> Column:
    return clip(x, 0.0, 1.0)


def sign(x: Column) -> Column:
    """-1, 0 or 1 as int; the sign of null is 0."""
    return F.coalesce(F.signum(x), F.lit(0.0)).cast("int")


def bucket_by_edges(x: Column, edges: Sequence, labels: Sequence[str], default="unknown") -> Column:
    """Label of the half-open interval (e[i-1], e[i]] that holds x.

    Edges may be numbers or columns. A comparison with null is not true, so a
    null x, or a null edge on the side that matters, ends in the default.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("labels must have one entry more than edges")
    bounds = [_lit(e) for e in edges]
    chain = F.when(x > bounds[-1], F.lit(labels[-1]))
    for i in range(len(bounds) - 1, 0, -1):
        chain = chain.when((x > bounds[i - 1]) & (x <= bounds[i]), F.lit(labels[i]))
    return chain.when(x <= bounds[0], F.lit(labels[0])).otherwise(F.lit(default))


def parse_edges(text: str | None) -> list[float]:
    """Edges from a JSON array; anything unreadable gives the default edges."""
    try:
        values = json.loads(text or "null")
        if isinstance(values, list) and values:
            return sorted(float(v) for v in values)
    except (ValueError, TypeError):
        pass
    return list(DEFAULT_MAE_EDGES)


def interval_labels(x: Column, edges: Sequence[float]) -> Column:
    """'<= a', '(a,b]', ..., '> z'; null stays null."""
    labels = [f"<= {edges[0]:g}"]
    labels += [f"({a:g},{b:g}]" for a, b in zip(edges, edges[1:])]
    labels += [f"> {edges[-1]:g}"]
    return F.when(x.isNotNull(), bucket_by_edges(x, list(edges), labels))


def column_or(df: DataFrame, name: str, dtype, default=None) -> Column:
    """The column with a lenient cast if present, else a typed literal."""
    dtype = logical_type(dtype) if isinstance(dtype, str) else dtype
    if name in df.columns:
        return F.col(name).try_cast(dtype)
    return F.lit(default).cast(dtype)


def coalesce_present(df: DataFrame, names: Sequence[str], dtype) -> Column:
    """First non-null of the listed columns that exist; typed null if none does."""
    present = [column_or(df, n, dtype) for n in names if n in df.columns]
    return F.coalesce(*present) if present else column_or(df, "", dtype)


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def map_values(c: Column, mapping: Mapping[str, str], default: Column | str | None = None) -> Column:
    """Value lookup in a literal map; keys not found take the default."""
    if default is None:
        default = c
    if not mapping:
        return _lit(default)
    table = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    return F.coalesce(F.try_element_at(table, c), _lit(default))


def json_tags(tags: Sequence[Column]) -> Column:
    """JSON array text of the tags that are not null, in the given order."""
    return F.to_json(F.array_compact(F.array(*tags)))


def sha1_id(*parts: Column) -> Column:
    """SHA-1 over the parts joined by a vertical bar."""
    return F.sha1(F.concat_ws("|", *parts))


# Policy identifiers stamped on rows, apart from the two that
# name the family itself.
POLICY_IDS = {
    "micro_policy_id": "micro_policy_v1",
    "jump_policy_id": "jump_policy_v1",
    "impact_policy_id": "impact_policy_v1",
    "options_policy_id": "options_policy_v1",
}


def policy_ids(phase_version: str, threshold_bundle_id: str, cfg: Mapping | None = None) -> dict[str, Column]:
    ids = {
        "phase_version": phase_version,
        "threshold_bundle_id": threshold_bundle_id,
        **POLICY_IDS,
    }
    return {k: F.lit(str((cfg or {}).get(k, v))) for k, v in ids.items()}
