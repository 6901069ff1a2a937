"""Shape classes of trade paths."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import column_or, interval_labels, json_tags, parse_edges, settings
from .bars import keep_last
from .windows import row_order

PATHS = {"path_shape_time_to_1R_bars_max": 12, "path_mae_R_bucket_edges_json": None}

# Shape → (family, primary filter).
SHAPES = {
    "straight_runner": ("winners", "fast_winner"),
    "dip_then_go": ("winners", "drawdown_then_win"),
    "grind_then_go": ("winners", "slow_winner"),
    "straight_fail": ("losers", "fast_loser"),
    "chop_and_die": ("losers", "chop_loser"),
}


def path_classes(paths: DataFrame, cfg: Mapping | None = None) -> DataFrame:
    """path_shape, family, filter, tags and MAE bucket, one row per trade_id."""
    c = settings(PATHS, cfg)
    quick = c["path_shape_time_to_1R_bars_max"]
    fields = {
        "path_cluster_id": "string",
        "time_to_1R_bars": "int64",
        "time_to_2R_bars": "int64",
        "mae_R": "double",
        "mfe_R": "double",
        "exit_reason": "string",
    }
    df = paths.select(
        F.col("trade_id").cast("string").alias("trade_id"), *[column_or(paths, n, t).alias(n) for n, t in fields.items()]
    ).where(F.col("trade_id").isNotNull())
    df = keep_last(df, ["trade_id"], row_order(df, ["trade_id"]))
    t1, mae, mfe = F.col("time_to_1R_bars"), F.col("mae_R"), F.col("mfe_R")
    shape = (
        F.when((t1 <= quick) & (mfe >= 2.0) & (mae <= 0.5), "straight_runner")
        .when((mfe >= 2.0) & (mae > 0.5), "dip_then_go")
        .when((t1 > quick) & (mfe >= 1.5), "grind_then_go")
        .when((mfe < 1.0) & (mae >= 1.0), "straight_fail")
        .when((t1 > quick) & (mfe < 1.0), "chop_and_die")
        .otherwise("unknown")
    )
    df = df.withColumns({"path_shape": shape, "mae_R_bucket": interval_labels(mae, parse_edges(c["path_mae_R_bucket_edges_json"]))})
    family, primary = F.lit("unknown"), F.lit(None).cast("string")
    for name, (fam, first) in SHAPES.items():
        family = F.when(F.col("path_shape") == name, fam).otherwise(family)
        primary = F.when(F.col("path_shape") == name, first).otherwise(primary)
    return df.withColumns(
        {
            "path_family_id": family,
            "path_filter_primary": primary,
            "path_filter_tags_json": json_tags(
                [primary, F.when(mae >= 1.0, F.lit("deep_mae")), F.when(mfe >= 2.0, F.lit("high_mfe"))]
            ),
        }
    )
