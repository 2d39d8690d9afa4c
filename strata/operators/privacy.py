"""Small-count suppression: drop rows that stand for too few sites.

A per-row threshold on a count column (rows whose count is missing are
dropped too). The filter is deterministic, so Catalyst pushes it to the
Parquet scan when nothing in between needs the dropped rows.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: minimum number of sites a published row must represent.
DEFAULT_MIN_SITES = 5
AUDIT_COLUMN = "_min_sites"


def keep_condition(sites: str, k: int = DEFAULT_MIN_SITES) -> Column:
    c = F.col(sites)
    return c.isNotNull() & (c >= F.lit(k))


def suppress_small_counts(df: DataFrame, sites: str | None, k: int = DEFAULT_MIN_SITES,
                          audit: bool = False) -> DataFrame:
    """Rows with ``sites >= k``; without a sites column the input passes through."""
    if not sites or sites not in df.columns:
        warnings.warn(f"no sites column {sites!r}: small-count suppression not applied",
                      stacklevel=2)
        return df
    out = df.filter(keep_condition(sites, k))
    return out.withColumn(AUDIT_COLUMN, F.lit(k)) if audit else out


def suppression_metrics(df: DataFrame, sites: str, k: int = DEFAULT_MIN_SITES) -> DataFrame:
    """rows_before, rows_after, rows_removed in one aggregate (no second scan)."""
    kept = F.count_if(F.coalesce(keep_condition(sites, k), F.lit(False)))
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("rows_before"),
                  kept.cast("bigint").alias("rows_after"),
                  (F.count(F.lit(1)) - kept).cast("bigint").alias("rows_removed"))
