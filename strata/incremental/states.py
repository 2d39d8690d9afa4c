"""Mergeable states: quality checks per batch, KPI sums per Silver partition.

A quality state holds, per batch and key bucket, the rows that came in, the
distinct rows that no other batch brought, and the weighted null and negative
counts. Every figure is a sum, so the report of many batches is the sum of
their states, equal to the report of their union, duplicates included, without
reading a row again.

The Gold base holds one partition a Silver partition (a year) with its sums and
counts; only the partitions of years that changed are computed again, each
from that one Silver partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import kpi
from ..operators.quality import N, metric_exprs, report_from_metrics
from ..plans.pipeline import gold_frames
from ..sources.catalog import TableStore, write_gold
from ..sources.partitions import write_partitions
from ..spec import Roles, bind_roles
from .history import BATCH, BUCKET, KEY, SEEN, key_bucket

STATE_BUCKETS = 16
_ROWS_OUT = "rows_out"


# --- quality ----------------------------------------------------------------------------

def check_states(grouped: DataFrame, columns: list[str], numeric: list[str], kept: Column,
                 buckets: int = STATE_BUCKETS) -> DataFrame:
    """One row a key bucket of a batch's grouped rows (with ``N``, ``KEY`` and ``SEEN``).

    ``kept`` says which unseen rows the cleaned layer keeps.
    """
    sums = [m for m in metric_exprs(columns, numeric, F.col(N))]
    fresh = ~F.col(SEEN)
    return (grouped.groupBy(key_bucket(F.col(KEY), buckets).alias(BUCKET))
            .agg(*sums, F.count_if(fresh).alias("fresh"), F.count_if(fresh & kept).alias(_ROWS_OUT))
            .drop("rows_distinct").withColumnRenamed("fresh", "rows_distinct"))


def merged_states(states: DataFrame) -> DataFrame:
    """One row: the sums over all batches and buckets."""
    figures = [c for c in states.columns if c not in (BATCH, BUCKET)]
    return states.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in figures])


def merged_report(states: DataFrame, columns: list[str], numeric: list[str]) -> DataFrame:
    """The quality report of everything the states cover."""
    return report_from_metrics(merged_states(states), columns, numeric)


def merged_metrics(states: DataFrame) -> DataFrame:
    """rows_in, rows_distinct, rows_deduplicated, rows_out, rows_suppressed over all batches."""
    total, distinct, out = F.col("rows_total"), F.col("rows_distinct"), F.col(_ROWS_OUT)
    return merged_states(states).select(
        total.alias("rows_in"), distinct, (total - distinct).alias("rows_deduplicated"), out,
        (distinct - out).alias("rows_suppressed"))


# --- KPIs -------------------------------------------------------------------------------

def of_years(df: DataFrame, column: str, years: list) -> DataFrame:
    """Rows of the listed years (None among them means no year): a partition filter."""
    known = [y for y in years if y is not None]
    wanted = F.col(column).isin(known) if known else F.lit(False)
    return df.filter(wanted | F.col(column).isNull() if None in years else wanted)


def refresh_base(store: TableStore, dataset: str, years: list, roles: Roles | None = None) -> list:
    """Compute the Gold base anew for some years, from their Silver partitions alone."""
    silver = store.read(f"silver_{dataset}")
    roles = roles or bind_roles(silver.columns)
    if not years:
        return []
    base = kpi.gold_base(of_years(silver, roles.year, years), roles)
    return write_partitions(store, base, f"gold_base_{dataset}", roles.year, years)


def gold_from_base(store: TableStore, dataset: str, roles: Roles | None = None) -> dict[str, DataFrame | None]:
    """The four KPI frames from the stored base; no Silver row is read."""
    base = store.read(f"gold_base_{dataset}")
    return gold_frames(base, roles or bind_roles(base.columns))


def write_gold_from_base(store: TableStore, dataset: str, roles: Roles | None = None) -> DataFrame:
    frames = gold_from_base(store, dataset, roles)
    return write_gold(store, {f"{name}_{dataset}": df for name, df in frames.items()})
