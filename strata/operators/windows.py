"""Window operators used by the KPIs.

These run on aggregated frames (one row per year, region or category), so
an unpartitioned window moves a bounded handful of rows into one task. The
helpers accept an optional ``partition_by`` for inputs that are not bounded
that way; then each partition is ranked or shifted independently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path


def _window(partition_by: list[str] | None):
    return Window.partitionBy(*partition_by) if partition_by else Window.partitionBy()


def lag_previous_period(df: DataFrame, order_col: str, value_col: str, out_col: str,
                        offset: int = 1, strict_calendar: bool = False,
                        partition_by: list[str] | None = None) -> DataFrame:
    """Value of the previous row in ``order_col`` order (NULL for the first).

    By default the previous *row* is used, so a missing period is bridged.
    ``strict_calendar=True`` gives NULL unless the previous row is exactly
    ``offset`` periods earlier.
    """
    w = _window(partition_by).orderBy(F.col(order_col))
    prev = F.lag(F.col(value_col), offset).over(w)
    if strict_calendar:
        prev_key = F.lag(F.col(order_col), offset).over(w)
        prev = F.when(prev_key == F.col(order_col) - F.lit(offset), prev)
    return df.withColumn(out_col, prev)


_ROW, _KEY, _SPREAD, _RANGE = "row", "key", "spread", "range"


def _ranges(df: DataFrame, key_col: str, order, ranges: int | None) -> DataFrame:
    """``df`` cut into ranges of a key and stored once: (row, key, spread, range).

    The source row travels as one struct, so working columns clash with none
    of its own. Spark's range partitioning samples the keys, so any orderable
    type works. A row hash is the second key: a run of equal or NULL keys
    spreads over as many ranges as its size asks for (rows equal in every
    column stay together). The ranges are stored below the shared scratch
    folder, because a second evaluation could sample other bounds.
    """
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    packed = df.select(F.struct("*").alias(_ROW), F.col(f"`{key_col}`").alias(_KEY),
                       F.xxhash64(*hashed).alias(_SPREAD))
    cut = (packed.repartitionByRange(n, order(F.col(_KEY)), F.col(_SPREAD))
           .withColumn(_RANGE, F.spark_partition_id()))
    path = scratch_path(spark, "ranges")
    cut.write.parquet(path)
    return spark.read.schema(cut.schema).parquet(path)


def _unpacked(rows: DataFrame, out_col: str, value: Column) -> DataFrame:
    """The source rows with one more column."""
    return rows.select(f"{_ROW}.*", value.alias(out_col))


def lag_previous_unbounded(df: DataFrame, order_col: str, value_col: str, out_col: str,
                           ranges: int | None = None) -> DataFrame:
    """``lag_previous_period`` (offset 1) for inputs of any size and any orderable key.

    Inside a range the previous row comes from a window partitioned by range;
    the first row of a range takes the last value of the previous non-empty
    range (a window over one row per range, broadcast: as many rows as
    shuffle partitions). NULL keys come first, as in an ascending window. The
    previous row among equal keys has no defined order. Empty input gives an
    empty frame.
    """
    inside = Window.partitionBy(_RANGE).orderBy(F.col(_KEY).asc_nulls_first(), _SPREAD)
    value = F.col(_ROW)[value_col]
    rows = _ranges(df, order_col, Column.asc_nulls_first, ranges).withColumn(
        "nth", F.row_number().over(inside))
    numbered = rows.withColumn("before", F.lag(value).over(inside))
    last = rows.groupBy(_RANGE).agg(F.max_by(F.struct(value.alias("v")), "nth").alias("last"))
    carry = last.select(_RANGE, F.lag("last").over(Window.orderBy(_RANGE))["v"].alias("carry"))
    out = numbered.join(F.broadcast(carry), _RANGE)
    return _unpacked(out, out_col, F.when(F.col("nth") == 1, F.col("carry")).otherwise(F.col("before")))


def pct_change(current: Column, previous: Column, decimals: int = 2) -> Column:
    """round((current - previous) / previous * 100); NULL if previous is NULL or 0."""
    ok = previous.isNotNull() & (previous != 0)
    return F.round(F.when(ok, (current - previous) / previous * F.lit(100.0)), decimals)


def share_of_total(df: DataFrame, value_col: str, out_col: str = "pct_of_total",
                   decimals: int = 2, partition_by: list[str] | None = None) -> DataFrame:
    """round(value / sum(value over all rows) * 100); NULL when either is NULL."""
    total = F.sum(F.col(value_col)).over(_window(partition_by))
    ratio = F.when(total != 0, F.col(value_col) / total * F.lit(100.0))
    return df.withColumn(out_col, F.round(ratio, decimals))


def share_of_total_unbounded(df: DataFrame, value_col: str, out_col: str = "pct_of_total",
                             decimals: int = 2) -> DataFrame:
    """``share_of_total`` for inputs of any size.

    The total is a scalar subquery (one partial sum per task, one value
    back), so the rows themselves never leave their partitions. The input
    is aggregated a second time for the total, so pass a stored or cheap
    frame.
    """
    total = df.select(F.sum(F.col(value_col))).scalar()
    ratio = F.when(total != 0, F.col(value_col) / total * F.lit(100.0))
    return df.withColumn(out_col, F.round(ratio, decimals))


def rank_desc(df: DataFrame, value_col: str, out_col: str = "ranking",
              partition_by: list[str] | None = None) -> DataFrame:
    """Competition rank by descending value: ties share, a gap follows, NULLs last."""
    w = _window(partition_by).orderBy(F.col(value_col).desc_nulls_last())
    return df.withColumn(out_col, F.rank().over(w))


def top_k_by_rank(df: DataFrame, rank_col: str, k: int = 3, flag_col: str = "is_top_k") -> DataFrame:
    """Flag rows whose rank is within the first ``k`` (ties included)."""
    return df.withColumn(flag_col, F.coalesce(F.col(rank_col) <= F.lit(k), F.lit(False)))


def top_k_rows(df: DataFrame, value_col: str, k: int, out_col: str = "ranking",
               partition_by: list[str] | None = None) -> DataFrame:
    """Rows ranked within the first ``k`` by descending value.

    A filter on a rank lets Spark insert a per-task group limit before the
    shuffle, so each task forwards at most ``k`` rows per partition key.
    """
    return rank_desc(df, value_col, out_col, partition_by).filter(F.col(out_col) <= F.lit(k))


def rank_desc_unbounded(df: DataFrame, value_col: str, out_col: str = "ranking",
                        ranges: int | None = None) -> DataFrame:
    """``rank_desc`` (as bigint) for inputs of any size and any orderable value.

    Each range is ranked by a window partitioned by range, then shifted by
    the rows of the ranges before it. A run of equal values that began in an
    earlier range takes the rank of its first row; the run starts come from a
    window over one row per range (broadcast: as many rows as shuffle
    partitions). NULL values rank last; empty input gives an empty frame.
    """
    order = F.col(_KEY).desc_nulls_last()
    rows = _ranges(df, value_col, Column.desc_nulls_last, ranges).withColumn(
        "inner", F.rank().over(Window.partitionBy(_RANGE).orderBy(order)).cast("bigint"))
    key = F.struct(F.col(_KEY).alias("v"))
    summary = rows.groupBy(_RANGE).agg(
        F.count(F.lit(1)).alias("n"), F.max("inner").alias("last_rank"),
        F.min_by(key, "inner").alias("first"), F.max_by(key, "inner").alias("last"))
    in_order = Window.orderBy(_RANGE)
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    goes_on = F.coalesce((F.col("n_prev") > 0) & F.col("first")["v"].eqNullSafe(F.col("prev")["v"]),
                         F.lit(False))
    starts = (summary
              .withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
              .withColumn("prev", F.lag("last").over(in_order))
              .withColumn("n_prev", F.lag("n").over(in_order))
              .withColumn("goes_on", goes_on)
              .withColumn("start", F.when(~(F.col("goes_on") & (F.col("last_rank") == 1)),
                                          F.col("offset") + F.col("last_rank")))
              .withColumn("run", F.last("start", ignorenulls=True).over(before))
              .select(_RANGE, "offset", F.when(F.col("goes_on"), F.col("run"))
                      .otherwise(F.col("offset") + 1).alias("head")))
    out = rows.join(F.broadcast(starts), _RANGE)
    return _unpacked(out, out_col, F.when(F.col("inner") == 1, F.col("head"))
                     .otherwise(F.col("offset") + F.col("inner")))
