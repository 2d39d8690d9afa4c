"""Data-quality report, deduplication and their metrics in one pass.

The rows are grouped once by all columns (``g``: one row per distinct row
with its multiplicity ``n``). Every check is then a sum over ``g``: total =
sum(n), duplicates = sum(n - 1), nulls of c = sum(n where c is null),
negatives of c = sum(n where c < 0). That is one row-level shuffle and one
job, whatever the number of columns, and ``g`` is the deduplicated row set.
Map-side partial aggregation collapses a heavily repeated row before the
shuffle, so one hot row value cannot overload a task.

Report schema (long): check_name, column_name, metric_count, metric_pct,
status.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import numeric_columns

N = "__strata_n"

# Check names, the column label of the all-columns check,
# statuses, and the null-rate bound (percent) between WARNING and FAIL.
NULL_CHECK = "null_check"
DUPLICATE_CHECK = "duplicate_check"
NEGATIVE_CHECK = "negative_check"
ALL_COLUMNS = "ALL"
PASS, WARNING, FAIL = "PASS", "WARNING", "FAIL"
NULL_FAIL_PCT = 5.0

REPORT_SCHEMA = T.StructType([
    T.StructField("check_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("metric_count", T.LongType()),
    T.StructField("metric_pct", T.DoubleType()),
    T.StructField("status", T.StringType()),
])


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def grouped_rows(df: DataFrame) -> DataFrame:
    """One row per distinct row of ``df`` plus its multiplicity column ``N``."""
    return df.groupBy(*[_q(c) for c in df.columns]).agg(F.count(F.lit(1)).alias(N))


def metric_exprs(columns: list[str], numeric: list[str], weight: Column | None) -> list[Column]:
    """Aggregates for total, distinct rows, nulls and negatives.

    ``weight`` is the multiplicity column when aggregating grouped rows, or
    ``None`` when every input row counts once (rows known to be distinct).
    """
    w = weight if weight is not None else F.lit(1)

    def weighted(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, w)), F.lit(0)).cast("bigint")

    exprs = [F.coalesce(F.sum(w), F.lit(0)).cast("bigint").alias("rows_total"),
             F.count(F.lit(1)).cast("bigint").alias("rows_distinct")]
    exprs += [weighted(_q(c).isNull()).alias(f"null_{i}") for i, c in enumerate(columns)]
    exprs += [weighted(_q(c) < 0).alias(f"neg_{i}") for i, c in enumerate(numeric)]
    return exprs


def quality_metrics(df: DataFrame, rows_are_distinct: bool = False) -> DataFrame:
    """One-row frame: rows_total, rows_distinct, null_<i>, neg_<j>.

    ``rows_are_distinct=True`` skips the grouping (no shuffle) and reports
    zero duplicates, which is the situation right after a dedupe.
    """
    numeric = numeric_columns(df)
    if rows_are_distinct:
        return df.agg(*metric_exprs(df.columns, numeric, None))
    return grouped_rows(df).agg(*metric_exprs(df.columns, numeric, F.col(N)))


def report_from_metrics(metrics: DataFrame, columns: list[str], numeric: list[str]) -> DataFrame:
    """Unpivot the one-row metrics frame into the long report with statuses."""
    total = F.col("rows_total")
    entries = [F.struct(F.lit(NULL_CHECK).alias("k"), F.lit(c).alias("c"), F.col(f"null_{i}").alias("v"))
               for i, c in enumerate(columns)]
    entries.append(F.struct(F.lit(DUPLICATE_CHECK).alias("k"), F.lit(ALL_COLUMNS).alias("c"),
                            (total - F.col("rows_distinct")).alias("v")))
    entries += [F.struct(F.lit(NEGATIVE_CHECK).alias("k"), F.lit(c).alias("c"), F.col(f"neg_{i}").alias("v"))
                for i, c in enumerate(numeric)]
    long = metrics.select(total, F.explode(F.array(*entries)).alias("e")).select(
        F.col("e.k").alias("check_name"), F.col("e.c").alias("column_name"),
        F.col("e.v").cast("bigint").alias("metric_count"), total)
    count = F.col("metric_count")
    is_null_check = F.col("check_name") == NULL_CHECK
    # Rate as count / total * 100 in double; status is judged on this
    # unrounded value, the stored rate is rounded half-to-even to 2 places.
    raw_pct = F.when(total > 0, count.cast("double") / total.cast("double") * F.lit(100.0)) \
        .otherwise(F.lit(0.0))
    status = (F.when(is_null_check,
                     F.when(raw_pct == 0, F.lit(PASS))
                      .when(raw_pct < NULL_FAIL_PCT, F.lit(WARNING)).otherwise(F.lit(FAIL)))
              .when(F.col("check_name") == DUPLICATE_CHECK,
                    F.when(count == 0, F.lit(PASS)).otherwise(F.lit(WARNING)))
              .otherwise(F.when(count == 0, F.lit(PASS)).otherwise(F.lit(FAIL))))
    return long.select("check_name", "column_name", "metric_count",
                       F.when(is_null_check, F.bround(raw_pct, 2)).alias("metric_pct"),
                       status.alias("status"))


def quality_report(df: DataFrame, rows_are_distinct: bool = False) -> DataFrame:
    """Nulls per column, duplicate rows, negatives per numeric column."""
    return report_from_metrics(quality_metrics(df, rows_are_distinct), df.columns, numeric_columns(df))


def report_from_values(spark: SparkSession, values: dict, columns: list[str],
                       numeric: list[str]) -> DataFrame:
    """Same report from metric values already collected (e.g. by an Observation)."""
    names = ["rows_total", "rows_distinct"] + [f"null_{i}" for i in range(len(columns))] \
        + [f"neg_{i}" for i in range(len(numeric))]
    schema = T.StructType([T.StructField(n, T.LongType()) for n in names])
    row = tuple(int(values[n]) for n in names)
    return report_from_metrics(spark.createDataFrame([row], schema), columns, numeric)


def quality_summary(report: DataFrame) -> DataFrame:
    """Number of checks, of FAIL and of WARNING statuses."""
    return report.agg(F.count(F.lit(1)).cast("bigint").alias("n_checks"),
                      F.count_if(F.col("status") == FAIL).cast("bigint").alias("n_fail"),
                      F.count_if(F.col("status") == WARNING).cast("bigint").alias("n_warning"))


def dedup_full_row(df: DataFrame) -> DataFrame:
    """Distinct rows over all columns (NULL = NULL, NaN = NaN, 0.0 = -0.0)."""
    return df.dropDuplicates()


def dedup_metrics(df: DataFrame) -> DataFrame:
    """rows_before, rows_after, rows_removed from the same single grouping."""
    g = grouped_rows(df)
    return g.agg(F.coalesce(F.sum(N), F.lit(0)).cast("bigint").alias("rows_before"),
                 F.count(F.lit(1)).cast("bigint").alias("rows_after"),
                 F.coalesce(F.sum(F.col(N) - 1), F.lit(0)).cast("bigint").alias("rows_removed"))
