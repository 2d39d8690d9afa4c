"""Catalog tables: staged overwrite, read-back profile, multi-table Gold sink.

A plain ``saveAsTable(mode="overwrite")`` of a file-based table drops the
old data before the new job has finished, so a failed job leaves no table at
all, and a plan may not overwrite a table it reads. ``write_table`` therefore
writes a staging table first and swaps it in only after the job succeeded; the
old table is kept as a backup until the swap is done. Transactional formats
overwrite themselves atomically and take no staging table.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.concurrency import run_all
from ..session import note_scratch_database, scratch_path


@dataclass
class TableStore:
    """Where layered tables live: a database and a storage format."""

    spark: SparkSession
    database: str | None = None
    fmt: str = "parquet"

    @classmethod
    def scratch(cls, spark: SparkSession, fmt: str = "parquet") -> "TableStore":
        """A private database whose files sit below the shared scratch root."""
        name = f"strata_{uuid.uuid4().hex[:10]}"
        location = scratch_path(spark, "warehouse")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")
        note_scratch_database(name)
        return cls(spark, name, fmt)

    def qualify(self, table: str) -> str:
        return table if "." in table or not self.database else f"{self.database}.{table}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.qualify(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.read.table(self.qualify(table))

    def write(self, df: DataFrame, table: str, partition_by: list[str] | None = None,
              metrics: Observation | None = None) -> str:
        return write_table(df, self.qualify(table), fmt=self.fmt,
                           partition_by=partition_by, metrics=metrics)


# Formats of plain files, whose overwrite has to be staged.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "text", "avro")


def write_table(df: DataFrame, table: str, fmt: str = "parquet",
                partition_by: list[str] | None = None,
                metrics: Observation | None = None) -> str:
    """Overwrite ``table`` with ``df`` (schema included); the old data stays until it worked.

    ``metrics`` is an Observation whose row count is filled by this same
    write job, so no second pass is needed to know what was written.
    """
    spark = df.sparkSession
    out = df.observe(metrics, F.count(F.lit(1)).alias("rows")) if metrics is not None else df
    writer = out.write.format(fmt).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt not in FILE_FORMATS:
        writer.option("overwriteSchema", "true").saveAsTable(table)
        return table
    staging = f"{table}__staging_{uuid.uuid4().hex[:8]}"
    try:
        writer.saveAsTable(staging)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
        raise
    _swap_in(spark, staging, table, bool(partition_by))
    return table


def _swap_in(spark: SparkSession, staging: str, table: str, partitioned: bool) -> None:
    """Old table -> backup, staging -> table, drop the backup; on an error the old table returns.

    The backup has a fixed name, so a table lost by a crash half way is put
    back by ``restore_table`` (or replaced by the next write).
    """
    backup = f"{table}__backup"
    if spark.catalog.tableExists(table):
        spark.sql(f"DROP TABLE IF EXISTS {backup}")
        _rename(spark, table, backup)
    try:
        _rename(spark, staging, table)
        if partitioned:
            # The catalog tracks partition locations; re-point them after the move.
            spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    except Exception:
        if spark.catalog.tableExists(backup):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
            restore_table(spark, table)
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {backup}")


def adopt_folder(spark: SparkSession, folder: str, schema: T.StructType, table: str,
                 fmt: str = "parquet") -> str:
    """Let ``table`` be the files in ``folder``: swapped in like an overwrite, without copying."""
    staging = f"{table}__staging_{uuid.uuid4().hex[:8]}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {staging} ({columns}) USING {fmt} LOCATION '{sql_text(folder)}'")
    _swap_in(spark, staging, table, False)
    spark.sql(f"REFRESH TABLE {table}")
    return table


def restore_table(spark: SparkSession, table: str) -> bool:
    """Put the backup of an interrupted overwrite back; False when there is nothing to do."""
    backup = f"{table}__backup"
    if spark.catalog.tableExists(table) or not spark.catalog.tableExists(backup):
        return False
    _rename(spark, backup, table)
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return True


def _rename(spark: SparkSession, old: str, new: str) -> None:
    """Rename a table; its partitions follow it.

    A rename moves the folder of a managed table, but a catalog may leave its partitions
    pointing at the old place, and dropping such a table would delete what lies there by then.
    """
    was = location_of(spark, old)
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")
    now = location_of(spark, new)
    if was == now or not any(c.isPartition for c in spark.catalog.listColumns(new)):
        return
    for row in spark.sql(f"SHOW PARTITIONS {new}").collect():
        spec = partition_spec(row[0])
        place = location_of(spark, f"{new} {spec}")
        if place.startswith(f"{was}/"):
            spark.sql(f"ALTER TABLE {new} {spec} SET LOCATION '{sql_text(now + place[len(was):])}'")


def location_of(spark: SparkSession, target: str) -> str:
    """Folder of a table, or of a partition (``name PARTITION (...)``)."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {target}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location").rstrip("/")


def sql_text(text: str) -> str:
    """Text for use between single quotes."""
    return text.replace("\\", "\\\\").replace("'", "\\'")


def partition_spec(shown: str) -> str:
    """``PARTITION (...)`` for a line of SHOW PARTITIONS, whose values are written like folder names."""
    pairs = []
    for part in shown.split("/"):
        column, value = part.split("=", 1)
        null = value in ("__HIVE_DEFAULT_PARTITION__", "null")
        pairs.append(f"`{column}` = " + ("NULL" if null else f"'{sql_text(unquote(value))}'"))
    return f"PARTITION ({', '.join(pairs)})"


PROFILE_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("n_columns", T.IntegerType()),
    T.StructField("column_names", T.StringType()),
    T.StructField("status", T.StringType()),
])


def table_profile(spark: SparkSession, tables: list[str]) -> DataFrame:
    """Row count, column count and column list of each table, one row each.

    The counts are one union of per-table aggregates (each a partial count
    per task); a table that cannot be read yields a row with status ERROR
    instead of failing the others.
    """
    if not tables:
        return spark.createDataFrame([], PROFILE_SCHEMA)
    parts = []
    for name in tables:
        try:
            df = spark.read.table(name)
        except Exception as exc:  # noqa: BLE001 - reported as a row
            parts.append(spark.createDataFrame(
                [(name, None, None, None, f"ERROR: {type(exc).__name__}")], PROFILE_SCHEMA))
            continue
        parts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), F.col("rows"),
            F.lit(len(df.columns)).alias("n_columns"),
            F.lit(",".join(df.columns)).alias("column_names"),
            F.lit("OK").alias("status")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def preview(spark: SparkSession, table: str, rows: int = 5) -> DataFrame:
    """A few rows of a table, for reading (which ones is up to the scan)."""
    return spark.read.table(table).limit(rows)


def schema_listing(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type) rows of a DataFrame's schema."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")


GOLD_LOG_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("error", T.StringType()),
])


def write_gold(store: TableStore, tables: dict[str, DataFrame | None],
               clock_column: str = "_gold_timestamp", max_workers: int = 4) -> DataFrame:
    """Write each KPI frame that exists; log OK with its row count, SKIP or FAILED.

    The writes are independent jobs and are submitted side by side; one that
    fails is logged with its error and leaves the others and its old table alone.
    """
    def one(name: str, df: DataFrame | None):
        if df is None:
            return (name, "SKIP", None, None)
        obs = Observation(f"gold_{name}_{uuid.uuid4().hex[:6]}")
        try:
            store.write(df.withColumn(clock_column, F.current_timestamp()), name, metrics=obs)
        except Exception as exc:  # noqa: BLE001 - recorded in the log
            return (name, "FAILED", None, str(exc))
        return (name, "OK", int(obs.get["rows"]), None)

    log = run_all([lambda n=n, d=d: one(n, d) for n, d in tables.items()], max_workers)
    return store.spark.createDataFrame(log, GOLD_LOG_SCHEMA)
