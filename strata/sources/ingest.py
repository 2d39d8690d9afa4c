"""Bronze ingestion with a run log.

The driver only loops over dataset specs; each dataset is one Spark job
(scan -> audit columns -> staged table write). The written row count comes
from an Observation on that same job. A failing dataset becomes a FAILED row
of the run log and does not stop the next one.
"""

from __future__ import annotations

import time
import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.concurrency import run_all
from ..spec import DatasetSpec, TableName
from .catalog import TableStore
from .delimited import add_audit_columns, read_delimited
from .schema_store import SchemaStore

_BAD = "__strata_bad_cells"

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("dataset", T.StringType()),
    T.StructField("database", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("columns", T.IntegerType()),
    T.StructField("bad_cells", T.LongType()),
    T.StructField("row_cap", T.LongType()),
    T.StructField("duration_s", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_class", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("started_at", T.TimestampType()),
])


def ingest(store: TableStore, spec: DatasetSpec, strict: bool = True) -> tuple:
    """Ingest one dataset into ``bronze_<name>``; return its run-log row.

    ``rows`` and ``columns`` describe the source data, before the audit
    columns; ``duration_s`` is in whole seconds.
    """
    started = datetime.now()
    t0 = time.monotonic()
    table = TableName("bronze", spec.name, store.database)
    df = read_delimited(store.spark, spec, strict=strict, bad_cells_column=_BAD)
    lenient = _BAD in df.columns
    n_columns = len(df.columns) - lenient
    obs = Observation(f"ingest_{spec.name}_{uuid.uuid4().hex[:6]}")
    if lenient:
        # cells nulled by lenient casts, counted by the write job itself
        df = df.observe(obs, F.sum(_BAD).cast("bigint").alias("bad_cells")).drop(_BAD)
    rows_obs = Observation(f"ingest_rows_{spec.name}_{uuid.uuid4().hex[:6]}")
    store.write(add_audit_columns(df, spec), table.short, metrics=rows_obs)
    rows = int(rows_obs.get["rows"])
    bad = int(obs.get["bad_cells"] or 0) if lenient else None
    return (spec.name, store.database, table.short, rows, n_columns, bad, _cap(spec), int(time.monotonic() - t0),
            "SUCCESS", None, None, started)


def ingest_all(store: TableStore, specs: list[DatasetSpec], strict: bool = True,
               max_workers: int = 4, schemas: SchemaStore | None = None) -> DataFrame:
    """Ingest every spec (independent jobs, submitted side by side).

    Failures are logged and isolated; the log keeps the order of ``specs``. With
    ``schemas`` column types are inferred once and then taken from there.
    """
    resolved: dict[DatasetSpec, DatasetSpec | Exception] = {}
    if schemas is not None:  # one after the other: they share a table
        for spec in specs:
            try:
                resolved[spec] = schemas.resolve(spec)
            except Exception as exc:  # noqa: BLE001 - recorded below
                resolved[spec] = exc

    def one(spec: DatasetSpec) -> tuple:
        started = datetime.now()
        try:
            known = resolved.get(spec, spec)
            if isinstance(known, Exception):
                raise known
            return ingest(store, known, strict=strict)
        except Exception as exc:  # noqa: BLE001 - recorded in the run log
            return (spec.name, store.database, None, None, None, None, _cap(spec), None, "FAILED",
                    _error_class(exc), str(exc), started)

    log = run_all([lambda s=spec: one(s) for spec in specs], max_workers)
    return store.spark.createDataFrame(log, RUN_LOG_SCHEMA)


def _cap(spec: DatasetSpec) -> int | None:
    """The row cap a dataset was ingested under, None when it is whole."""
    return spec.row_cap if spec.row_cap is not None and spec.row_cap >= 0 else None


def _error_class(exc: Exception) -> str:
    cond = getattr(exc, "getCondition", None) or getattr(exc, "getErrorClass", None)
    try:
        code = cond() if cond else None
    except Exception:  # noqa: BLE001
        code = None
    return code or type(exc).__name__


def _thousands(c: Column) -> Column:
    return F.format_number(c, 0)


def ingestion_report(run_log: DataFrame) -> DataFrame:
    """One printable line per dataset: status, name, row count, duration.

    Missing counts print as ``N/A`` and missing durations as ``-``.
    """
    rows = F.coalesce(_thousands(F.col("rows")), F.lit("N/A"))
    secs = F.coalesce(F.col("duration_s").cast("string"), F.lit("-"))
    line = F.format_string("  [%s]  %-35s | %10s rows | %ss",
                           F.col("status"), F.col("dataset"), rows, secs)
    return run_log.select("dataset", "status", rows.alias("rows_text"),
                          secs.alias("duration_text"), line.alias("line"))
