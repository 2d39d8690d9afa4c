"""Ingestion that loses nothing: what cannot be kept goes to a rejects table.

Sound records and rejected ones are written by one job from one scan, into two
folders, which become ``bronze_<dataset>`` and ``rejects_<dataset>``. Rows read
always equal rows kept plus rows rejected, and a rejected row keeps its text:
the raw record if its shape was wrong, every cell if a cell could not be parsed.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import DatasetSpec, TableName
from .catalog import TableStore, adopt_folder
from .delimited import BAD_COLUMNS, CELLS, REASON, RECORD, add_audit_columns, read_marked
from .files import Files, database_location

_REJECTED = "rejected"


@dataclass(frozen=True)
class Rejection:
    rows_in: int
    rows_kept: int
    rows_rejected: int


def ingest_with_rejects(store: TableStore, spec: DatasetSpec) -> Rejection:
    """Ingest a dataset into ``bronze_<name>`` and ``rejects_<name>``; both are replaced."""
    if spec.row_cap is not None and spec.row_cap >= 0:
        raise ValueError("a row cap would lose records that no table holds")
    spark = store.spark
    kept, rejects = (TableName(layer, spec.name).short for layer in ("bronze", "rejects"))
    frame = add_audit_columns(read_marked(spark, spec), spec).withColumn(
        _REJECTED, F.col(REASON).isNotNull())
    counts = Observation(f"rejects_{spec.name}_{uuid.uuid4().hex[:6]}")
    frame = frame.observe(counts, F.count(F.lit(1)).alias("rows_in"),
                          F.count_if(_REJECTED).alias("rows_rejected"))
    files = Files(spark)
    home = f"{database_location(spark, store.database)}/{kept}__files"
    before = [path for path, _, _ in files.children(home)]
    folder = f"{home}/{uuid.uuid4().hex}"
    frame.write.partitionBy(_REJECTED).parquet(folder)
    marks = (REASON, RECORD, CELLS, BAD_COLUMNS, _REJECTED)
    sound = T.StructType([f for f in frame.schema.fields if f.name not in marks])
    audit = [f for f in sound.fields if f.name.startswith("_")]
    why = T.StructType([f for f in frame.schema.fields if f.name in marks[:-1]] + audit)
    for table, flag, schema in ((rejects, "true", why), (kept, "false", sound)):
        files.make(f"{folder}/{_REJECTED}={flag}")  # stays empty when there are none
        adopt_folder(spark, f"{folder}/{_REJECTED}={flag}", schema, store.qualify(table))
    # The folder that this run replaced stays for reads that still run; older ones go.
    for path in before[:-1]:
        files.delete(path)
    got = counts.get
    return Rejection(got["rows_in"], got["rows_in"] - got["rows_rejected"], got["rows_rejected"])


def reject_summary(rejects: DataFrame) -> DataFrame:
    """How many records were rejected, by reason and column at fault."""
    fault = F.explode_outer(F.when(F.size(BAD_COLUMNS) > 0, F.col(BAD_COLUMNS)))
    return (rejects.select(REASON, fault.alias("column_name"))
            .groupBy(F.col(REASON).alias("reason"), "column_name")
            .agg(F.count(F.lit(1)).alias("n_records")))
