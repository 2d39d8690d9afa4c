"""A durable, append-only log of runs.

Every run has an id; what one layer of it did is one entry of the log table. An
entry is written whole or not at all, and writing it again (a step that was
retried) replaces it: the log holds every run once, however often a step ran.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .catalog import TableStore
from .partitions import write_partitions

TABLE = "strata_run_log"
_FIELDS = {"dataset": "string", "table_name": "string", "status": "string", "rows": "bigint",
           "columns": "int", "bad_cells": "bigint", "row_cap": "bigint", "duration_s": "bigint",
           "error_class": "string", "error": "string", "started_at": "timestamp"}


def new_run_id() -> str:
    """Ids sort by the time the run began."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


class RunLog:
    def __init__(self, store: TableStore) -> None:
        self.store = store

    def record(self, run_id: str, layer: str, log: DataFrame) -> None:
        """Store a layer's log (any columns of the log's own are kept, others go)."""
        known = [F.col(c).cast(kind).alias(c) if c in log.columns else F.lit(None).cast(kind).alias(c)
                 for c, kind in _FIELDS.items()]
        rows = log.select(F.lit(run_id).alias("run_id"), F.lit(layer).alias("layer"), *known,
                          F.lit(f"{run_id}.{layer}").alias("entry"))
        write_partitions(self.store, rows, TABLE, "entry")

    def read(self) -> DataFrame:
        if not self.store.exists(TABLE):
            fields = ", ".join(f"{c} {kind}" for c, kind in _FIELDS.items())
            return self.store.spark.createDataFrame([], T.StructType.fromDDL(
                f"run_id string, layer string, {fields}"))
        return self.store.read(TABLE).drop("entry")

    def last_status(self) -> DataFrame:
        """The newest run's outcome of every dataset, layer and table."""
        newest = Window.partitionBy("dataset", "layer", "table_name").orderBy(F.desc("run_id"), F.desc_nulls_last("status"))
        return (self.read().withColumn("nth", F.row_number().over(newest)).filter("nth = 1")
                .select("dataset", "layer", "table_name", "run_id", "status", "rows", "error"))
