"""Incremental Bronze ingestion of a landing folder with Structured Streaming.

The same transformation as the batch ingestion (missing-value tokens to
NULL, typed casts, audit columns), run as a file-source stream with an
``availableNow`` trigger: each run picks up only files not seen before,
processes them in bounded micro-batches and stops. The file sink plus the
checkpoint (below the shared scratch folder) make the table append
exactly-once, so a run interrupted by lost executors or a lost driver is
simply started again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..session import scratch_root
from ..sources.catalog import TableStore
from ..sources.delimited import add_audit_columns, cell_types, read_text_cells, typed_cells
from ..spec import DatasetSpec, TableName

#: Lenient streams carry per row how many cells became NULL or were dropped.
BAD_CELLS = "_bad_cells"


def bronze_stream_frame(spark: SparkSession, spec: DatasetSpec, max_files_per_trigger: int = 1000,
                        strict: bool = True, types: dict[str, str] | None = None) -> DataFrame:
    """Streaming frame of the landing folder, typed and with audit columns.

    The scan and the casts are those of the batch ingestion. ``types``
    (default: declared ones, and those inferred from the files there are now)
    must not change between the runs of one table.
    """
    if spec.row_cap is not None and spec.row_cap >= 0:
        raise ValueError("a row cap has no meaning for an incremental stream")
    if types is None:
        types = cell_types(read_text_cells(spark, spec, strict), spec)
    limited = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
    cells = read_text_cells(spark, spec, strict, stream=limited)
    bad = None if strict else BAD_CELLS
    return add_audit_columns(typed_cells(cells, types, strict, bad), spec)


#: Table property naming the table's progress folder.
STREAM_ID = "strata.stream_id"


def stream_checkpoint(store: TableStore, table: str) -> str | None:
    """The one progress folder of a table, named by an id that the table itself carries.

    Two catalogs' tables of one name thus never share progress, and a dropped
    table takes its id with it: the next run starts a new table from all
    landing files. None when the table has no id (yet).
    """
    if not store.exists(table):
        return None
    rows = store.spark.sql(f"SHOW TBLPROPERTIES {store.qualify(table)}").collect()
    ids = [r["value"] for r in rows if r["key"] == STREAM_ID]
    return f"{scratch_root(store.spark)}/strata/stream-checkpoints/{ids[0]}" if ids else None


def _create_streamed(store: TableStore, table: str, frame: DataFrame) -> None:
    """An empty table with a fresh stream id; its files come from the stream alone."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields)
    store.spark.sql(f"CREATE TABLE {table} ({columns}) USING {store.fmt} "
                    f"TBLPROPERTIES ('{STREAM_ID}' = '{uuid.uuid4().hex}')")


def reset_stream(store: TableStore, spec: DatasetSpec) -> None:
    """Drop a streamed table and forget its progress: the next run ingests every landing file."""
    table = store.qualify(TableName("bronze", spec.name).short)
    store.spark.sql(f"DROP TABLE IF EXISTS {table}")


def ingest_stream(store: TableStore, spec: DatasetSpec, checkpoint: str | None = None,
                  max_files_per_trigger: int = 1000, wait: bool = True,
                  strict: bool = True) -> StreamingQuery:
    """Append new landing files to ``bronze_<name>``; stop when caught up.

    Without ``checkpoint`` the progress is kept below the shared scratch folder at a
    place that the table names, so the next run goes on where this one stopped, and a
    table that was dropped (see ``reset_stream``) starts anew.
    A table that exists keeps its column types. ``strict=False`` turns
    unparsable cells into NULL and keeps their number in ``_bad_cells``.
    """
    spark = store.spark
    table = store.qualify(TableName("bronze", spec.name).short)
    types = dict(store.read(table).dtypes) if store.exists(table) else None
    frame = bronze_stream_frame(spark, spec, max_files_per_trigger, strict, types)
    if checkpoint is None:
        if types is None:
            _create_streamed(store, table, frame)
        checkpoint = stream_checkpoint(store, table)
        if checkpoint is None:
            raise ValueError(f"{table} was not written by this stream: name its checkpoint, or reset it")
    query = (frame.writeStream.format(store.fmt)
             .option("checkpointLocation", checkpoint)
             .outputMode("append")
             .trigger(availableNow=True)
             .toTable(table))
    if wait:
        query.awaitTermination()
    return query
