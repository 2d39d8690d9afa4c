"""Partition-wise overwrite and compaction of catalog tables.

A table written here keeps every partition in one folder of its own, and the
catalog says which. New data for some partitions is first written whole, to
folders nothing reads yet; then a manifest of the planned changes is put beside
it; only then is each partition pointed at its new folder, one catalog change a
partition. A reader sees every partition whole, old or new, at any moment. A
swap that was interrupted is finished from its manifest by ``recover`` (or by
the next write); a write that was interrupted before its manifest has changed
nothing. One writer a table at a time.

Old folders stay until ``drop_superseded``, so running reads are not disturbed.
Everything the driver handles is metadata: partition values, paths, file sizes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..plans.concurrency import run_all
from .catalog import TableStore, location_of, partition_spec, sql_text
from .files import Files

MANIFEST, DONE = "_swap.json", "_swap.done"
TABLE_ID = "strata.table_id"
TARGET_FILE_BYTES = 256 << 20


def data_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(path, bytes) of the data files in a folder."""
    return [(path, size) for path, name, size in Files(spark).children(folder)
            if not name.startswith(("_", "."))]


# --- catalog ----------------------------------------------------------------------------

def _literal(value: object) -> str:
    """A partition value as SQL text."""
    if value is None:
        return "NULL"
    if isinstance(value, (int, float)):
        return str(value)
    return f"'{sql_text(str(value))}'"


def _parts_root(spark: SparkSession, table: str) -> str:
    return location_of(spark, table) + "__parts"


@dataclass(frozen=True)
class Partition:
    value: object
    location: str


def partitions(store: TableStore, table: str) -> list[Partition]:
    """The partitions of a table with one partition column, as the catalog has them."""
    spark, name = store.spark, store.qualify(table)
    column = partition_column(store, table)
    kind = dict(store.read(table).dtypes)[column]
    found = []
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
        text = row[0].split("=", 1)[1]
        if text == "__HIVE_DEFAULT_PARTITION__" or text == "null":
            value = None
        else:
            value = int(text) if kind in ("int", "bigint", "smallint", "tinyint") else unquote(text)
        found.append(Partition(value, location_of(spark, f"{name} {partition_spec(row[0])}")))
    return found


def partition_column(store: TableStore, table: str) -> str:
    columns = [c.name for c in store.spark.catalog.listColumns(store.qualify(table)) if c.isPartition]
    if len(columns) != 1:
        raise ValueError(f"{table} has {len(columns)} partition columns, one is needed")
    return columns[0]


def _create(store: TableStore, df: DataFrame, table: str, column: str) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    store.spark.sql(f"CREATE TABLE {store.qualify(table)} ({columns}) USING {store.fmt} "
                    f"PARTITIONED BY (`{column}`)")


# --- overwrite --------------------------------------------------------------------------

def write_partitions(store: TableStore, df: DataFrame, table: str, column: str,
                     values: list | None = None) -> list:
    """Replace the partitions that ``df`` has rows for; return their values.

    Partitions without rows in ``df`` stay as they are, except those listed in
    ``values``, which become empty. ``df`` may read the table itself. A new
    table is created; a known one must have the same columns.
    """
    spark, name = store.spark, store.qualify(table)
    if not store.exists(table):
        _create(store, df, table, column)
    else:
        recover(store, table)
        have, want = dict(store.read(table).dtypes), dict(df.dtypes)
        if have != want:
            raise ValueError(f"{table} has other columns: {sorted(set(have.items()) ^ set(want.items()))}")
    folder = f"{_parts_root(spark, name)}/{uuid.uuid4().hex}"
    df.write.format(store.fmt).partitionBy(column).save(folder)
    kind = df.schema[column].dataType
    written = {}
    for path, entry, _ in Files(spark).children(folder):
        if entry.startswith(f"{column}="):
            text = unquote(entry.split("=", 1)[1])
            null = text == "__HIVE_DEFAULT_PARTITION__"
            written[None if null else (int(text) if kind.simpleString() in
                                       ("int", "bigint", "smallint", "tinyint") else text)] = path
    for value in values or []:
        if value not in written:  # an empty folder with the table's columns
            path = f"{folder}/empty-{len(written)}"
            df.filter(F.lit(False)).drop(column).write.format(store.fmt).save(path)
            written[value] = path
    _swap(store, table, column, folder, written)
    return list(written)


def _table_id(store: TableStore, table: str) -> str:
    """An id that ends with the table: a plan for a table since replaced is void."""
    name = store.qualify(table)
    rows = store.spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    known = next((r["value"] for r in rows if r["key"] == TABLE_ID), None)
    if known is None:
        known = uuid.uuid4().hex
        store.spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{TABLE_ID}' = '{known}')")
    return known


def _swap(store: TableStore, table: str, column: str, folder: str, places: dict) -> None:
    """Manifest first, then one catalog change a partition, then the mark that it is done."""
    changes = [{"value": v, "path": p} for v, p in places.items()]
    plan = {"table_id": _table_id(store, table), "column": column, "changes": changes}
    Files(store.spark).put(f"{folder}/{MANIFEST}", json.dumps(plan))
    _apply(store, table, folder, column, changes)


def _apply(store: TableStore, table: str, folder: str, column: str, changes: list[dict]) -> None:
    for change in changes:
        _point(store, table, column, change["value"], change["path"])
    Files(store.spark).put(f"{folder}/{DONE}", "")
    store.spark.sql(f"REFRESH TABLE {store.qualify(table)}")


def _point(store: TableStore, table: str, column: str, value: object, path: str) -> None:
    """Let one partition read from ``path``."""
    name, spec = store.qualify(table), f"PARTITION (`{column}` = {_literal(value)})"
    place = sql_text(path)
    store.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {spec} LOCATION '{place}'")
    store.spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION '{place}'")


def recover(store: TableStore, table: str) -> int:
    """Finish swaps whose manifest was written but not carried out; how many there were."""
    files, done = Files(store.spark), 0
    try:
        root = _parts_root(store.spark, store.qualify(table))
    except AnalysisException:
        return 0
    for path, _, _ in files.children(root):
        if files.exists(f"{path}/{MANIFEST}") and not files.exists(f"{path}/{DONE}"):
            plan = json.loads(files.get(f"{path}/{MANIFEST}"))
            if plan["table_id"] != _table_id(store, table):
                continue
            _apply(store, table, path, plan["column"], plan["changes"])
            done += 1
    return done


def drop_superseded(store: TableStore, table: str) -> int:
    """Delete the folders no partition reads any more; call it when no older read runs."""
    spark = store.spark
    recover(store, table)
    used = {p.location.rstrip("/").split("/")[-2] for p in partitions(store, table)}
    old = [(path, name) for path, name, _ in Files(spark).children(_parts_root(spark, store.qualify(table)))
           if name not in used]
    for path, _ in old:
        Files(spark).delete(path)
    return len(old)


# --- compaction -------------------------------------------------------------------------

def bins(sizes: list[int], target: int) -> list[list[int]]:
    """Sizes packed into bins of at most ``target``, largest first, as Spark's scan packs files
    (next fit: any two neighbouring bins hold more than ``target``); a larger one is alone."""
    packed: list[list[int]] = []
    room = -1
    for size in sorted(sizes, reverse=True):
        if size > room:
            packed.append([])
            room = target
        packed[-1].append(size)
        room -= size
    return packed


def compact(store: TableStore, table: str, target_bytes: int = TARGET_FILE_BYTES,
            max_workers: int = 4) -> dict:
    """Rewrite the partitions whose files could be at most half as many; {value: (before, after)}.

    Which partitions, and how many files each, follows from the listed file
    sizes. A partition is rewritten by one job without a shuffle: the scan
    itself packs files into splits of ``target_bytes`` (in a session of its
    own, so no setting of the caller's changes), and a split gives one file.
    Rows and the stage that observed them are not touched. Partitions are
    swapped together, by one manifest.
    """
    spark = store.spark
    column = partition_column(store, table)
    schema = store.read(table).drop(column).schema
    session = spark.newSession()
    for key, value in (("spark.sql.files.maxPartitionBytes", target_bytes),
                       ("spark.sql.files.openCostInBytes", 0), ("spark.sql.files.minPartitionNum", 1)):
        session.conf.set(key, str(value))
    folder = f"{_parts_root(spark, store.qualify(table))}/{uuid.uuid4().hex}"
    jobs: list[Callable] = []
    before = {}
    for n, part in enumerate(partitions(store, table)):
        sizes = [size for _, size in data_files(spark, part.location)]
        if len(sizes) > 1 and len(bins(sizes, target_bytes)) <= len(sizes) // 2:
            before[part.value] = (len(sizes), f"{folder}/part-{n}")
            jobs.append(lambda at=part.location, to=f"{folder}/part-{n}": (
                session.read.format(store.fmt).schema(schema).load(at)
                .write.format(store.fmt).save(to)))
    if not jobs:
        return {}
    run_all(jobs, max_workers)
    _swap(store, table, column, folder, {value: path for value, (_, path) in before.items()})
    return {value: (n, len(data_files(spark, path))) for value, (n, path) in before.items()}


def files_per_partition(store: TableStore, table: str) -> dict:
    """{value: [file bytes]} of a table's partitions."""
    return {p.value: [size for _, size in data_files(store.spark, p.location)]
            for p in partitions(store, table)}
