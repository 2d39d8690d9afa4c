"""Full-row dedupe of a new batch against all rows stored before.

The history of a dataset is an index of row keys: a table bucketed by the key
and partitioned by batch. A new batch is grouped by itself, then joined with
the index bucket by bucket. Spark reads the bucketed index in place (only the
batch is shuffled, to the index's buckets), so the stored rows are neither
grouped nor moved again. The index holds 16 bytes a distinct row.

A key is the first 128 bits of the SHA-256 of the row in a canonical spelling
(NULL = NULL, NaN = NaN, 0.0 = -0.0), so equal keys mean equal rows. Every key is
recorded under the first batch that brought it. Running a batch again, after a
failure or by mistake, ignores its own entries and replaces them: the result is
that of one run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.catalog import TableStore

KEY, SEEN, BATCH, BUCKET = "__strata_key", "__strata_seen", "batch", "bucket"
BUCKETS = 256


def _spelled(c: Column, kind: T.DataType) -> Column:
    """Text that is equal exactly for equal values."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(c == 0, F.lit("0.0")).otherwise(c.cast("string"))
    if isinstance(kind, T.TimestampType):  # text would depend on the session's zone
        return F.unix_micros(c).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        raise TypeError(f"a row key over {kind.simpleString()} is not defined: flatten the column first")
    return c.cast("string")


def row_key(df: DataFrame, columns: list[str] | None = None) -> Column:
    """16 bytes that are equal exactly for rows equal in all ``columns``."""
    parts = []
    for name in columns or df.columns:
        text = _spelled(F.col(f"`{name}`"), df.schema[name].dataType)
        # No branch holds the text, so it is spelled once a row.
        parts.append(F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.substring(F.unhex(F.sha2(F.concat_ws("", *parts), 256)), 1, 16)


def key_bucket(key: Column, buckets: int) -> Column:
    """A number of the key's own, for states kept by hash bucket."""
    return F.pmod(F.conv(F.hex(F.substring(key, 1, 4)), 16, 10).cast("bigint"), F.lit(buckets)).cast("int")


def set_names(store: TableStore, table: str, **lists: list[str]) -> None:
    """Keep lists of names with a table, as properties."""
    spelled = ", ".join("'strata.{}' = '{}'".format(k, "\u001f".join(v).replace("\\", "\\\\").replace("'", "\\'"))
                        for k, v in lists.items())
    store.spark.sql(f"ALTER TABLE {store.qualify(table)} SET TBLPROPERTIES ({spelled})")


def get_names(store: TableStore, table: str, key: str) -> list[str] | None:
    rows = store.spark.sql(f"SHOW TBLPROPERTIES {store.qualify(table)}").collect()
    text = next((r["value"] for r in rows if r["key"] == f"strata.{key}"), None)
    return None if text is None else [n for n in text.split("\u001f") if n]


class RowHistory:
    """The index of a dataset's row keys."""

    def __init__(self, store: TableStore, dataset: str, buckets: int = BUCKETS) -> None:
        self.store, self.buckets = store, buckets
        self.table = f"history_{dataset}"

    def exists(self) -> bool:
        return self.store.exists(self.table)

    def keys(self, without: str | None = None) -> DataFrame:
        """(key, batch) of everything recorded, but for one batch."""
        found = self.store.read(self.table)
        return found if without is None else found.filter(F.col(BATCH) != without)

    def batches(self) -> list[str]:
        if not self.exists():
            return []
        rows = self.store.spark.sql(f"SHOW PARTITIONS {self.store.qualify(self.table)}").collect()
        return sorted(r[0].split("=", 1)[1] for r in rows)

    def check_columns(self, columns: list[str]) -> None:
        """Keys over other columns cannot be compared."""
        if not self.exists():
            return
        known = get_names(self.store, self.table, "columns")
        if known is not None and known != columns:
            raise ValueError(f"the history is over columns {known}, the batch has {columns}")

    def mark_seen(self, rows: DataFrame, batch: str) -> DataFrame:
        """``rows`` (with ``KEY``) and ``SEEN``: whether another batch brought the row before."""
        if not self.exists():
            return rows.withColumn(SEEN, F.lit(False))
        known = self.keys(without=batch).select(F.col(KEY), F.lit(True).alias(SEEN))
        return rows.join(known, KEY, "left").withColumn(SEEN, F.coalesce(SEEN, F.lit(False)))

    def record(self, fresh: DataFrame, batch: str, columns: list[str]) -> None:
        """Put the keys of a batch's unseen rows on record, replacing its earlier entries."""
        name = self.store.qualify(self.table)
        if not self.exists():
            (fresh.select(KEY).limit(0).withColumn(BATCH, F.lit(batch)).write.format(self.store.fmt)
             .partitionBy(BATCH).bucketBy(self.buckets, KEY).saveAsTable(name))
            set_names(self.store, self.table, columns=columns)
        # One task a bucket; the named partition alone is replaced. Keys lie in no order within a
        # file: the join sorts what it reads in any case, and sorting files by bucket and key
        # would work the bucket out anew at every comparison.
        self.store.spark.sql(
            f"INSERT OVERWRITE TABLE {name} PARTITION ({BATCH} = '{batch}') SELECT {KEY} FROM {{entries}}",
            entries=fresh.select(KEY).repartition(self.buckets, KEY))
        self.store.spark.sql(f"REFRESH TABLE {name}")
