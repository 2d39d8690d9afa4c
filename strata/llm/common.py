"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import os
import shutil
import string
import tempfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

ROW = "row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure-ASCII values take the fast built-in path."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def packed(df: DataFrame, carry_: list[str] | None = None, **columns: Column) -> DataFrame:
    """The source row as one struct ``row`` beside working columns.

    Working columns then never clash with whatever columns the input has.
    ``carry_`` names the source columns the struct holds (default: all).
    """
    row = F.struct("*") if carry_ is None else F.struct(*[F.col(f"`{c}`") for c in carry_])
    return df.select(row.alias(ROW), *[c.alias(n) for n, c in columns.items()])


def stored(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a frame once below the shared scratch folder and read it back.

    Cuts the lineage: a lost executor re-reads files instead of recomputing.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows an Arrow batch to and from Python; Spark's default of 10,000 whole texts takes tens of
#: megabytes in the JVM and again in the worker, for every task at once.
BATCH_ROWS = 1024
_BATCH_KEY, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


#: A key with more than this part of the rows is dealt out; so there are at most so many.
HOT_SHARE = 10_000


def hot_limit(rows: int, least: int = 1000) -> int:
    """More rows than this make a key hot; fewer than HOT_SHARE keys (or rows / least) can be."""
    return max(least, rows // HOT_SHARE)


def hot_parts(counts: DataFrame, key: str, n: str, rows: int) -> DataFrame:
    """(hot_key, hot_parts) of the hot keys, from a count of every key among ``rows`` rows."""
    limit = hot_limit(rows)
    return counts.filter(F.col(n) > limit).select(
        F.col(key).alias("hot_key"), F.ceil(F.col(n) / limit).cast("int").alias("hot_parts"))


def deal_join(many: DataFrame, one: DataFrame, key: str, spread: str,
              hot: DataFrame | None = None, keys: DataFrame | None = None) -> DataFrame:
    """Inner join on ``key``; a hot key's rows of ``many`` are dealt out by ``spread``, and the
    few rows that ``one`` has for it go to every part.

    ``hot`` comes from ``hot_parts`` where counts are at hand; else the keys are counted here
    (those of ``many``, or given as ``keys``).
    """
    if hot is None:
        source = (many if keys is None else keys).select(key)
        counts = stored(source.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
                        .filter(F.col("n") > hot_limit(0)), "hot-keys")
        hot = hot_parts(counts, key, "n", source.count()) if not counts.isEmpty() else None
        if hot is None:
            return many.join(one, key)
    hot = F.broadcast(hot)
    dealt = (many.join(hot, F.col(key) == F.col("hot_key"), "left")
             .withColumn("deal", F.pmod(F.xxhash64(spread), F.coalesce("hot_parts", F.lit(1))))
             .drop("hot_key", "hot_parts"))
    copies = (one.join(hot, F.col(key) == F.col("hot_key"), "left")
              .withColumn("deal", F.explode(F.sequence(
                  F.lit(0).cast("long"), F.coalesce("hot_parts", F.lit(1)).cast("long") - 1)))
              .drop("hot_key", "hot_parts"))
    return dealt.join(copies, [key, "deal"]).drop("deal")


def ship_library(spark: SparkSession) -> None:
    """Give the Python workers this package, as ``--py-files`` would (once per context), and
    batches of texts a bounded number of rows, unless the session sets one."""
    sc = spark.sparkContext
    if spark.conf.get(_BATCH_KEY) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_KEY, str(BATCH_ROWS))
    if getattr(sc, "_strata_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="strata-lib-"), "strata"),
                                  "zip", os.path.dirname(package), os.path.basename(package))
    sc.addPyFile(archive)
    sc._strata_shipped = True


def release_memory() -> None:
    """Give a Python worker's freed memory back at the end of a task; workers live on."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)
