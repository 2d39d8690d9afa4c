"""Adapter from the driver's test tables to the energy-reading domain.

``readings`` maps every ``lineitem`` row to one reading: the supplier's
region is the region, the ship date the timestamp, the return flag the
profile, the extended price the energy (missing on line number 7) and the
quantity the number of metering sites.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import input_bytes, scratch_path
from ..spec import DatasetSpec
from .delimited import write_delimited

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


# Schemas of the test tables this package reads, as Spark
# reads them. An explicit schema spares a footer-reading job per scan.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
}


# Dimension files up to this size are broadcast; larger ones are joined by a shuffle.
BROADCAST_BYTES = 16 << 20


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def supplier_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s_suppkey, region) through nation and region, hinted as the side to build.

    The hint follows the listed size of the dimension files (no job): Spark's own estimate of
    their join is the product of their sizes, by which it would rather build on the fact table.
    """
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = load(spark, sf_dir, "region").select("r_regionkey", "r_name")
    supplier = load(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation_region = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    geo = (supplier.join(F.broadcast(nation_region), F.col("s_nationkey") == F.col("n_nationkey"))
           .select("s_suppkey", F.col("r_name").alias("region")))
    files = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("supplier", "nation", "region")]
    small = input_bytes(spark, files) <= BROADCAST_BYTES
    return F.broadcast(geo) if small else geo.hint("shuffle_hash")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(region, horodate, profil, total_energie_soutiree_wh, nb_points_soutirage)."""
    li = load(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_returnflag", "l_linenumber", "l_extendedprice", "l_quantity")
    geo = supplier_regions(spark, sf_dir)
    return (li.join(geo, F.col("l_suppkey") == F.col("s_suppkey"))
            .select(
                F.col("region"),
                F.col("l_shipdate").alias("horodate"),
                F.col("l_returnflag").alias("profil"),
                F.when(F.col("l_linenumber") == 7, F.lit(None).cast("double"))
                 .otherwise(F.col("l_extendedprice")).alias("total_energie_soutiree_wh"),
                F.col("l_quantity").cast("bigint").alias("nb_points_soutirage")))


# SQL text of the same adapter, for DuckDB oracles (tables pre-registered).
READINGS_SQL = """
SELECT r_name AS region,
       l_shipdate AS horodate,
       l_returnflag AS profil,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END AS total_energie_soutiree_wh,
       CAST(l_quantity AS BIGINT) AS nb_points_soutirage
FROM lineitem
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
"""


# Raw headers of the readings landing files, as a source system spells them;
# standardisation maps them back to the readings column names.
LANDING_HEADERS = {
    "region": "Région",
    "horodate": "Horodate",
    "profil": "Profil",
    "total_energie_soutiree_wh": "Total énergie soutirée (Wh)",
    "nb_points_soutirage": "Nb points soutirage",
}
LANDING_NA_TOKEN = "NA"


def write_readings_landing(spark: SparkSession, sf_dir: str, typed_timestamp: bool = False,
                           row_cap: int = -1) -> DatasetSpec:
    """Write ``readings`` as ';'-separated landing files; return their spec.

    Missing values are written as a pandas-style NA token. The timestamp is
    typed ``timestamp_ntz`` when ``typed_timestamp``, else kept as text (the
    cleaned layer parses it only where a year is needed).
    """
    df = readings(spark, sf_dir)
    renamed = df.select([F.col(c).alias(h) for c, h in LANDING_HEADERS.items()])
    path = write_delimited(renamed, scratch_path(spark, "landing-readings"),
                           sep=";", na_token=LANDING_NA_TOKEN)
    types = ((LANDING_HEADERS["total_energie_soutiree_wh"], "double"),
             (LANDING_HEADERS["nb_points_soutirage"], "bigint"))
    if typed_timestamp:
        types += ((LANDING_HEADERS["horodate"], "timestamp_ntz"),)
    return DatasetSpec(name="readings", location=path,
                       description="Energy readings per region and period (test tables)",
                       sep=";", columns=types, row_cap=row_cap)


def write_table_landing(spark: SparkSession, sf_dir: str, table: str) -> DatasetSpec:
    """Write one test table as ';'-separated landing files with inferred types."""
    path = write_delimited(load(spark, sf_dir, table), scratch_path(spark, f"landing-{table}"), sep=";")
    return DatasetSpec(name=table, location=path, description=f"test table {table}",
                       sep=";", infer_types=True)
