"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver's test tables (through the ``readings``
adapter or directly) over their whole extent; those that exercise sinks
write below the session's shared scratch folder and return a frame that
reads the written data back. Clock columns and scratch paths are left out
of returned frames, so results are reproducible.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.columns import (cast_measures, derive_year, drop_audit_columns,
                                standardize_column_names)
from .functions.scoring import (carbon_score_emission, carbon_score_normalised, categorize,
                                register_sql_functions)
from .incremental import states
from .incremental.batches import SILVER_BATCH, Incremental
from .operators import cells, chartdata, kpi, privacy, quality, windows
from .plans.pipeline import SILVER_CLOCK_COLUMNS, gold_frames, run_silver, silver_plan
from .session import input_bytes, scratch_path
from .sources import fixtures, partitions
from .sources.catalog import TableStore, table_profile, write_gold
from .sources.delimited import add_audit_columns, read_delimited
from .sources.ingest import ingest_all, ingestion_report
from .sources.rejects import ingest_with_rejects, reject_summary
from .sources.run_log import RunLog
from .sources.schema_store import SchemaStore
from .spec import DatasetSpec, Roles, detect_column
from .streaming.bronze_stream import ingest_stream

ROLES = Roles()
E, S = ROLES.measure, ROLES.sites
MIN_SITES = privacy.DEFAULT_MIN_SITES
ROW_CAP = 15_000
PARTITION_YEAR = 1996
SLICE_BYTES = 16 << 20  # of an input file, behind one task or bucket of a table written by queries
TOP_K = 3


# --- shared inputs ----------------------------------------------------------

def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.readings(spark, sf_dir)


def readings_with_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_year(readings(spark, sf_dir), ROLES.timestamp, ROLES.year)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned layer built lazily from readings (no write, no clock columns)."""
    return silver_plan(readings(spark, sf_dir), ROLES, MIN_SITES,
                       with_clock=False, observe=False).frame


def _region_totals(spark: SparkSession, sf_dir: str, by: list[str]) -> DataFrame:
    return readings_with_year(spark, sf_dir).groupBy(*by).agg(
        F.round(F.sum(E), 2).alias("energy_total"))


# --- sources and sinks --------------------------------------------------------

def q_csv_scan_semicolon(spark, sf_dir):
    spec = fixtures.write_readings_landing(spark, sf_dir, typed_timestamp=True)
    return standardize_column_names(read_delimited(spark, spec))


def q_row_cap(spark, sf_dir):
    spec = fixtures.write_readings_landing(spark, sf_dir, row_cap=ROW_CAP)
    return read_delimited(spark, spec).agg(F.count(F.lit(1)).alias("n_rows"))


def q_csv_quoted_cells(spark, sf_dir):
    # quotes, separators and line breaks inside quoted cells
    cell = F.concat(F.lit('"\"\"'), F.col("c_name"), F.lit('\"\";\n'), F.col("c_mktsegment"), F.lit('"'))
    path = scratch_path(spark, "landing-quoted")
    rows = fixtures.load(spark, sf_dir, "customer").select(
        F.concat_ws(";", "c_custkey", cell, "c_nationkey").alias("value"))
    rows.write.option("lineSep", "\n").text(path)
    spec = DatasetSpec("quoted", path, header=False, multi_line=True, infer_types=False,
                       columns=(("_c0", "bigint"), ("_c2", "int")))
    return read_delimited(spark, spec).toDF("c_custkey", "c_quoted", "c_nationkey")


def _raw_lines(spark, sf_dir, header, line, table="customer"):
    """A table's rows as raw landing lines below a header; returns the folder."""
    path = scratch_path(spark, "landing-lines")
    (fixtures.load(spark, sf_dir, table).select(line.alias(header))
     .write.option("header", True).option("sep", "\u0001").option("quote", "").csv(path))
    return path


def q_csv_ragged_rows(spark, sf_dir):
    # a third of the records is short, a third has a field too many (lenient scan);
    # whole numbers are written with a decimal point
    key = F.concat(F.col("c_custkey").cast("string"), F.lit(".0"))
    kind = F.col("c_nationkey") % 3
    line = (F.when(kind == 0, key).when(kind == 1, F.concat_ws(";", key, "c_name", F.lit("x")))
            .otherwise(F.concat_ws(";", key, "c_name")))
    spec = DatasetSpec("ragged", _raw_lines(spark, sf_dir, "c_custkey;c_name", line),
                       columns=(("c_custkey", "bigint"),))
    return read_delimited(spark, spec, strict=False, bad_cells_column="bad_cells")


def q_csv_long_cells(spark, sf_dir):
    # quoted cells of 100,000 characters; a third of the records is short, a third has a field too many
    note = F.concat(F.lit('"'), F.repeat(F.lit('x""; '), 20_000), F.lit('"'))
    kind = F.col("s_suppkey") % 3
    parts = [F.col("s_suppkey").cast("string"), note]
    line = (F.when(kind == 0, F.concat_ws(";", *parts))
            .when(kind == 1, F.concat_ws(";", *parts, "s_name", F.lit("surplus")))
            .otherwise(F.concat_ws(";", *parts, "s_name")))
    path = _raw_lines(spark, sf_dir, "s_suppkey;note;s_name", line, "supplier")
    spec = DatasetSpec("long", path, columns=(("s_suppkey", "bigint"),))
    return read_delimited(spark, spec, strict=False, bad_cells_column="bad_cells").select(
        "s_suppkey", F.char_length("note").cast("bigint").alias("note_chars"),
        F.md5("note").alias("note_md5"), "s_name", "bad_cells")


def q_csv_header_order(spark, sf_dir):
    # a second file with the columns in another order must fail, one in the same order must not
    store = TableStore.scratch(spark)
    specs = []
    for name, second in (("swapped", ["c_name", "c_custkey"]), ("same", ["c_custkey", "c_name"])):
        path = scratch_path(spark, f"landing-{name}")
        customer = fixtures.load(spark, sf_dir, "customer")
        half = F.col("c_custkey") % 2
        for n, columns in ((0, ["c_custkey", "c_name"]), (1, second)):
            (customer.filter(half == n).select(*columns).write.mode("append")
             .option("sep", ";").option("header", True).csv(path))
        specs.append(DatasetSpec(name, path))
    return ingest_all(store, specs).select("dataset", "status", "rows")


def q_ingest_audit_columns(spark, sf_dir):
    spec = fixtures.write_readings_landing(spark, sf_dir, typed_timestamp=True)
    store = TableStore.scratch(spark)
    ingest_all(store, [spec])
    bronze = store.read("bronze_readings")
    return standardize_column_names(
        bronze.drop("_ingestion_timestamp", "_ingestion_date", "_source_url"))


def q_ingest_stream_available_now(spark, sf_dir):
    spec = fixtures.write_readings_landing(spark, sf_dir, typed_timestamp=True)
    store = TableStore.scratch(spark)
    checkpoint = scratch_path(spark, "ckpt-stream")
    ingest_stream(store, spec, checkpoint=checkpoint)
    ingest_stream(store, spec, checkpoint=checkpoint)  # a rerun appends nothing new
    bronze = store.read("bronze_readings")
    return standardize_column_names(
        bronze.drop("_ingestion_timestamp", "_ingestion_date", "_source_url"))


def q_ingest_stream_second_batch(spark, sf_dir):
    # Half of the rows land, are ingested, then the other half lands: the
    # default checkpoint must carry on and pick up the second file only.
    spec = fixtures.write_readings_landing(spark, sf_dir, typed_timestamp=True)
    rows = (spark.read.option("sep", spec.sep).option("header", True).option("escape", '"')
            .csv(spec.location))
    landing = replace(spec, location=scratch_path(spark, "landing-two-batches"))
    store = TableStore.scratch(spark)
    half = F.pmod(F.xxhash64(*rows.columns), F.lit(2))
    for n in (0, 1):
        (rows.filter(half == n).write.mode("append").option("sep", spec.sep)
         .option("header", True).option("escape", '"').csv(landing.location))
        ingest_stream(store, landing)
    bronze = store.read("bronze_readings")
    return standardize_column_names(
        bronze.drop("_ingestion_timestamp", "_ingestion_date", "_source_url"))


def q_table_overwrite_roundtrip(spark, sf_dir):
    store = TableStore.scratch(spark)
    customer = fixtures.load(spark, sf_dir, "customer")
    store.write(customer, "customer_copy")
    # Overwrite a table with a plan that reads it, changing its schema.
    current = store.read("customer_copy")
    store.write(current.withColumn("version", F.lit("v2")), "customer_copy")
    return store.read("customer_copy")


def q_partitioned_write_pruned_read(spark, sf_dir):
    store = TableStore.scratch(spark)
    orders = fixtures.load(spark, sf_dir, "orders")
    store.write(orders.withColumn("o_year", F.year("o_orderdate")), "orders_by_year",
                partition_by=["o_year"])
    return store.read("orders_by_year").filter(F.col("o_year") == PARTITION_YEAR)


def _ingest_three(spark, sf_dir):
    store = TableStore.scratch(spark)
    specs = [fixtures.write_readings_landing(spark, sf_dir),
             fixtures.write_table_landing(spark, sf_dir, "customer"),
             DatasetSpec(name="missing", location=scratch_path(spark, "no-such-landing"))]
    return store, ingest_all(store, specs)


def q_ingestion_run_log(spark, sf_dir):
    _, log = _ingest_three(spark, sf_dir)
    return log.select("dataset", "table_name", "rows", "columns", "status", "error_class")


def q_ingestion_report(spark, sf_dir):
    _, log = _ingest_three(spark, sf_dir)
    return ingestion_report(log).select("dataset", "status", "rows_text")


def q_table_profile(spark, sf_dir):
    store, _ = _ingest_three(spark, sf_dir)
    names = [store.qualify(t) for t in ("bronze_readings", "bronze_customer", "bronze_missing")]
    prof = table_profile(spark, names)
    return prof.withColumn("table_name", F.substring_index("table_name", ".", -1))


def q_gold_write_log(spark, sf_dir):
    # Gold reads the stored Silver table; without category and profile the
    # category KPI cannot be built and is logged as SKIP, as is a ranking without
    # a region column; a table whose job fails is logged and harms no other.
    store = TableStore.scratch(spark)
    store.write(silver(spark, sf_dir), "silver_readings", partition_by=[ROLES.year])
    frame = store.read("silver_readings").drop(ROLES.category, ROLES.profile)
    frames = gold_frames(frame, ROLES)
    frames["gold_without_region"] = kpi.kpi_top_regions(frame.drop(ROLES.region), ROLES)
    frames["gold_failing"] = frame.select(F.raise_error(F.lit("no such figure")).alias("x"))
    return write_gold(store, frames).drop("error")


def q_silver_pipeline(spark, sf_dir):
    store = TableStore.scratch(spark)
    ingest_all(store, [fixtures.write_readings_landing(spark, sf_dir)])
    run_silver(store, "readings", ROLES, MIN_SITES)
    return store.read("silver_readings").drop(*SILVER_CLOCK_COLUMNS)


def q_silver_detected_roles(spark, sf_dir):
    # foreign headers: the roles are bound by keyword, so scoring and suppression still happen
    foreign = {"region": "sales_region", "horodate": "reading_date", "profil": "client_profil",
               E: "energy_used", S: "number_of_sites"}
    store = TableStore.scratch(spark)
    store.write(readings(spark, sf_dir).withColumn("horodate", F.col("horodate").cast("string"))
                .withColumnsRenamed(foreign), "bronze_foreign")
    run_silver(store, "foreign", None, MIN_SITES)
    return (store.read("silver_foreign").drop(*SILVER_CLOCK_COLUMNS)
            .withColumnsRenamed({v: k for k, v in foreign.items()}))


def q_silver_quality_report(spark, sf_dir):
    store = TableStore.scratch(spark)
    ingest_all(store, [fixtures.write_readings_landing(spark, sf_dir)])
    return run_silver(store, "readings", ROLES, MIN_SITES).quality_report


def q_silver_pipeline_metrics(spark, sf_dir):
    store = TableStore.scratch(spark)
    ingest_all(store, [fixtures.write_readings_landing(spark, sf_dir)])
    m = run_silver(store, "readings", ROLES, MIN_SITES).metrics
    keys = ["rows_in", "rows_distinct", "rows_deduplicated", "rows_out", "rows_suppressed"]
    return spark.createDataFrame([tuple(int(m[k]) for k in keys)],
                                 ", ".join(f"{k} bigint" for k in keys))


# --- batch by batch -----------------------------------------------------------

LATE_YEAR = 1996


def _batches(spark, sf_dir):
    """Two batches of readings; the second brings a late year and rows the first brought already."""
    rows = readings(spark, sf_dir)
    late = F.year("horodate") == LATE_YEAR
    return rows.filter(~late), rows.filter(late | (F.col(S) % 3 == 0))


def _fed(spark, sf_dir, gold=False):
    lineitem = f"{sf_dir.rstrip('/')}/lineitem.parquet"
    buckets = max(16, -(-input_bytes(spark, [lineitem]) // SLICE_BYTES))
    feed = Incremental(TableStore.scratch(spark), "readings", ROLES, MIN_SITES, buckets=buckets)
    for n, batch in enumerate(_batches(spark, sf_dir)):
        feed.run_batch(batch, f"batch-{n}", gold)
    return feed


def q_dedup_against_history(spark, sf_dir):
    feed = _fed(spark, sf_dir)
    return feed.store.read(feed.silver).drop(*SILVER_CLOCK_COLUMNS, SILVER_BATCH)


def q_dedup_history_metrics(spark, sf_dir):
    return _fed(spark, sf_dir).metrics()


def q_quality_report_merged(spark, sf_dir):
    return _fed(spark, sf_dir).quality_report()


def _incremental_gold(spark, sf_dir):
    return states.gold_from_base(_fed(spark, sf_dir, gold=True).store, "readings", ROLES)


def q_kpi_region_year_incremental(spark, sf_dir):
    return _incremental_gold(spark, sf_dir)["gold_region_year"]


def q_kpi_national_trend_incremental(spark, sf_dir):
    # from the tables that the second batch left; total rounded to cents as above
    store = _fed(spark, sf_dir, gold=True).store
    return kpi.kpi_national_trend(store.read("gold_base_readings"), ROLES, total_decimals=2, ordered=False)


def q_kpi_category_share_incremental(spark, sf_dir):
    return _incremental_gold(spark, sf_dir)["gold_category_share"]


def q_kpi_top_regions_incremental(spark, sf_dir):
    store = _fed(spark, sf_dir, gold=True).store
    return store.read("gold_top_regions_readings").drop("_gold_timestamp")


def _orders_by_year(spark, sf_dir, slices=None):
    """Orders in a partition a year, from tasks of bounded size: every task sorts what it writes."""
    store = TableStore.scratch(spark)
    orders = fixtures.load(spark, sf_dir, "orders").withColumn("o_year", F.year("o_orderdate"))
    orders = _balanced(orders, "o_year") if slices is None else orders.repartition(slices)
    partitions.write_partitions(store, orders, "orders_by_year", "o_year")
    return store


def _balanced(df, column):
    """Few tasks a value, none far above the advisory size: a large value is dealt to several."""
    return df.hint("rebalance", column)


def q_partition_overwrite_one_year(spark, sf_dir):
    # one year is corrected by a plan that reads the table itself; the others stay
    store = _orders_by_year(spark, sf_dir)
    year = store.read("orders_by_year").filter(F.col("o_year") == PARTITION_YEAR)
    year = _balanced(year.withColumn("o_totalprice", -F.col("o_totalprice")), "o_year")
    partitions.write_partitions(store, year, "orders_by_year", "o_year")
    partitions.drop_superseded(store, "orders_by_year")
    return store.read("orders_by_year")


def q_compaction_files_per_year(spark, sf_dir):
    orders = f"{sf_dir.rstrip('/')}/orders.parquet"
    slices = max(12, -(-input_bytes(spark, [orders]) // SLICE_BYTES))
    store = _orders_by_year(spark, sf_dir, slices)
    before = partitions.files_per_partition(store, "orders_by_year")
    target = 8 * max(size for sizes in before.values() for size in sizes)
    partitions.compact(store, "orders_by_year", target)
    after = partitions.files_per_partition(store, "orders_by_year")
    rows = [(year, len(sizes) <= 2 * sum(before[year]) // target + 1 < len(before[year]))
            for year, sizes in after.items()]
    bounded = spark.createDataFrame(rows, "o_year int, bounded boolean")
    counts = store.read("orders_by_year").groupBy("o_year").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("sum_keys"))
    return counts.join(F.broadcast(bounded), "o_year")  # a row a year


def q_csv_rejects(spark, sf_dir):
    # a quarter of the records each: sound, with a surplus field, with a cell that is no number,
    # with a quote that never closes
    kind = F.col("c_custkey") % 4
    key, name = F.col("c_custkey").cast("string"), F.col("c_name")
    line = (F.when(kind == 0, F.concat_ws(";", key, name, F.col("c_nationkey").cast("string")))
            .when(kind == 1, F.concat_ws(";", key, name, F.lit("7"), F.lit("surplus")))
            .when(kind == 2, F.concat_ws(";", key, name, F.concat(F.lit("none of "), key)))
            .otherwise(F.concat_ws(";", key, F.concat(F.lit('"'), name))))
    spec = DatasetSpec("customer", _raw_lines(spark, sf_dir, "c_custkey;c_name;c_nationkey", line),
                       columns=(("c_custkey", "bigint"), ("c_nationkey", "int")))
    store = TableStore.scratch(spark)
    ingest_with_rejects(store, spec)
    kept = store.read("bronze_customer").select(
        F.lit("kept").alias("outcome"), F.concat_ws(";", "c_custkey", "c_name", "c_nationkey").alias("text"))
    lost = store.read("rejects_customer").select(
        F.col("_reason").alias("outcome"),
        F.coalesce("_record", F.concat_ws(";", F.col("_cells")["c_custkey"], F.col("_cells")["c_name"],
                                          F.col("_cells")["c_nationkey"])).alias("text"))
    return kept.union(lost)


def q_csv_reject_summary(spark, sf_dir):
    # every column of a record may be at fault
    line = F.concat_ws(";", F.col("c_custkey").cast("string"),
                       F.when(F.col("c_custkey") % 3 == 0, "x").otherwise(F.col("c_nationkey").cast("string")),
                       F.when(F.col("c_custkey") % 6 == 0, "y").otherwise(F.col("c_acctbal").cast("string")))
    spec = DatasetSpec("customer", _raw_lines(spark, sf_dir, "c_custkey;c_nationkey;c_acctbal", line),
                       columns=(("c_custkey", "bigint"), ("c_nationkey", "int"), ("c_acctbal", "double")))
    store = TableStore.scratch(spark)
    ingest_with_rejects(store, spec)
    return reject_summary(store.read("rejects_customer"))


def q_schema_drift(spark, sf_dir):
    # the landing files of a second day have lost a column, moved one and gained one; the types
    # of those that stayed are not inferred again
    store = TableStore.scratch(spark)
    schemas = SchemaStore(store)
    customer = fixtures.load(spark, sf_dir, "customer")
    for columns in (["c_custkey", "c_name", "c_acctbal"], ["c_custkey", "c_acctbal", "c_nationkey"]):
        path = scratch_path(spark, "landing-drift")
        customer.select(*columns).write.option("sep", ";").option("header", True).csv(path)
        ingest_all(store, [DatasetSpec("customer", path, infer_types=True)], schemas=schemas)
    return schemas.drift("customer")


def q_schema_store_scan(spark, sf_dir):
    # the second ingestion takes the stored types
    store = TableStore.scratch(spark)
    schemas = SchemaStore(store)
    spec = fixtures.write_table_landing(spark, sf_dir, "customer")
    for _ in range(2):
        ingest_all(store, [spec], schemas=schemas)
    bronze = store.read("bronze_customer")
    return bronze.drop(*[c for c in bronze.columns if c.startswith("_")])


def q_run_log_durable(spark, sf_dir):
    # two runs, the second recorded twice, as after a retry
    store = TableStore.scratch(spark)
    log = RunLog(store)
    specs = [fixtures.write_table_landing(spark, sf_dir, "customer"),
             DatasetSpec(name="missing", location=scratch_path(spark, "no-such-landing"))]
    for run in ("run-1", "run-2", "run-2"):
        log.record(run, "bronze", ingest_all(store, specs))
    return log.read().select("run_id", "layer", "dataset", "table_name", "status", "rows", "error_class")


def q_row_cap_first_rows(spark, sf_dir):
    # the first records in file order stay, on every run the same
    path = scratch_path(spark, "landing-ordered")
    rows = fixtures.load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    (rows.repartitionByRange(8, "l_orderkey").sortWithinPartitions("l_orderkey", "l_linenumber", "l_partkey")
     .write.option("sep", ";").option("header", True).csv(path))
    spec = DatasetSpec("ordered", path, row_cap=1000, columns=(
        ("l_orderkey", "bigint"), ("l_linenumber", "int"), ("l_partkey", "bigint")))
    return read_delimited(spark, spec)


# --- cell suppression -----------------------------------------------------------

def _kpis_with_small_cell(spark, sf_dir):
    """The KPIs, and a threshold that makes the cell of the fewest sites the only sensitive one."""
    store = TableStore.scratch(spark)
    store.write(kpi.kpi_region_year(silver(spark, sf_dir), ROLES, ordered=False), "cells")
    k1 = store.read("cells")
    least = k1.agg(F.min("sites_total")).first()[0] or 0
    return k1, least + 1


def q_kpi_cells_suppressed(spark, sf_dir):
    # one more cell of that year is hidden, or the year's total would give the small one away
    k1, threshold = _kpis_with_small_cell(spark, sf_dir)
    figures = ["energy_total", "energy_mean", "n_records", "sites_total", "energy_per_site"]
    return cells.suppress_cells(k1, ROLES.region, ROLES.year, "sites_total", threshold, figures)


def q_kpi_cells_rectangles(spark, sf_dir):
    # with totals per region published, too, four cells are hidden
    k1, threshold = _kpis_with_small_cell(spark, sf_dir)
    return cells.hidden_cells(k1, ROLES.region, ROLES.year, "sites_total", threshold, row_totals=True)


# --- projection, expressions ------------------------------------------------

def q_drop_audit_columns(spark, sf_dir):
    spec = DatasetSpec(name="readings", location="test-tables", description="readings")
    return drop_audit_columns(add_audit_columns(readings(spark, sf_dir), spec))


def q_standardize_column_names(spark, sf_dir):
    raw = readings(spark, sf_dir).toDF(*fixtures.LANDING_HEADERS.values())
    return standardize_column_names(raw)


def q_cast_measures(spark, sf_dir):
    li = fixtures.load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.col("l_quantity").cast("string").alias("l_quantity"),
        F.col("l_extendedprice").cast("string").alias("l_extendedprice"))
    return cast_measures(li, doubles=["l_extendedprice"], longs=["l_quantity"])


def q_detect_column(spark, sf_dir):
    df = readings(spark, sf_dir)
    bound = {
        "measure": detect_column(df, "energie", "conso"),
        "sites": detect_column(df, "points", "sites"),
        "area": detect_column(df, "region"),
        "period": detect_column(df, "horodate", "date"),
    }
    return df.select([F.col(c).alias(role) for role, c in bound.items()])


def q_derive_year(spark, sf_dir):
    return readings_with_year(spark, sf_dir)


def q_latest_year(spark, sf_dir):
    return kpi.latest_year(readings(spark, sf_dir), ROLES)


def q_latest_year_filter(spark, sf_dir):
    return kpi.latest_year_rows(readings(spark, sf_dir), ROLES)


# --- deduplication, quality, privacy -----------------------------------------

def q_dedup_full_row(spark, sf_dir):
    return quality.dedup_full_row(readings(spark, sf_dir))


def q_dedup_metrics(spark, sf_dir):
    return quality.dedup_metrics(readings(spark, sf_dir))


def q_dq_null_check(spark, sf_dir):
    rep = quality.quality_report(readings(spark, sf_dir))
    return rep.filter(F.col("check_name") == quality.NULL_CHECK)


def q_dq_duplicate_check(spark, sf_dir):
    rep = quality.quality_report(readings(spark, sf_dir))
    return rep.filter(F.col("check_name") == quality.DUPLICATE_CHECK)


def q_dq_negative_check(spark, sf_dir):
    rep = quality.quality_report(fixtures.load(spark, sf_dir, "customer"))
    return rep.filter(F.col("check_name") == quality.NEGATIVE_CHECK)


def q_dq_summary(spark, sf_dir):
    return quality.quality_summary(quality.quality_report(readings(spark, sf_dir)))


def q_small_count_suppression(spark, sf_dir):
    return privacy.suppress_small_counts(readings(spark, sf_dir), S, MIN_SITES, audit=True)


def q_suppression_metrics(spark, sf_dir):
    return privacy.suppression_metrics(readings(spark, sf_dir), S, MIN_SITES)


# --- scoring -----------------------------------------------------------------

def q_categorize_consumption(spark, sf_dir):
    r = readings(spark, sf_dir)
    return r.select(E, categorize(E).alias("consumption_category"))


def q_sql_function_categorize(spark, sf_dir):
    register_sql_functions(spark)
    r = readings(spark, sf_dir)
    return r.selectExpr(E, f"categorize_consumption_udf({E}) AS consumption_category",
                        f"compute_carbon_score_udf({E}, {S}) AS carbon_score")


def q_carbon_score_normalised(spark, sf_dir):
    r = readings(spark, sf_dir)
    return r.select(E, S, carbon_score_normalised(E, S).alias("carbon_score"))


def q_carbon_score_emission(spark, sf_dir):
    r = readings(spark, sf_dir)
    return r.select(E, S, carbon_score_emission(E, S).alias("emission_score"))


# --- windows -----------------------------------------------------------------

def q_lag_previous_period(spark, sf_dir):
    yearly = _region_totals(spark, sf_dir, [ROLES.year])
    return windows.lag_previous_period(yearly, ROLES.year, "energy_total", "previous_total")


def q_share_of_total(spark, sf_dir):
    return windows.share_of_total(_region_totals(spark, sf_dir, [ROLES.region]), "energy_total")


def q_rank_desc(spark, sf_dir):
    return windows.rank_desc(_region_totals(spark, sf_dir, [ROLES.region]), "energy_total")


def q_top_k_by_rank(spark, sf_dir):
    ranked = windows.rank_desc(_region_totals(spark, sf_dir, [ROLES.region]), "energy_total")
    return windows.top_k_by_rank(ranked, "ranking", TOP_K)


def q_top_k_per_year(spark, sf_dir):
    totals = _region_totals(spark, sf_dir, [ROLES.region, ROLES.year])
    return windows.top_k_rows(totals, "energy_total", TOP_K, partition_by=[ROLES.year])


def q_rank_desc_unbounded(spark, sf_dir):
    # every line item ranked by price: an input far too large for one task
    li = fixtures.load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return windows.rank_desc_unbounded(li, "l_extendedprice")


def q_rank_desc_large_keys(spark, sf_dir):
    # neighbouring keys past 2^53, which doubles cannot tell apart
    li = fixtures.load(spark, sf_dir, "lineitem").select(
        "l_linenumber", (F.col("l_orderkey") + F.lit(2 ** 60)).alias("big_key"))
    return windows.rank_desc_unbounded(li, "big_key")


def q_rank_desc_null_third(spark, sf_dir):
    # a date key; a third of the rows has none
    li = fixtures.load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_orderkey") % 3 != 0, F.col("l_shipdate").cast("date")).alias("ship_date"))
    return windows.rank_desc_unbounded(li, "ship_date")


def _clashing(df):
    """The rows with columns named like those that window operators work with."""
    names = {"_p": "l_linestatus", "_r": "l_tax", "_s": "l_linenumber", "_o": "l_discount",
             "row": "l_suppkey", "key": "l_partkey", "range": "l_quantity", "spread": "l_returnflag"}
    return df.select("l_orderkey", "l_extendedprice", *[F.col(c).alias(n) for n, c in names.items()])


def q_rank_desc_unbounded_clash(spark, sf_dir):
    return windows.rank_desc_unbounded(_clashing(fixtures.load(spark, sf_dir, "lineitem")), "l_extendedprice")


def q_lag_previous_unbounded_clash(spark, sf_dir):
    # the key has ties, so only what does not depend on their order is returned
    lagged = windows.lag_previous_unbounded(_clashing(fixtures.load(spark, sf_dir, "lineitem")),
                                            "row", "row", "previous")
    return lagged.groupBy("row").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("_s").alias("sum_s"), F.min("_p").alias("min_p"),
        F.max("spread").alias("max_spread"), F.min("previous").alias("least_previous"))


def q_lag_previous_dates(spark, sf_dir):
    # a date key with ties: the pairs (date, previous date) do not depend on the order of ties
    orders = fixtures.load(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
    lagged = windows.lag_previous_unbounded(orders, "order_date", "order_date", "previous_date")
    return lagged.groupBy("order_date", "previous_date").agg(F.count(F.lit(1)).alias("n_rows"))


def q_share_of_total_unbounded(spark, sf_dir):
    orders = fixtures.load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return windows.share_of_total_unbounded(orders, "o_totalprice", decimals=4)


def q_lag_previous_unbounded(spark, sf_dir):
    orders = fixtures.load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return windows.lag_previous_unbounded(orders, "o_orderkey", "o_totalprice", "previous_totalprice")


# --- KPIs ----------------------------------------------------------------------

def q_kpi_region_year(spark, sf_dir):
    return kpi.kpi_region_year(silver(spark, sf_dir), ROLES)


def q_kpi_national_trend(spark, sf_dir):
    # Total rounded to cents: an unrounded floating sum depends on summation order.
    return kpi.kpi_national_trend(silver(spark, sf_dir), ROLES, total_decimals=2)


def q_kpi_category_share(spark, sf_dir):
    return kpi.kpi_category_share(silver(spark, sf_dir), ROLES)


def q_category_fallback_share(spark, sf_dir):
    return kpi.kpi_category_share(silver(spark, sf_dir).drop(ROLES.category), ROLES)


def q_kpi_top_regions(spark, sf_dir):
    return kpi.kpi_top_regions(silver(spark, sf_dir), ROLES)


# --- chart data ------------------------------------------------------------------

def q_chart_region_year_matrix(spark, sf_dir):
    # Charts read the stored KPI table, as the Gold layer leaves it.
    store = TableStore.scratch(spark)
    store.write(kpi.kpi_region_year(silver(spark, sf_dir), ROLES), "gold_region_year")
    return chartdata.chart_region_year_matrix(store.read("gold_region_year"))


def q_chart_trend_series(spark, sf_dir):
    trend = kpi.kpi_national_trend(silver(spark, sf_dir), ROLES, total_decimals=2)
    return chartdata.chart_trend_series(trend)


def q_chart_category_share(spark, sf_dir):
    return chartdata.chart_category_share(kpi.kpi_category_share(silver(spark, sf_dir), ROLES))


def q_chart_region_ranking(spark, sf_dir):
    return chartdata.chart_region_ranking(kpi.kpi_top_regions(silver(spark, sf_dir), ROLES))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
