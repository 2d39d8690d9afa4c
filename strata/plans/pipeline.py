"""Bronze -> Silver -> Gold.

Silver is one Spark job: scan Bronze, drop audit columns, standardise names,
dedupe (the only row-level shuffle), cast, band and score, suppress small
counts, write partitioned by year. The quality report, the dedupe count and
the suppression count are Observations on that same job, taken in its
result stage, so they cost no extra pass and are not double counted when a
lost executor forces a retry.
"""

from __future__ import annotations

import uuid
import warnings
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import (BRONZE_AUDIT_COLUMNS, as_count, as_measure, numeric_columns,
                                 standardized_names, year_expr)
from ..functions.scoring import carbon_score_normalised, categorize
from ..operators import kpi
from ..operators.privacy import AUDIT_COLUMN, DEFAULT_MIN_SITES, keep_condition
from ..operators.quality import N, grouped_rows, metric_exprs, report_from_values
from ..session import scratch_path
from ..sources.catalog import TableStore, write_gold
from ..sources.ingest import ingest_all
from ..sources.partitions import compact
from ..sources.run_log import RunLog, new_run_id
from ..sources.schema_store import SchemaStore
from ..spec import DatasetSpec, Roles, TableName, bind_roles

SILVER_CLOCK_COLUMNS = ("_silver_timestamp", "_silver_date")


@dataclass
class SilverPlan:
    """The lazy Silver frame plus the observations its write will fill."""

    frame: DataFrame
    quality_columns: list[str]
    quality_numeric: list[str]
    quality: Observation | None = None
    suppression: Observation | None = None


def silver_plan(bronze: DataFrame, roles: Roles = Roles(), min_sites: int = DEFAULT_MIN_SITES,
                strict: bool = True, business_tz: str | None = None,
                with_clock: bool = True, observe: bool = True,
                allow_unsuppressed: bool = False) -> SilverPlan:
    """Build the Silver frame from a Bronze frame (nothing runs here).

    Without a sites column small counts cannot be suppressed: that raises,
    unless ``allow_unsuppressed``, which warns instead.

    Dedupe happens on the values as they arrive (before any cast), as the
    quality checks do; casts, year, band and score are then one projection.
    """
    kept = [c for c in bronze.columns if c not in BRONZE_AUDIT_COLUMNS]
    names = standardized_names(kept)
    df = bronze.select([F.col(f"`{old}`").alias(new) for old, new in zip(kept, names)])
    columns, numeric = df.columns, numeric_columns(df)
    types = {f.name: f.dataType for f in df.schema.fields}
    check_suppressible(types, roles, allow_unsuppressed)
    g = grouped_rows(df)
    quality = suppression = None
    if observe:
        quality = Observation(f"silver_quality_{uuid.uuid4().hex[:8]}")
        # Checks describe the deduplicated rows (weight 1); rows_in counts
        # what came in, so rows_in - rows_total is what the dedupe removed.
        g = g.observe(quality, *metric_exprs(columns, numeric, None),
                      F.coalesce(F.sum(N), F.lit(0)).cast("bigint").alias("rows_in"))

    df = silver_rows(g, columns, types, roles, min_sites, strict, business_tz, with_clock)
    if roles.sites in types and observe:
        suppression = Observation(f"silver_suppression_{uuid.uuid4().hex[:8]}")
        df = df.observe(suppression, F.count(F.lit(1)).alias("rows_out"))
    return SilverPlan(df, columns, numeric, quality, suppression)


def silver_rows(rows: DataFrame, columns: list[str], types: dict, roles: Roles, min_sites: int,
                strict: bool = True, business_tz: str | None = None, with_clock: bool = True) -> DataFrame:
    """Distinct rows cast, dated, banded and scored, small counts suppressed; other columns go.

    ``types`` are the columns' types as they arrived.
    """
    out = {c: F.col(c) for c in columns}
    measure = sites = None
    if roles.measure in types:
        measure = out[roles.measure] = as_measure(F.col(roles.measure), strict)
    if roles.sites in types:
        sites = out[roles.sites] = as_count(F.col(roles.sites), types[roles.sites], strict)
    if roles.year and roles.year not in types and roles.timestamp in types:
        out[roles.year] = year_expr(F.col(roles.timestamp), types[roles.timestamp], business_tz, strict)
    if measure is not None and roles.category:
        out[roles.category] = categorize(measure)
    if measure is not None and sites is not None and roles.score:
        out[roles.score] = carbon_score_normalised(measure, sites)
    df = rows.select([expr.alias(name) for name, expr in out.items()])

    extra = {}
    if sites is not None:
        df = df.filter(keep_condition(roles.sites, min_sites))
        extra[AUDIT_COLUMN] = F.lit(min_sites)
    if with_clock:
        extra.update(zip(SILVER_CLOCK_COLUMNS, (F.current_timestamp(), F.current_date())))
    return df.withColumns(extra) if extra else df


def check_suppressible(types: dict, roles: Roles, allow_unsuppressed: bool) -> None:
    """Without a sites column small counts cannot be suppressed."""
    if roles.sites not in types:
        message = f"no column {roles.sites!r}: small counts cannot be suppressed"
        if not allow_unsuppressed:
            raise ValueError(f"{message} (allow_unsuppressed=True keeps the rows)")
        warnings.warn(message, stacklevel=3)


@dataclass
class SilverResult:
    table: str
    quality_report: DataFrame
    metrics: dict = field(default_factory=dict)


def silver_roles(bronze: DataFrame, base: Roles = Roles()) -> Roles:
    """Roles bound to the standardised names of a Bronze frame."""
    kept = [c for c in bronze.columns if c not in BRONZE_AUDIT_COLUMNS]
    return bind_roles(standardized_names(kept), base)


def run_silver(store: TableStore, dataset: str, roles: Roles | None = None,
               min_sites: int = DEFAULT_MIN_SITES, strict: bool = True,
               business_tz: str | None = None, allow_unsuppressed: bool = False,
               compact_bytes: int | None = None) -> SilverResult:
    """Write ``silver_<dataset>`` from ``bronze_<dataset>``, partitioned by year.

    Without ``roles`` they are bound by name, then by keyword. The metrics say
    whether small counts were suppressed. With ``compact_bytes`` the files of each
    year are then packed to about that size.
    """
    bronze = store.read(TableName("bronze", dataset).short)
    roles = roles or silver_roles(bronze)
    plan = silver_plan(bronze, roles, min_sites, strict, business_tz,
                       allow_unsuppressed=allow_unsuppressed)
    target = TableName("silver", dataset).short
    parts = [roles.year] if roles.year and roles.year in plan.frame.columns else None
    store.write(plan.frame, target, partition_by=parts)
    if parts and compact_bytes:
        compact(store, target, compact_bytes)
    q = plan.quality.get
    metrics = {"rows_in": q["rows_in"], "rows_distinct": q["rows_total"],
               "rows_deduplicated": q["rows_in"] - q["rows_total"],
               "suppression_applied": plan.suppression is not None}
    if plan.suppression is not None:
        out = plan.suppression.get["rows_out"]
        metrics.update(rows_out=out, rows_suppressed=q["rows_total"] - out)
    report = report_from_values(store.spark, q, plan.quality_columns, plan.quality_numeric)
    return SilverResult(store.qualify(target), report, metrics)


# Gold table names.
GOLD_TABLES = ("gold_region_year", "gold_national_trend", "gold_category_share", "gold_top_regions")


def gold_frames(silver: DataFrame, roles: Roles = Roles()) -> dict[str, DataFrame | None]:
    """The four KPI frames, unsorted (None where a needed column is missing)."""
    builders = (kpi.kpi_region_year, kpi.kpi_national_trend, kpi.kpi_category_share, kpi.kpi_top_regions)
    return {name: build(silver, roles, ordered=False) for name, build in zip(GOLD_TABLES, builders)}


def run_gold(store: TableStore, dataset: str, roles: Roles | None = None) -> DataFrame:
    """Write the KPI tables of a dataset from one pass over its Silver table.

    The pass leaves one small base table below the scratch folder; the KPIs
    read that.
    """
    silver = store.read(TableName("silver", dataset).short)
    roles = roles or bind_roles(silver.columns)
    base = kpi.gold_base(silver, roles)
    path = scratch_path(store.spark, f"gold-base-{dataset}")
    base.write.parquet(path)
    frames = gold_frames(store.spark.read.schema(base.schema).parquet(path), roles)
    return write_gold(store, {f"{name}_{dataset}": df for name, df in frames.items()})


LAYER_LOG_SCHEMA = "dataset string, layer string, status string, error string"


@dataclass
class PipelineResult:
    """Logs and results per dataset; ``layer_log`` has a row per dataset and layer after Bronze."""

    bronze_log: DataFrame
    silver: dict[str, SilverResult]
    gold_log: dict[str, DataFrame]
    layer_log: DataFrame


def run_pipeline(store: TableStore, specs: list[DatasetSpec], roles: Roles | None = None,
                 min_sites: int = DEFAULT_MIN_SITES, strict: bool = True,
                 allow_unsuppressed: bool = False, compact_bytes: int | None = None,
                 schemas: SchemaStore | None = None, run_log: RunLog | None = None,
                 run_id: str | None = None) -> PipelineResult:
    """Every dataset through all three layers.

    A failed layer is logged, skips the rest for its dataset and leaves the
    other datasets alone. Without ``roles`` each dataset binds its own. With
    ``run_log`` every layer's outcome is stored as soon as it is known, under ``run_id``.
    """
    run_id = run_id or new_run_id()

    def keep(layer: str, rows: DataFrame) -> None:
        if run_log is not None:
            run_log.record(run_id, layer, rows)

    log = ingest_all(store, specs, strict=strict, schemas=schemas)
    keep("bronze", log)
    ok = {r["dataset"] for r in log.filter(F.col("status") == "SUCCESS").select("dataset").collect()}
    silver, gold, layers = {}, {}, []
    for spec in specs:
        if spec.name not in ok:
            continue
        layer = "silver"
        try:
            silver[spec.name] = run_silver(store, spec.name, roles, min_sites, strict,
                                           allow_unsuppressed=allow_unsuppressed,
                                           compact_bytes=compact_bytes)
            note = None if silver[spec.name].metrics["suppression_applied"] else "small counts not suppressed"
            layers.append((spec.name, layer, "SUCCESS" if note is None else "WARNING", note))
            keep(f"silver-{spec.name}", store.spark.createDataFrame(layers[-1:], LAYER_LOG_SCHEMA))
            layer = "gold"
            gold[spec.name] = run_gold(store, spec.name, roles)
            keep(f"gold-{spec.name}", gold[spec.name].withColumn("dataset", F.lit(spec.name)))
            layers.append((spec.name, layer, "SUCCESS", None))
        except Exception as exc:  # noqa: BLE001 - recorded in the layer log
            layers.append((spec.name, layer, "FAILED", str(exc)))
            keep(f"{layer}-{spec.name}", store.spark.createDataFrame(layers[-1:], LAYER_LOG_SCHEMA))
    return PipelineResult(log, silver, gold, store.spark.createDataFrame(layers, LAYER_LOG_SCHEMA))
