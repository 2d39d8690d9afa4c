"""Command line: run one layer, or all three, for landing datasets.

    python -m strata all --database energy \
        --dataset conso=/landing/conso/ --column "Total énergie soutirée (Wh)=double" \
        --column "Nb points soutirage=bigint"

``bronze`` ingests the datasets and prints the run log, the report and a few
rows of each table; ``silver`` writes the cleaned tables, packs their files and
prints their quality report and metrics; ``gold`` writes the KPI tables and
prints the write log; ``all`` does the three in order. ``batch`` brings the landing files of ``--batch`` into
all layers beside what earlier batches left. ``log`` prints the newest outcome of every dataset.

Options hold for all datasets; ``--set name.option=value`` sets one for a dataset
(sep, description, encoding, row_cap, infer_types, multi_line, header), and
``--column name:header=type`` declares a column of that dataset only. Inferred types and the
outcome of every run are kept in tables beside the data. Column roles are bound per dataset by name, then by
keyword; the session is sized for the input. Connects to the session that spark-submit (or the
environment) configures.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from .incremental.batches import Incremental
from .plans.pipeline import run_gold, run_silver
from .session import apply_scale, build_session, input_bytes
from .sources.catalog import TableStore, preview
from .sources.delimited import read_delimited
from .sources.ingest import ingest_all, ingestion_report
from .sources.rejects import ingest_with_rejects
from .sources.run_log import RunLog, new_run_id
from .sources.schema_store import SchemaStore
from .spec import DatasetSpec


_OPTIONS = {"sep": str, "description": str, "encoding": str, "row_cap": int,
            "infer_types": lambda v: v.lower() in ("1", "true", "yes"),
            "multi_line": lambda v: v.lower() in ("1", "true", "yes"),
            "header": lambda v: v.lower() in ("1", "true", "yes")}


def _specs(args) -> list[DatasetSpec]:
    names = [item.split("=", 1)[0] for item in args.dataset]
    own: dict[str, dict] = {n: {} for n in names}
    for item in args.set:
        target, value = item.split("=", 1)
        name, option = target.rsplit(".", 1)
        if name not in own or option not in _OPTIONS:
            raise SystemExit(f"--set {item}: datasets {names}, options {sorted(_OPTIONS)}")
        own[name][option] = _OPTIONS[option](value)
    columns: dict[str, list] = {n: [] for n in names}
    for item in args.column:
        header, kind = item.rsplit("=", 1)
        name = next((n for n in names if header.startswith(f"{n}:")), None)
        for n in [name] if name else names:
            columns[n].append((header[len(name) + 1:] if name else header, kind))
    specs = []
    for item in args.dataset:
        name, location = item.split("=", 1)
        shared = {"description": args.description, "sep": args.sep, "row_cap": args.row_cap,
                  "infer_types": args.infer_types, "multi_line": args.multi_line}
        specs.append(DatasetSpec(name=name, location=location, columns=tuple(columns[name]) or None,
                                 **(shared | own[name])))
    return specs


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="python -m strata")
    ap.add_argument("layer", choices=["bronze", "silver", "gold", "all", "batch", "log"])
    ap.add_argument("--dataset", action="append", default=[], help="name=location (repeatable)")
    ap.add_argument("--column", action="append", default=[],
                    help="[dataset:]raw header=spark type (repeatable)")
    ap.add_argument("--set", action="append", default=[], help="dataset.option=value (repeatable)")
    ap.add_argument("--batch", default=None, help="name of the batch that the landing files are")
    ap.add_argument("--run-id", default=None, help="a retry under the same id replaces its log entries")
    ap.add_argument("--rejects", action="store_true",
                    help="records that cannot be kept go to rejects_<dataset> instead of failing the run")
    ap.add_argument("--file-mb", type=int, default=256, help="size to which Silver files are packed (0: not)")
    ap.add_argument("--sep", default=";")
    ap.add_argument("--description", default="")
    ap.add_argument("--row-cap", type=int, default=-1)
    ap.add_argument("--infer-types", action="store_true")
    ap.add_argument("--database", default=None)
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--min-sites", type=int, default=5)
    ap.add_argument("--lenient", action="store_true", help="unparsable cells become NULL (counted)")
    ap.add_argument("--multi-line", action="store_true", help="line breaks inside quoted cells")
    ap.add_argument("--allow-unsuppressed", action="store_true",
                    help="go on without a sites column (small counts stay)")
    ap.add_argument("--master", default=None, help="only for runs outside spark-submit")
    args = ap.parse_args(argv)

    spark = build_session(args.master) if args.master else _active_or_default()
    if args.database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {args.database}")
    store = TableStore(spark, args.database, args.format)
    specs = _specs(args)
    apply_scale(spark, input_bytes(spark, [s.location for s in specs]))
    log, run_id = RunLog(store), args.run_id or new_run_id()
    schemas = SchemaStore(store)
    ok = [s.name for s in specs]
    if args.layer == "log":
        _print_all(log.last_status())
        return
    if args.layer == "batch":
        _batch(store, specs, schemas, args, log, run_id)
        return
    if args.layer in ("bronze", "all"):
        if args.rejects:
            ok = _with_rejects(store, specs, schemas, log, run_id)
        else:
            found = ingest_all(store, specs, strict=not args.lenient, schemas=schemas)
            log.record(run_id, "bronze", found)
            _print_all(ingestion_report(found).select("line"))
            ok = [r["dataset"] for r in found.filter("status = 'SUCCESS'").select("dataset").collect()]
        for name in ok:
            preview(spark, store.qualify(f"bronze_{name}")).show(truncate=40)
    if args.layer in ("silver", "all"):
        for name in ok:
            result = run_silver(store, name, None, args.min_sites, strict=not args.lenient,
                                allow_unsuppressed=args.allow_unsuppressed,
                                compact_bytes=args.file_mb << 20)
            _print_all(result.quality_report)
            print(result.table, result.metrics)
            _note(log, run_id, f"silver-{name}", name, f"silver_{name}", result.metrics.get("rows_out"))
    if args.layer in ("gold", "all"):
        for name in ok:
            written = run_gold(store, name)
            log.record(run_id, f"gold-{name}", written.withColumn("dataset", F.lit(name)))
            _print_all(written)


def _note(log: RunLog, run_id: str, layer: str, dataset: str, table: str, rows: int | None) -> None:
    row = log.store.spark.createDataFrame([(dataset, table, "SUCCESS", rows)],
                                          "dataset string, table_name string, status string, rows bigint")
    log.record(run_id, layer, row)


def _with_rejects(store, specs, schemas, log, run_id) -> list[str]:
    done = []
    for spec in specs:
        got = ingest_with_rejects(store, schemas.resolve(spec))
        print(f"{spec.name}: {got.rows_in} records read, {got.rows_kept} kept, {got.rows_rejected} rejected")
        _note(log, run_id, f"bronze-{spec.name}", spec.name, f"bronze_{spec.name}", got.rows_kept)
        done.append(spec.name)
    return done


def _batch(store, specs, schemas, args, log, run_id) -> None:
    if not args.batch:
        raise SystemExit("batch: name it with --batch")
    for spec in specs:
        rows = read_delimited(store.spark, schemas.resolve(spec), strict=not args.lenient)
        feed = Incremental(store, spec.name, None, args.min_sites, not args.lenient,
                           allow_unsuppressed=args.allow_unsuppressed)
        result = feed.run_batch(rows, args.batch)
        _print_all(feed.quality_report())
        print(f"{spec.name}: batch {args.batch}, years {sorted(result.years, key=str)}, {result.metrics}")
        _note(log, run_id, f"batch-{args.batch}", spec.name, feed.silver, result.metrics["rows_out"])


def _print_all(report):
    """Every row of a report (a row per check, dataset or table), whole."""
    report.show(max(1, report.count()), truncate=False)


def _active_or_default():
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


if __name__ == "__main__":
    main()
