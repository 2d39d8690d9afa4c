"""Rejects, stored schemas, the durable run log, the row cap and the readings join."""

import pytest
from pyspark.sql import functions as F

from strata.plans.pipeline import run_pipeline
from strata.session import scratch_path
from strata.sources import fixtures, partitions, schema_store
from strata.sources.catalog import TableStore, preview, table_profile
from strata.sources.delimited import read_delimited
from strata.sources.ingest import ingest_all
from strata.sources.rejects import ingest_with_rejects, reject_summary
from strata.sources.run_log import RunLog, new_run_id
from strata.sources.schema_store import SchemaStore
from strata.spec import DatasetSpec
from tests.conftest import SF_MID, SF_SMALL


def landing(spark, *files):
    folder = scratch_path(spark, "t-stores")
    for text in files:
        spark.createDataFrame([(text.rstrip("\n"),)], "t string").write.mode("append").text(folder)
    return folder


# --- rejects ----------------------------------------------------------------------------

def test_rejects_keep_every_record_and_its_text(spark):
    path = landing(spark, 'a;b;c\n1;x;2.5\n2;y;z;w\nthree;NA;oops\n4;"open\n5;only\n6;"q ""r"";";NA\n')
    spec = DatasetSpec("r", path, columns=(("a", "bigint"), ("c", "double")))
    store = TableStore.scratch(spark)
    got = ingest_with_rejects(store, spec)
    assert (got.rows_in, got.rows_kept, got.rows_rejected) == (6, 3, 3)
    assert sorted(tuple(r)[:3] for r in store.read("bronze_r").select("a", "b", "c").collect()) == [
        (1, "x", 2.5), (5, "only", None), (6, 'q "r";', None)]
    rejects = {r._reason: r for r in store.read("rejects_r").collect()}
    assert rejects["surplus fields"]._record == "2;y;z;w"
    assert rejects["open quote"]._record == '4;"open'
    bad = rejects["unparsable cells"]
    assert bad._record is None and bad._bad_columns == ["a", "c"]
    assert bad._cells == {"a": "three", "b": "NA", "c": "oops"}  # as read, before missing-value tokens
    assert {"_source_dataset", "_ingestion_timestamp"} <= set(store.read("rejects_r").columns)
    summary = {(r.reason, r.column_name): r.n_records for r in reject_summary(store.read("rejects_r")).collect()}
    assert summary == {("surplus fields", None): 1, ("open quote", None): 1,
                       ("unparsable cells", "a"): 1, ("unparsable cells", "c"): 1}


def test_rejects_are_replaced_with_their_table_and_may_be_none(spark):
    store = TableStore.scratch(spark)
    for text, rows in (("a\nx\n2\n", (1, 1)), ("a\n1\n2\n3\n", (3, 0)), ("a\n", (0, 0)), ("a\ny\n", (0, 1))):
        spec = DatasetSpec("again", landing(spark, text), columns=(("a", "bigint"),))
        ingest_with_rejects(store, spec)
        assert (store.read("bronze_again").count(), store.read("rejects_again").count()) == rows
    with pytest.raises(ValueError, match="row cap"):
        ingest_with_rejects(store, DatasetSpec("x", spec.location, row_cap=3))


def test_failed_scan_leaves_both_tables(spark):
    store = TableStore.scratch(spark)
    spec = DatasetSpec("keep", landing(spark, "a\nx\n2\n"), columns=(("a", "bigint"),))
    ingest_with_rejects(store, spec)
    with pytest.raises(Exception):
        ingest_with_rejects(store, DatasetSpec("keep", spec.location + "/none"))
    assert (store.read("bronze_keep").count(), store.read("rejects_keep").count()) == (1, 1)


# --- stored schemas ---------------------------------------------------------------------

def test_second_run_starts_no_inference(spark, monkeypatch):
    store = TableStore.scratch(spark)
    schemas = SchemaStore(store)
    spec = DatasetSpec("s", landing(spark, "a;b;c\n1;2.5;x\n2;NA;y\n"), infer_types=True,
                       columns=(("c", "string"),))
    first = schemas.resolve(spec)
    assert first.columns == (("a", "bigint"), ("b", "double"), ("c", "string")) and not first.infer_types

    def no_inference(*args):
        raise AssertionError("inference started")

    monkeypatch.setattr(schema_store, "infer_cell_types", no_inference)
    assert schemas.resolve(spec) == first and schemas.latest("s")[0] == 1
    log = ingest_all(store, [spec], schemas=schemas).first()
    assert (log.status, log.rows) == ("SUCCESS", 2) and dict(store.read("bronze_s").dtypes)["b"] == "double"


def test_drift_is_versioned_and_known_types_stay(spark):
    store = TableStore.scratch(spark)
    schemas = SchemaStore(store)
    schemas.resolve(DatasetSpec("d", landing(spark, "a;b;c\n1;2;x\n"), infer_types=True))
    # a column gone, one moved, one new; b's cells would now be doubles, but its type is known
    later = DatasetSpec("d", landing(spark, "c;b;n\nx;2.5;7\n"), infer_types=True)
    assert schemas.resolve(later).columns == (("c", "string"), ("b", "bigint"), ("n", "bigint"))
    assert schemas.recheck(later).columns == (("c", "string"), ("b", "double"), ("n", "bigint"))
    assert schemas.recheck(later) == schemas.resolve(later)
    drift = sorted(tuple(r) for r in schemas.drift("d").collect())
    assert drift == [(2, "a", "removed", "bigint", None), (2, "c", "moved", "string", "string"),
                     (2, "n", "added", None, "bigint"), (3, "b", "retyped", "bigint", "double")]
    assert schemas.drift("unknown").count() == 0


def test_failure_to_resolve_is_one_datasets_failure(spark):
    store = TableStore.scratch(spark)
    specs = [DatasetSpec("gone", scratch_path(spark, "none")), DatasetSpec("ok", landing(spark, "a\n1\n"))]
    log = {r.dataset: r.status for r in ingest_all(store, specs, schemas=SchemaStore(store)).collect()}
    assert log == {"gone": "FAILED", "ok": "SUCCESS"}


# --- run log ----------------------------------------------------------------------------

def test_run_log_is_durable_and_idempotent(spark):
    store = TableStore.scratch(spark)
    log = RunLog(store)
    assert log.read().count() == 0
    spec = fixtures.write_readings_landing(spark, SF_SMALL)
    missing = DatasetSpec("missing", scratch_path(spark, "none"))
    for run in ("r1", "r2", "r2"):
        run_pipeline(store, [spec, missing], run_log=log, run_id=run)
    rows = RunLog(store).read().filter("run_id = 'r2'").collect()
    assert sorted((r.layer, r.dataset, r.status) for r in rows) == sorted(
        [("bronze", "missing", "FAILED"), ("bronze", "readings", "SUCCESS"),
         ("silver-readings", "readings", "SUCCESS")] + [("gold-readings", "readings", "OK")] * 4)
    assert log.read().count() == 2 * len(rows)
    last = {(r.layer, r.dataset): r.run_id for r in log.last_status().collect()}
    assert set(last.values()) == {"r2"}
    assert new_run_id() != new_run_id()


# --- row cap, preview, readings ---------------------------------------------------------

def test_row_cap_keeps_the_first_records(spark):
    path = scratch_path(spark, "t-cap")
    spark.range(0, 5000, 1, 6).select("id").write.option("header", True).csv(path)
    first = [r.id for r in read_delimited(spark, DatasetSpec("c", path, row_cap=1200)).collect()]
    assert sorted(map(int, first)) == list(range(1200))


def test_preview_and_empty_profile(spark):
    store = TableStore.scratch(spark)
    store.write(spark.range(9), "p")
    assert preview(spark, store.qualify("p"), 3).count() == 3
    assert table_profile(spark, []).count() == 0


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_MID, "/root/testdata/sf0.1"])
def test_readings_build_on_the_dimension(spark, sf_dir, monkeypatch):
    plan = fixtures.readings(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan and "BuildLeft" not in plan and "BroadcastHashJoin" in plan
    monkeypatch.setattr(fixtures, "BROADCAST_BYTES", 0)
    large = fixtures.readings(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    fact = large[:large.index("lineitem")]
    assert "ShuffledHashJoin" in fact and "BroadcastHashJoin" not in fact


def test_silver_files_are_packed_when_asked(spark):
    from strata.plans.pipeline import run_silver

    store = TableStore.scratch(spark)
    ingest_all(store, [fixtures.write_readings_landing(spark, SF_SMALL)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        run_silver(store, "readings")
        many = {v: len(s) for v, s in partitions.files_per_partition(store, "silver_readings").items()}
        run_silver(store, "readings", compact_bytes=1 << 20)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(many.values()) > 2
    few = partitions.files_per_partition(store, "silver_readings")
    assert {len(s) for s in few.values()} == {1}
    assert store.read("silver_readings").filter(F.col("annee") == 1996).count() > 0
