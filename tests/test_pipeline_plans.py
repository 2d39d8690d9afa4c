"""Plan shape and the Bronze -> Silver -> Gold run on the test tables."""

from pyspark.sql import functions as F

from strata.operators import windows
from strata.plans.pipeline import run_pipeline
from strata.sources import fixtures
from strata.sources.catalog import TableStore
from tests.conftest import SF_SMALL, SF_MID


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_full_pipeline(spark):
    store = TableStore.scratch(spark)
    spec = fixtures.write_readings_landing(spark, SF_MID)
    res = run_pipeline(store, [spec])
    assert [r.status for r in res.bronze_log.collect()] == ["SUCCESS"]
    silver = res.silver["readings"]
    m = silver.metrics
    assert (m["rows_in"], m["rows_deduplicated"]) == (60000, 16)
    assert m["rows_out"] + m["rows_suppressed"] == m["rows_distinct"]
    assert store.read("silver_readings").count() == m["rows_out"]
    rep = {(r.check_name, r.column_name): r.status for r in silver.quality_report.collect()}
    assert rep[("duplicate_check", "ALL")] == "PASS"
    assert rep[("null_check", "total_energie_soutiree_wh")] == "FAIL"
    gold = {r.table_name: r.status for r in res.gold_log["readings"].collect()}
    assert set(gold.values()) == {"OK"} and len(gold) == 4
    assert [(r.layer, r.status) for r in res.layer_log.collect()] == [("silver", "SUCCESS"), ("gold", "SUCCESS")]
    # Silver is partitioned by year: a year filter prunes files
    one_year = store.read("silver_readings").filter(F.col("annee") == 1996)
    assert "PartitionFilters: [isnotnull(annee" in _plan(one_year)


def test_no_python_in_plans(spark):
    import __spark_entry__ as e
    for key in ("kpi_region_year", "carbon_score_normalised", "sql_function_categorize", "dq_summary"):
        plan = _plan(e.queries()[key](spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, key


def test_filters_reach_the_scan(spark):
    import __spark_entry__ as e
    plan = _plan(e.queries()["partitioned_write_pruned_read"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(o_year" in plan
    li = fixtures.load(spark, SF_SMALL, "lineitem").filter(F.col("l_quantity") >= 5).select("l_quantity")
    plan = _plan(li)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThanOrEqual(l_quantity,5.0)]" in plan
    assert "ReadSchema: struct<l_quantity:double>" in plan


def test_top_k_uses_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), (F.col("id") * 13 % 101).alias("v"))
    plan = _plan(windows.top_k_rows(df, "v", 3, partition_by=["g"]))
    assert "WindowGroupLimit" in plan


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert df.columns == ["region", "annee", "energy_total", "energy_mean", "n_records",
                          "sites_total", "energy_per_site"]


def test_command_line_runs_all_layers(spark, capsys):
    import uuid

    from strata.__main__ import main

    spec = fixtures.write_readings_landing(spark, SF_SMALL)
    from strata.session import note_scratch_database, scratch_path

    db = f"cli_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, 'cli-warehouse')}'")
    note_scratch_database(db)
    main(["all", "--dataset", f"readings={spec.location}", "--database", db,
          "--column", "Total énergie soutirée (Wh)=double", "--column", "Nb points soutirage=bigint"])
    out = capsys.readouterr().out
    assert "[SUCCESS]" in out and "duplicate_check" in out
    tables = {t.name for t in spark.catalog.listTables(db)}
    assert {"bronze_readings", "silver_readings", "gold_region_year_readings",
            "gold_top_regions_readings"} <= tables


def test_gold_reads_silver_once(spark, monkeypatch):
    from strata.plans import pipeline

    store = TableStore.scratch(spark)
    df = spark.createDataFrame([("a", 2020, 1e6, 9, "X", "P"), ("b", 2021, 2e6, 9, "X", "P")],
                               "region string, annee int, total_energie_soutiree_wh double, "
                               "nb_points_soutirage bigint, consumption_category string, profil string")
    store.write(df, "silver_s", partition_by=["annee"])
    seen = {}
    write = pipeline.write_gold
    monkeypatch.setattr(pipeline, "write_gold", lambda st, frames: seen.update(frames) or write(st, frames))
    assert {r.status for r in pipeline.run_gold(store, "s").collect()} == {"OK"}
    silver = set(store.read("silver_s").inputFiles())
    assert len(seen) == 4 and all(not silver & set(f.inputFiles()) for f in seen.values())
    assert all("rangepartitioning" not in _plan(f) for f in seen.values())


def test_fixture_plan_starts_no_job(spark):
    sc = spark.sparkContext
    sc.setJobGroup("plan-only", "plan-only")
    fixtures.readings(spark, SF_SMALL)
    assert not sc.statusTracker().getJobIdsForGroup("plan-only")


def test_missing_sites_column_raises(spark):
    import pytest

    from strata.plans.pipeline import run_silver

    store = TableStore.scratch(spark)
    store.write(spark.createDataFrame([("a", 1.0)], "region string, energie double"), "bronze_x")
    with pytest.raises(ValueError, match="suppressed"):
        run_silver(store, "x")
    with pytest.warns(UserWarning, match="suppressed"):
        kept = run_silver(store, "x", allow_unsuppressed=True)
    assert kept.metrics["suppression_applied"] is False and store.read("silver_x").count() == 1


def test_failed_dataset_leaves_others(spark):
    from strata.session import scratch_path
    from strata.spec import DatasetSpec

    paths = {}
    for name, cols in (("bad", "1 AS region, 2 AS energie"), ("good", "'r' AS region, 2.5 AS energie, 9 AS points")):
        paths[name] = scratch_path(spark, "t-two")
        spark.range(1).selectExpr(*cols.split(", ")).write.option("header", True).option("sep", ";").csv(paths[name])
    res = run_pipeline(TableStore.scratch(spark), [DatasetSpec(n, p, infer_types=True) for n, p in paths.items()])
    assert [(r.dataset, r.layer, r.status) for r in res.layer_log.collect()] == \
        [("bad", "silver", "FAILED"), ("good", "silver", "SUCCESS"), ("good", "gold", "SUCCESS")]
    assert {r.table_name: r.status for r in res.gold_log["good"].collect()}["gold_region_year_good"] == "SKIP"
