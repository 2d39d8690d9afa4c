import os

import pytest
from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.sources.catalog import TableStore, schema_listing, table_profile, write_gold
from strata.sources.delimited import add_audit_columns, read_delimited
from strata.sources.ingest import ingest_all, ingestion_report
from strata.spec import DatasetSpec


def _landing(spark, text):
    path = scratch_path(spark, "t-landing")
    os.makedirs(path)
    with open(f"{path}/part.csv", "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


def test_na_tokens_become_null(spark):
    path = _landing(spark, "a;b;c\n1;x;2.5\n;NA;NaN\nnull;N/A;3\n")
    spec = DatasetSpec("t", path, columns=(("a", "bigint"), ("c", "double")))
    rows = [tuple(r) for r in read_delimited(spark, spec).collect()]
    assert rows == [(1, "x", 2.5), (None, None, None), (None, None, 3.0)]
    inferred = read_delimited(spark, DatasetSpec("t", path, infer_types=True))
    assert dict(inferred.dtypes) == {"a": "bigint", "b": "string", "c": "double"}


def test_row_cap_and_audit(spark):
    path = _landing(spark, "a\n" + "\n".join(str(i) for i in range(50)) + "\n")
    spec = DatasetSpec("t", path, description="d", row_cap=7)
    df = add_audit_columns(read_delimited(spark, spec), spec)
    assert df.count() == 7
    assert df.columns[1:] == ["_ingestion_timestamp", "_ingestion_date", "_source_dataset",
                              "_source_url", "_source_description"]


def test_overwrite_table_it_reads(spark):
    store = TableStore.scratch(spark)
    store.write(spark.range(5), "t")
    store.write(store.read("t").withColumn("v", F.lit(1)), "t")
    assert store.read("t").columns == ["id", "v"] and store.read("t").count() == 5


def test_failed_write_keeps_old_table(spark):
    store = TableStore.scratch(spark)
    store.write(spark.range(3), "t")
    bad = spark.range(3).withColumn("x", F.raise_error(F.lit("boom")))
    with pytest.raises(Exception):
        store.write(bad, "t")
    assert store.read("t").count() == 3


def test_partition_pruning(spark):
    store = TableStore.scratch(spark)
    df = spark.range(100).withColumn("y", (F.col("id") % 4).cast("int"))
    store.write(df, "p", partition_by=["y"])
    sel = store.read("p").filter(F.col("y") == 2)
    plan = sel._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(y" in plan and sel.count() == 25
    assert len(sel.inputFiles()) < len(store.read("p").inputFiles())


def test_ingestion_log_isolates_failures(spark):
    store = TableStore.scratch(spark)
    ok = DatasetSpec("good", _landing(spark, "a;b\n1;2\n3;4\n"), infer_types=True)
    missing = DatasetSpec("gone", scratch_path(spark, "nothing-here"))
    log = ingest_all(store, [missing, ok])
    got = {r.dataset: (r.status, r.rows, r.columns, r.error_class) for r in log.collect()}
    assert got["good"] == ("SUCCESS", 2, 2, None)
    assert got["gone"][0] == "FAILED" and got["gone"][3] == "PATH_NOT_FOUND"
    lines = {r.dataset: r.line for r in ingestion_report(log).collect()}
    assert "N/A" in lines["gone"] and lines["gone"].rstrip().endswith("-s")
    prof = {r.table_name.split(".")[-1]: (r.rows, r.status)
            for r in table_profile(spark, [store.qualify("bronze_good"), "no_such_table"]).collect()}
    assert prof == {"bronze_good": (2, "OK"), "no_such_table": (None, "ERROR: AnalysisException")}


def test_gold_sink_skips_missing(spark):
    store = TableStore.scratch(spark)
    log = write_gold(store, {"k1": spark.range(3), "k2": None})
    assert sorted(tuple(r) for r in log.collect()) == [("k1", "OK", 3, None), ("k2", "SKIP", None, None)]
    assert "_gold_timestamp" in store.read("k1").columns


def test_lenient_ingest_counts_lost_cells(spark):
    store = TableStore.scratch(spark)
    path = _landing(spark, "a;b\n1;x\noops;2.5\n3;NA\n4;bad\n")
    spec = DatasetSpec("dirty", path, columns=(("a", "bigint"), ("b", "double")))
    log = ingest_all(store, [spec], strict=False).first()
    assert (log.status, log.rows, log.columns, log.bad_cells) == ("SUCCESS", 4, 2, 3)
    assert [tuple(r) for r in store.read("bronze_dirty").select("a", "b").collect()] == \
        [(1, None), (None, 2.5), (3, None), (4, None)]
    strict = ingest_all(store, [spec]).first()
    assert strict.status == "FAILED" and strict.bad_cells is None


def test_stream_ingest_is_exactly_once(spark):
    from strata.streaming.bronze_stream import ingest_stream

    store = TableStore.scratch(spark)
    path = _landing(spark, "a;b\n1;x\n2;NA\n")
    spec = DatasetSpec("s", path, columns=(("a", "bigint"),))
    ckpt = scratch_path(spark, "t-ckpt")
    ingest_stream(store, spec, checkpoint=ckpt)
    ingest_stream(store, spec, checkpoint=ckpt)
    rows = sorted(tuple(r) for r in store.read("bronze_s").select("a", "b", "_source_dataset").collect())
    assert rows == [(1, "x", "s"), (2, None, "s")]


def test_schema_listing(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "k bigint, s string, v double")
    assert [tuple(r) for r in schema_listing(df).collect()] == \
        [(0, "k", "bigint"), (1, "s", "string"), (2, "v", "double")]


def test_surplus_fields_and_broken_records_raise(spark):
    for text in ("a;b\n1;2\n3;4;5\n", 'a;b\n1;"x\ny"\n'):
        with pytest.raises(Exception, match="malformed record"):
            read_delimited(spark, DatasetSpec("t", _landing(spark, text))).collect()
        with pytest.raises(Exception, match="malformed record"):
            read_delimited(spark, DatasetSpec("t", _landing(spark, text))).count()
    short = _landing(spark, "a;b\n1\n2;x\n")
    assert [tuple(r) for r in read_delimited(spark, DatasetSpec("t", short)).collect()] == [("1", None), ("2", "x")]
    quoted = _landing(spark, 'a;b\n1.0;"x\ny ""z"";"\n')
    spec = DatasetSpec("t", quoted, multi_line=True, columns=(("a", "bigint"),))
    assert [tuple(r) for r in read_delimited(spark, spec).collect()] == [(1, 'x\ny "z";')]


def test_failed_swap_keeps_old_table(spark, monkeypatch):
    from strata.sources import catalog

    store = TableStore.scratch(spark)
    store.write(spark.range(3), "t")
    rename = catalog._rename

    def failing(s, old, new):
        if "__staging_" in old:
            raise RuntimeError("lost between backup and swap")
        rename(s, old, new)

    monkeypatch.setattr(catalog, "_rename", failing)
    with pytest.raises(RuntimeError):
        store.write(spark.range(9), "t")
    assert store.read("t").count() == 3
    monkeypatch.undo()
    # a crash right after the backup: the table can be put back
    catalog._rename(spark, store.qualify("t"), store.qualify("t") + "__backup")
    assert catalog.restore_table(spark, store.qualify("t")) and store.read("t").count() == 3
    assert not catalog.restore_table(spark, store.qualify("t"))


def test_stream_infers_types_and_counts_bad_cells(spark):
    from strata.streaming.bronze_stream import ingest_stream

    store = TableStore.scratch(spark)
    spec = DatasetSpec("i", _landing(spark, "a;b\n1;2.5\n2;NA\n"), infer_types=True)
    ingest_stream(store, spec)
    assert dict(store.read("bronze_i").dtypes)["a"] == "bigint" and dict(store.read("bronze_i").dtypes)["b"] == "double"
    lenient = DatasetSpec("l", _landing(spark, "a;b\n1;x\noops;y;z\n"), columns=(("a", "bigint"),))
    ingest_stream(store, lenient, strict=False)
    assert sorted((r.a or 0, r._bad_cells) for r in store.read("bronze_l").collect()) == [(0, 2), (1, 0)]


def test_long_quoted_cells_of_malformed_records(spark):
    cell = '"' + 'x""; ' * 250_000 + '"'  # over 1 MB
    text = f"a;b;c\n1;{cell}\n2;{cell};y;z\n3;{cell};y\n"
    lenient = read_delimited(spark, DatasetSpec("t", _landing(spark, text)), strict=False, bad_cells_column="bad")
    assert sorted((r.a, len(r.b), r.c, r.bad) for r in lenient.collect()) == [
        ("1", 1_000_000, None, 0), ("2", 1_000_000, "y", 1), ("3", 1_000_000, "y", 0)]
    short = DatasetSpec("t", _landing(spark, f"a;b;c\n1;{cell}\n"))
    assert [len(r.b) for r in read_delimited(spark, short).collect()] == [1_000_000]
    with pytest.raises(Exception, match="malformed record"):
        read_delimited(spark, DatasetSpec("t", _landing(spark, f"a;b\n1;{cell};z\n"))).count()


def test_dropped_stream_table_starts_anew(spark):
    from strata.streaming.bronze_stream import ingest_stream, reset_stream, stream_checkpoint

    store, other = TableStore.scratch(spark), TableStore.scratch(spark)
    spec = DatasetSpec("again", _landing(spark, "a;b\n1;x\n2;y\n"))
    ingest_stream(store, spec)
    ingest_stream(store, spec)
    assert store.read("bronze_again").count() == 2
    first = stream_checkpoint(store, "bronze_again")
    reset_stream(store, spec)
    assert stream_checkpoint(store, "bronze_again") is None
    ingest_stream(store, spec)
    assert store.read("bronze_again").count() == 2
    ingest_stream(other, spec)  # a table of the same name elsewhere has its own progress
    assert other.read("bronze_again").count() == 2
    assert len({first, stream_checkpoint(store, "bronze_again"), stream_checkpoint(other, "bronze_again")}) == 3


def test_partitioned_table_is_overwritten_again_and_again(spark):
    store = TableStore.scratch(spark)
    for n in (1, 2, 3):
        df = spark.range(60).selectExpr("id", f"{n} AS version", "cast(id % 3 AS int) AS p",
                                        "CASE WHEN id % 2 = 0 THEN 'a b/c%' END AS q")
        store.write(df, "t", partition_by=["p", "q"])
        assert store.read("t").groupBy("version").count().collect()[0].asDict() == {"version": n, "count": 60}
    assert store.read("t").filter("p = 1 AND q IS NULL").count() == 10
