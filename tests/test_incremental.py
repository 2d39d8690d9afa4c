"""Batch by batch equals all at once: rows, metrics, quality report, KPIs; failures and re-runs."""

import hashlib

import pytest
from pyspark.sql import functions as F

from strata import queries
from strata.incremental import states
from strata.incremental.batches import SILVER_BATCH, Incremental
from strata.incremental.history import KEY, row_key
from strata.operators import kpi, quality
from strata.plans.pipeline import SILVER_CLOCK_COLUMNS, silver_plan
from strata.sources import fixtures, partitions
from strata.sources.catalog import TableStore
from strata.spec import Roles
from tests.conftest import SF_MID, SF_SMALL

ROLES = Roles()
E, S = ROLES.measure, ROLES.sites


@pytest.fixture(scope="module")
def rows(spark):
    """Readings with awkward rows: NULLs everywhere, NaN, both zeros, exact copies."""
    odd = spark.createDataFrame(
        [(None, None, None, None, None), ("N", None, "R", float("nan"), 9), ("N", None, "R", 0.0, 9),
         ("N", None, "R", -0.0, 9), ("-", None, "", -3.5, 7), ("1:-", None, "-", None, 7)],
        "region string, horodate timestamp_ntz, profil string, total_energie_soutiree_wh double, "
        "nb_points_soutirage bigint")
    return fixtures.readings(spark, SF_SMALL).unionByName(odd).unionByName(odd.filter("region = 'N'"))


def cut(rows, n):
    """Batches that overlap: rows of one batch come again in the next and in the last."""
    place = F.pmod(F.xxhash64(*rows.columns), F.lit(n))
    return [rows.filter((place == i) | (place == i - 1) | ((place == 0) & F.lit(i == n - 1)))
            for i in range(n)]


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def near(a, b):
    """Equal rows but for the last of two decimals: a rounded mean may tie, and floating sums
    depend on the order of summation."""
    def split(df):
        rows = [([v for v in r if not isinstance(v, float)], [v for v in r if isinstance(v, float)])
                for r in df.collect()]
        return sorted(rows, key=lambda r: str(r[0]))
    one, two = split(a), split(b)
    assert [r[0] for r in one] == [r[0] for r in two]
    for (_, x), (_, y) in zip(one, two):
        assert x == pytest.approx(y, abs=0.011, nan_ok=True)
    return True


def everything(batches):
    out = batches[0]
    for b in batches[1:]:
        out = out.unionByName(b)
    return out


@pytest.fixture(scope="module")
def fed(spark, rows):
    feed = Incremental(TableStore.scratch(spark), "energy", buckets=4)
    parts = cut(rows, 3)
    results = [feed.run_batch(p, f"b{i}") for i, p in enumerate(parts)]
    return feed, parts, results


def whole(batches, **kw):
    return silver_plan(everything(batches), ROLES, with_clock=False, observe=False).frame


def silver_of(feed):
    return feed.store.read("silver_energy").drop(*SILVER_CLOCK_COLUMNS, SILVER_BATCH)


def test_batches_give_the_rows_and_metrics_of_one_run(fed):
    feed, parts, results = fed
    want = whole(parts)
    assert same(silver_of(feed).select(*want.columns), want)
    union = everything(parts)
    m = feed.metrics().first()
    d = quality.dedup_metrics(union).first()
    assert (m.rows_in, m.rows_distinct, m.rows_deduplicated) == tuple(d)
    assert m.rows_out == want.count() and m.rows_suppressed == m.rows_distinct - m.rows_out
    assert sum(r.metrics["rows_distinct"] for r in results) == m.rows_distinct


def test_report_of_batches_is_the_report_of_the_union(fed):
    feed, parts, _ = fed
    assert same(feed.quality_report(), quality.quality_report(everything(parts)))


def test_kpis_from_the_base_equal_a_full_run(fed):
    feed, parts, _ = fed
    frames = states.gold_from_base(feed.store, "energy")
    silver = whole(parts)
    for name, build in (("gold_region_year", kpi.kpi_region_year), ("gold_category_share", kpi.kpi_category_share),
                        ("gold_top_regions", kpi.kpi_top_regions)):
        assert near(frames[name], build(silver, ROLES, ordered=False)), name
        assert same(feed.store.read(f"{name}_energy").drop("_gold_timestamp"), frames[name])
    trend = [frames["gold_national_trend"], kpi.kpi_national_trend(silver, ROLES, ordered=False)]
    assert near(*[t.drop("energy_total") for t in trend])


def test_running_a_batch_again_changes_nothing(fed, monkeypatch):
    feed, parts, _ = fed
    before = sorted(map(str, silver_of(feed).collect())), feed.metrics().first()

    def broken(*args):
        raise RuntimeError("lost after Silver")

    monkeypatch.setattr(states, "refresh_base", broken)
    with pytest.raises(RuntimeError):
        feed.run_batch(parts[1], "b1")
    monkeypatch.undo()
    feed.run_batch(parts[1], "b1")
    assert (sorted(map(str, silver_of(feed).collect())), feed.metrics().first()) == before


def test_late_year_reads_one_silver_partition(spark, rows):
    feed = Incremental(TableStore.scratch(spark), "late", buckets=4)
    late = F.coalesce(F.year("horodate") == 1996, F.lit(False))
    feed.run_batch(rows.filter(~late), "first")
    old = {p.value: p.location for p in partitions.partitions(feed.store, "silver_late")}
    base = {p.value: p.location for p in partitions.partitions(feed.store, "gold_base_late")}
    result = feed.run_batch(rows.filter(late), "second")
    assert result.years == [1996]
    for table, was in (("silver_late", old), ("gold_base_late", base)):
        now = {p.value: p.location for p in partitions.partitions(feed.store, table)}
        assert {v for v in now if now[v] != was.get(v)} == {1996}
    read = states.of_years(feed.store.read("silver_late"), ROLES.year, result.years)
    assert all("annee=1996" in f for f in read.inputFiles())
    frames = states.gold_from_base(feed.store, "late")
    assert near(frames["gold_region_year"],
                kpi.kpi_region_year(silver_plan(rows, ROLES, with_clock=False, observe=False).frame, ROLES))


def test_history_is_read_in_place(spark, fed):
    feed, parts, _ = fed
    history = feed.history
    batch = quality.grouped_rows(parts[0]).withColumn(KEY, row_key(parts[0]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = history.mark_seen(batch, "next")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    right = plan[plan.index("SortMergeJoin"):]
    scan = right.rindex("FileScan")
    assert "Bucketed: true" in right and "Exchange" not in right[right.rindex("Sort [__strata_key", 0, scan):scan]


def test_other_columns_and_names_are_refused(fed):
    feed, parts, _ = fed
    with pytest.raises(ValueError, match="history is over columns"):
        feed.run_batch(parts[0].withColumn("more", F.lit(1)), "b9")
    with pytest.raises(ValueError, match="batch name"):
        feed.run_batch(parts[0], "b 9")


def test_empty_batch(spark, fed):
    feed, parts, _ = fed
    before = feed.metrics().first()
    assert feed.run_batch(parts[0].limit(0), "none").years == []
    assert feed.metrics().first() == before


def test_row_keys_are_equal_exactly_for_equal_rows(spark):
    df = spark.createDataFrame([("a", "b:c", 0.0), ("a", "b:c", -0.0), ("ab", ":c", 0.0), (None, "-", 1.0),
                                ("-", None, 1.0), ("x", "y", float("nan")), ("x", "y", float("nan"))],
                               "p string, q string, v double")
    keys = [bytes(r[0]) for r in df.select(row_key(df)).collect()]
    assert keys[0] == keys[1] and keys[5] == keys[6] and len(set(keys)) == 5 and len(keys[0]) == 16
    with pytest.raises(TypeError):
        row_key(spark.createDataFrame([([1],)], "a array<int>"))


# --- partitions -------------------------------------------------------------------------

def test_partition_overwrite_survives_failure_in_the_middle(spark, monkeypatch):
    store = TableStore.scratch(spark)
    first = spark.range(600).select("id", (F.col("id") % 3 + 2000).cast("int").alias("y"), F.lit("old").alias("v"))
    partitions.write_partitions(store, first, "t", "y")
    second = first.filter("y < 2002").withColumn("v", F.lit("new"))
    point, done = partitions._point, []

    def failing(*args):
        if done:
            raise RuntimeError("lost in the middle")
        done.append(point(*args))

    monkeypatch.setattr(partitions, "_point", failing)
    with pytest.raises(RuntimeError):
        partitions.write_partitions(store, second, "t", "y")
    monkeypatch.undo()

    def seen():
        spark.catalog.refreshTable(store.qualify("t"))
        return {r.y: (r.n, sorted(r.vs)) for r in store.read("t").groupBy("y").agg(
            F.count("*").alias("n"), F.collect_set("v").alias("vs")).collect()}

    half = seen()  # every year is whole, old or new
    assert all(n == 200 and len(vs) == 1 for n, vs in half.values()) and half[2002] == (200, ["old"])
    assert partitions.recover(store, "t") == 1 and partitions.recover(store, "t") == 0
    assert seen() == {2000: (200, ["new"]), 2001: (200, ["new"]), 2002: (200, ["old"])}


def test_partition_overwrite_reads_itself_empties_and_drops_old_folders(spark):
    store = TableStore.scratch(spark)
    df = spark.createDataFrame([(1, "a'b"), (2, None), (3, "c d%")], "id int, p string")
    assert set(partitions.write_partitions(store, df, "t", "p")) == {"a'b", None, "c d%"}
    partitions.write_partitions(store, store.read("t").filter("p = 'c d%'").withColumn("id", F.col("id") * 10),
                                "t", "p", ["c d%", None])
    assert sorted((r.id, r.p) for r in store.read("t").collect()) == [(1, "a'b"), (30, "c d%")]
    assert partitions.drop_superseded(store, "t") == 0  # the first folder still holds a'b
    partitions.write_partitions(store, df.filter("id = 1"), "t", "p")
    assert partitions.drop_superseded(store, "t") == 1
    assert sorted((r.id, r.p) for r in store.read("t").collect()) == [(1, "a'b"), (30, "c d%")]
    with pytest.raises(ValueError, match="other columns"):
        partitions.write_partitions(store, df.withColumn("x", F.lit(1)), "t", "p")


def test_compaction_bounds_files_per_partition(spark):
    store = TableStore.scratch(spark)
    df = spark.range(40_000).select("id", F.xxhash64("id").alias("v"), (F.col("id") % 2).cast("int").alias("y"))
    partitions.write_partitions(store, df.repartition(24), "t", "y")
    sizes = partitions.files_per_partition(store, "t")
    assert all(len(s) == 24 for s in sizes.values())
    target = max(map(max, sizes.values())) * 9
    changed = partitions.compact(store, "t", target)
    assert set(changed) == {0, 1}
    for value, after in partitions.files_per_partition(store, "t").items():
        assert len(after) <= 2 * sum(sizes[value]) // target + 1 and changed[value] == (24, len(after))
    assert same(store.read("t"), df)
    assert partitions.compact(store, "t", target) == {}


def test_bins():
    assert partitions.bins([5, 4, 3, 3], 7) == [[5], [4, 3], [3]]
    assert partitions.bins([9, 1], 7) == [[9], [1]] and partitions.bins([], 7) == []


def test_year_partitions_are_written_by_tasks_of_bounded_size(spark, monkeypatch, tmp_path):
    """A task sorts what it writes, so no task takes the whole table, and a large year is shared."""
    fixtures.load(spark, SF_MID, "orders").repartition(8).write.parquet(f"{tmp_path}/orders.parquet")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "16k")
    try:
        store = queries._orders_by_year(spark, str(tmp_path))
    finally:
        spark.conf.set(key, before)
    orders = fixtures.load(spark, SF_MID, "orders").withColumn("o_year", F.year("o_orderdate"))
    assert same(store.read("orders_by_year"), orders)
    sizes = partitions.files_per_partition(store, "orders_by_year")
    whole_years = sorted(sizes)[:-1]  # the last is short
    assert len(whole_years) >= 5 and all(len(sizes[y]) > 1 for y in whole_years)

    asked = []
    monkeypatch.setattr(queries, "SLICE_BYTES", 8 << 10)
    monkeypatch.setattr(queries, "_orders_by_year", lambda *a, f=queries._orders_by_year: asked.append(a[2]) or f(*a))
    assert queries.q_compaction_files_per_year(spark, str(tmp_path)).filter("bounded").count() == len(sizes)
    assert asked[0] > 12


def test_a_batch_is_stored_once_and_its_keys_unsorted(spark, rows, monkeypatch):
    """Writing an index sorted by key evaluates the bucket at every comparison; cleaned rows are
    a narrow plan over the stored batch and are not stored a second time."""
    stored = []
    monkeypatch.setattr(Incremental, "_staged",
                        lambda self, df, f=Incremental._staged: stored.append(df.columns) or f(self, df))
    feed = Incremental(TableStore.scratch(spark), "once", buckets=4)
    for n, part in enumerate(cut(rows, 2)):
        feed.run_batch(part, f"b{n}")
    assert len(stored) == 2 and all(KEY in columns for columns in stored)
    described = spark.sql(f"DESCRIBE EXTENDED {feed.store.qualify(feed.history.table)}").collect()
    facts = {r.col_name: r.data_type for r in described}
    assert facts["Num Buckets"] == "4" and facts.get("Sort Columns", "[]") == "[]"
    want = whole([rows])
    assert same(feed.store.read("silver_once").select(*want.columns), want)


def test_row_keys_keep_their_spelling(spark):
    """Keys on record stay comparable: SHA-256 over length-prefixed texts, '-' for NULL."""
    df = spark.createDataFrame([("é:", None, -0.0, 7), (None, "", 2.5, None)],
                               "p string, q string, v double, n bigint")
    want = ["2:é:-3:0.01:7", "-0:3:2.5-"]
    assert [bytes(r[0]) for r in df.select(row_key(df)).collect()] == [
        hashlib.sha256(w.encode()).digest()[:16] for w in want]


def test_index_buckets_grow_with_the_input(spark, monkeypatch):
    monkeypatch.setattr(queries, "SLICE_BYTES", 1 << 10)
    monkeypatch.setattr(Incremental, "run_batch", lambda *args: None)
    assert queries._fed(spark, SF_SMALL).buckets > 16
