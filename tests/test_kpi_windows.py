from pyspark.sql import functions as F

from strata.operators import chartdata, kpi, windows
from strata.spec import Roles

R = Roles()


def _readings(spark, rows):
    return spark.createDataFrame(rows, "region string, annee int, total_energie_soutiree_wh double, "
                                       "nb_points_soutirage bigint, consumption_category string, profil string")


def test_yoy_bridges_missing_year_and_zero(spark):
    df = _readings(spark, [("a", 2020, 1e6, 5, "X", "P"), ("a", 2021, 2e6, 5, "X", "P"),
                           ("a", 2022, 0.0, 5, "X", "P"), ("a", 2024, 3e6, 5, "X", "P")])
    rows = kpi.kpi_national_trend(df, R).collect()
    assert [r.annee for r in rows] == [2020, 2021, 2022, 2024]
    assert [r.yoy_pct for r in rows] == [None, 100.0, -100.0, None]
    strict = kpi.kpi_national_trend(df.filter("annee <> 2022"), R, strict_calendar=True).collect()
    assert [r.yoy_pct for r in strict] == [None, 100.0, None]
    bridged = kpi.kpi_national_trend(df.filter("annee <> 2022"), R).collect()
    assert [r.yoy_pct for r in bridged] == [None, 100.0, 50.0]


def test_rank_ties_and_nulls(spark):
    df = spark.createDataFrame([("a", 10.0), ("b", 10.0), ("c", 5.0), ("d", None)], "r string, v double")
    got = {r.r: r.ranking for r in windows.rank_desc(df, "v").collect()}
    assert got == {"a": 1, "b": 1, "c": 3, "d": 4}
    flags = {r.r: r.is_top_k for r in windows.top_k_by_rank(windows.rank_desc(df, "v"), "ranking", 1).collect()}
    assert flags == {"a": True, "b": True, "c": False, "d": False}


def test_all_null_category_and_share(spark):
    df = _readings(spark, [("a", 2020, None, 5, "INCONNU", "P"), ("a", 2020, 30.0, 5, "X", "P"),
                           ("a", 2020, 10.0, 5, "Y", "Q")])
    got = {r.consumption_category: (r.n_records, r.energy_total, r.pct_of_total)
           for r in kpi.kpi_category_share(df, R).collect()}
    assert got == {"INCONNU": (1, None, None), "X": (1, 30.0, 75.0), "Y": (1, 10.0, 25.0)}
    fallback = kpi.kpi_category_share(df.drop("consumption_category"), R)
    assert fallback.columns[0] == "profil"
    assert kpi.kpi_category_share(df.drop("consumption_category", "profil"), R) is None


def test_region_year_zero_sites(spark):
    df = _readings(spark, [("a", 2020, 10.0, 0, "X", "P"), ("b", 2020, 10.005, 4, "X", "P")])
    got = {r.region: (r.energy_total, r.sites_total, r.energy_per_site)
           for r in kpi.kpi_region_year(df, R).collect()}
    assert got["a"] == (10.0, 0, None)
    assert got["b"] == (10.01, 4, 2.5)  # per-site value divides the rounded total


def test_top_regions_latest_year_only(spark):
    df = _readings(spark, [("a", 2020, 99.0, 5, "X", "P"), ("a", 2021, 1.0, 5, "X", "P"),
                           ("b", 2021, 2.0, 5, "X", "P"), ("c", 2021, 2.0, 5, "X", "P")])
    got = [(r.region, r.ranking) for r in kpi.kpi_top_regions(df, R).collect()]
    assert sorted(got) == [("a", 3), ("b", 1), ("c", 1)]
    empty = df.filter(F.lit(False))
    assert kpi.kpi_top_regions(empty, R).count() == 0


def test_window_inputs_are_aggregated(spark):
    # every unpartitioned window of the KPIs sits above an aggregate
    df = _readings(spark, [("a", 2020, 1.0, 5, "X", "P")])
    for frame in (kpi.kpi_national_trend(df, R), kpi.kpi_category_share(df, R), kpi.kpi_top_regions(df, R)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.index("Window") < plan.index("HashAggregate")


def test_chart_frames(spark):
    df = _readings(spark, [("a", 2020, 2e9, 5, "ELEVEE", "P"), ("b", 2021, 1e9, 5, "INCONNU", "P"),
                           ("b", 2020, 1.5e9, 5, "ZZ", "P")])
    m = chartdata.chart_region_year_matrix(kpi.kpi_region_year(df, R))
    assert m.columns == ["region", "2020", "2021"]
    assert [r.region for r in m.collect()] == ["b", "a"]
    cat = chartdata.chart_category_share(kpi.kpi_category_share(df, R)).collect()
    assert {r.consumption_category: r.colour for r in cat} == {"ELEVEE": "#0070C0", "ZZ": "#AAAAAA"}
    assert cat[0].label == "1.5 bn Wh  (33.33%)"
    rk = chartdata.chart_region_ranking(kpi.kpi_top_regions(df, R)).collect()
    assert [r.label for r in rk] == ["1.00 bn Wh  (rank 1)"] and rk[0].is_top_k
    tr = chartdata.chart_trend_series(kpi.kpi_national_trend(df, R)).collect()
    assert [r.change_label for r in tr] == [None, "-71.4%"] and tr[1].change_class == "down"


from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["A", "B", "C", None]),
                          st.one_of(st.none(), st.floats(0, 1e7, allow_nan=False))),
                min_size=1, max_size=40))
def test_shares_sum_to_100(spark, rows):
    df = spark.createDataFrame([(c, 2020, v, 5, c, "P") for c, v in rows],
                               "region string, annee int, total_energie_soutiree_wh double, "
                               "nb_points_soutirage bigint, consumption_category string, profil string")
    shares = [r.pct_of_total for r in kpi.kpi_category_share(df, R).collect() if r.pct_of_total is not None]
    if shares:
        assert abs(sum(shares) - 100.0) <= 0.005 * len(shares) + 1e-9


def test_null_keys(spark):
    df = _readings(spark, [(None, 2020, 1e9, 5, "X", "P"), ("a", None, 2e9, 5, "X", "P"),
                           ("a", 2020, 3e9, 5, "X", "P")])
    k1 = kpi.kpi_region_year(df, R)
    keys = {(r.region, r.annee) for r in k1.collect()}
    assert keys == {(None, 2020), ("a", None), ("a", 2020)}  # null keys form groups
    m = chartdata.chart_region_year_matrix(k1).collect()
    assert [(r.region, r["2020"]) for r in m] == [("a", 3.0)]  # the pivot leaves them out


def test_hot_row_skew(spark):
    # one row is a third of the input: collapsed map-side, counted exactly
    from strata.operators import quality
    hot = spark.range(30000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "1.0 AS v")
    m = quality.dedup_metrics(hot).first()
    assert (m.rows_before, m.rows_after, m.rows_removed) == (30000, 20001, 9999)
    plan = quality.dedup_metrics(hot)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.rindex("HashAggregate")  # partial agg below


def test_unbounded_rank_equals_window_rank(spark):
    import random

    random.seed(7)
    rows = [(i, random.choice([None, float(random.randint(0, 300))])) for i in range(3000)]
    rows += [(10_000 + i, 42.0) for i in range(1500)]  # a hot value: a third of the rows
    rows += [(20_000, float("nan")), (20_001, float("nan"))]
    df = spark.createDataFrame(rows, "id int, v double")
    expect = {r.id: r.ranking for r in windows.rank_desc(df, "v").collect()}
    got = {r.id: r.ranking for r in windows.rank_desc_unbounded(df, "v", ranges=8).collect()}
    assert got == expect


def test_unbounded_share_equals_window_share(spark):
    rows = [(i, float(i % 17) if i % 5 else None) for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, v double")
    expect = {r.id: r.pct_of_total for r in windows.share_of_total(df, "v").collect()}
    got = windows.share_of_total_unbounded(df, "v")
    assert {r.id: r.pct_of_total for r in got.collect()} == expect
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_unbounded_lag_equals_window_lag(spark):
    import random

    random.seed(3)
    keys = random.sample(range(100_000), 3000) + [None]
    rows = [(k, random.choice([None, float(random.randint(0, 99))])) for k in keys]
    df = spark.createDataFrame(rows, "k int, v double")
    expect = {r.k: r.prev for r in windows.lag_previous_period(df, "k", "v", "prev").collect()}
    got = {r.k: r.prev for r in windows.lag_previous_unbounded(df, "k", "v", "prev", ranges=8).collect()}
    assert got == expect


def test_unbounded_windows_on_awkward_inputs(spark):
    kinds = {"big": "1152921504606846976 + id % 5", "day": "date_add(date'2020-01-01', CAST(id % 7 AS int))",
             "word": "concat('w', id % 11)", "dec": "CAST(id % 13 AS decimal(20,3))",
             "none": "CAST(NULL AS date)", "hot": "IF(id % 3 = 0, NULL, id)"}
    for name, sql in kinds.items():
        df = spark.range(400).selectExpr("id", f"{sql} AS v")
        expect = {r.id: r.ranking for r in windows.rank_desc(df, "v").collect()}
        assert {r.id: r.ranking for r in windows.rank_desc_unbounded(df, "v", ranges=6).collect()} == expect, name
        lagged = windows.lag_previous_unbounded(df, "v", "v", "prev", ranges=6)
        same = windows.lag_previous_period(df, "v", "v", "prev")
        assert sorted(map(repr, lagged.select("v", "prev").collect())) == \
            sorted(map(repr, same.select("v", "prev").collect())), name
        empty = df.filter("false")
        assert windows.rank_desc_unbounded(empty, "v").count() == 0
        assert windows.lag_previous_unbounded(empty, "v", "v", "prev").count() == 0
    assert windows.rank_desc_unbounded(empty, "v").schema["ranking"].dataType.simpleString() == "bigint"


def test_gold_base_gives_the_same_kpis(spark):
    df = _readings(spark, [("a", 2020, 10.25, 5, "X", "P"), ("a", 2020, None, 6, "INCONNU", "P"),
                           (None, 2021, 3.5, None, "Y", None), ("b", 2021, None, 7, "INCONNU", "Q"),
                           ("b", None, 2.0, 8, "X", "Q")])
    base = kpi.gold_base(df, R)
    for build in (kpi.kpi_region_year, kpi.kpi_national_trend, kpi.kpi_category_share, kpi.kpi_top_regions):
        assert sorted(map(repr, build(base, R).collect())) == sorted(map(repr, build(df, R).collect()))
    bare = df.select("region")
    assert kpi.kpi_region_year(bare, R) is None and kpi.kpi_top_regions(kpi.gold_base(bare, R), R) is None
