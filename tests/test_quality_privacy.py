import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.operators import privacy, quality


def _report(df):
    return {(r.check_name, r.column_name): (r.metric_count, r.metric_pct, r.status)
            for r in quality.quality_report(df).collect()}


@pytest.mark.parametrize("n_null,n_rows,status", [
    (0, 100, "PASS"), (499, 10000, "WARNING"), (5, 100, "FAIL"), (0, 0, "PASS"),
])
def test_null_rate_status(spark, n_null, n_rows, status):
    rows = [(None,)] * n_null + [(float(i),) for i in range(n_rows - n_null)]
    df = spark.createDataFrame(rows, "x double")
    count, pct, got = _report(df)[("null_check", "x")]
    assert (count, got) == (n_null, status)
    assert pct == (round(n_null / n_rows * 100, 2) if n_rows else 0.0)


def test_duplicates_and_negatives(spark):
    df = spark.createDataFrame([(1, -1.0, "a"), (1, -1.0, "a"), (2, 3.0, None), (2, 3.0, None)],
                               "k int, v double, s string")
    rep = _report(df)
    assert rep[("duplicate_check", "ALL")] == (2, None, "WARNING")
    assert rep[("negative_check", "v")] == (2, None, "FAIL")
    assert rep[("negative_check", "k")] == (0, None, "PASS")
    assert ("negative_check", "s") not in rep
    assert rep[("null_check", "s")][2] == "FAIL"
    summary = quality.quality_summary(quality.quality_report(df)).first()
    assert tuple(summary) == (6, 2, 1)


def test_dedupe_semantics(spark):
    df = spark.createDataFrame([(None, float("nan")), (None, float("nan")), (1, 0.0), (1, -0.0)],
                               "a int, b double")
    assert quality.dedup_full_row(df).count() == 2
    m = quality.dedup_metrics(df).first()
    assert (m.rows_before, m.rows_after, m.rows_removed) == (4, 2, 2)


def test_quality_pass_is_one_shuffle(spark):
    df = spark.createDataFrame([(1, 2.0)], "a int, b double")
    plan = quality.quality_report(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 9))), max_size=30))
def test_dedupe_idempotent_and_suppression_balance(spark, rows):
    df = spark.createDataFrame(rows, "a int, s bigint")
    once = quality.dedup_full_row(df)
    assert sorted(map(repr, once.collect())) == sorted(map(repr, quality.dedup_full_row(once).collect()))
    m = privacy.suppression_metrics(df, "s", 5).first()
    kept = privacy.suppress_small_counts(df, "s", 5)
    assert m.rows_before == m.rows_after + m.rows_removed == len(rows)
    assert kept.count() == m.rows_after
    assert all(r.s >= 5 for r in kept.collect())


def test_site_threshold(spark):
    df = spark.createDataFrame([(None,), (0,), (4,), (5,), (6,)], "s bigint")
    out = privacy.suppress_small_counts(df, "s", 5, audit=True)
    assert [tuple(r) for r in out.orderBy("s").collect()] == [(5, 5), (6, 5)]
    with pytest.warns(UserWarning):
        assert privacy.suppress_small_counts(df, None).count() == 5
