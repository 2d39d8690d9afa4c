"""The reference's ten scalar cases, band edges, and native == pure Python."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.functions.scoring import (carbon_score_emission, carbon_score_normalised, categorize,
                                      register_sql_functions)


# Pure-Python statements of the definitions, used as the model.
def model_category(x):
    if x is None:
        return "INCONNU"
    for bound, label in ((1000.0, "TRES FAIBLE"), (5000.0, "FAIBLE"), (20000.0, "MODEREE"),
                         (100000.0, "ELEVEE")):
        if x < bound:
            return label
    return "TRES ELEVEE"


def model_normalised(x, n):
    if x is None or n is None or n == 0:
        return None
    return min(100.0, round(x / n / 50.0 * 10.0) / 10.0)


def _one(spark, col, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(col).collect()]


@pytest.mark.parametrize("value,label", [
    (None, "INCONNU"), (500.0, "TRES FAIBLE"), (3000.0, "FAIBLE"), (10000.0, "MODEREE"),
    (50000.0, "ELEVEE"), (200000.0, "TRES ELEVEE"),
    # edges
    (999.99, "TRES FAIBLE"), (1000.0, "FAIBLE"), (5000.0, "MODEREE"), (20000.0, "ELEVEE"),
    (100000.0, "TRES ELEVEE"), (-1.0, "TRES FAIBLE"), (float("nan"), "TRES ELEVEE"),
])
def test_categorize(spark, value, label):
    assert _one(spark, categorize("x"), [(value,)], "x double") == [label]


@pytest.mark.parametrize("x,n", [(None, 10), (1000.0, None), (1000.0, 0)])
def test_emission_score_null(spark, x, n):
    assert _one(spark, carbon_score_emission("x", "n"), [(x, n)], "x double, n bigint") == [None]


def test_emission_score_valid(spark):
    [v] = _one(spark, carbon_score_emission("x", "n"), [(1000000.0, 10)], "x double, n bigint")
    assert v is not None and v > 0 and v == 5.71


@pytest.mark.parametrize("x,n,expected", [
    (1000000.0, 10, 100.0), (1000.0, 10, 2.0), (125.0, 5, 0.5), (12.5, 5, 0.0),
    (37.5, 5, 0.2), (-50.0, 1, -1.0), (None, 3, None), (3.0, None, None), (3.0, 0, None),
])
def test_normalised_score(spark, x, n, expected):
    assert _one(spark, carbon_score_normalised("x", "n"), [(x, n)], "x double, n bigint") == [expected]


def test_sql_functions_inline(spark):
    names = register_sql_functions(spark)
    assert "categorize_consumption_udf" in names and "compute_carbon_score_udf" in names
    df = spark.createDataFrame([(500.0, 5), (None, 1)], "x double, n bigint")
    out = df.selectExpr("categorize_consumption(x) c", "carbon_score_normalised(x, n) s",
                        "compute_carbon_score_udf(x, n) s2")
    assert [tuple(r) for r in out.collect()] == [("TRES FAIBLE", 2.0, 2.0), ("INCONNU", None, None)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


finite = st.one_of(st.none(), st.floats(min_value=-1e9, max_value=1e9, allow_nan=False))


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(finite, st.one_of(st.none(), st.integers(-1000, 1000))), min_size=1, max_size=40))
def test_native_equals_model(spark, rows):
    df = spark.createDataFrame(rows, "x double, n bigint")
    got = df.select(categorize("x"), carbon_score_normalised("x", "n")).collect()
    for (x, n), (c, s) in zip(rows, got):
        assert c == model_category(x)
        m = model_normalised(x, n)
        assert (s is None and m is None) or math.isclose(s, m, abs_tol=1e-9)
