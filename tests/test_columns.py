import pytest
from pyspark.sql import functions as F

from strata.functions.columns import (cast_measures, derive_year, drop_audit_columns, numeric_columns,
                                      standardize_column_names, standardize_name)
from strata.spec import detect_column, detect_roles


def test_accented_headers(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["Région", "Total énergie soutirée (Wh)",
                                                 "Nb points soutirage", "_x"])
    assert standardize_column_names(df).columns == ["region", "total_energie_soutiree_wh",
                                                     "nb_points_soutirage", "x"]


def test_name_rules():
    assert standardize_name("œuvre") == "uvre"
    assert standardize_name("__A--b__") == "a_b"


@pytest.mark.parametrize("cols", [["A b", "a-b"], ["°", "y"]])
def test_bad_headers_raise(spark, cols):
    df = spark.createDataFrame([(1, 2)], cols)
    with pytest.raises(ValueError):
        standardize_column_names(df)


def test_drop_audit_before_rename(spark):
    df = spark.createDataFrame([(1, "t", 2)], ["a", "_source_dataset", "_x"])
    assert standardize_column_names(drop_audit_columns(df)).columns == ["a", "x"]


def test_casts(spark):
    df = spark.createDataFrame([("12.0", "3.5"), ("7", "1e3"), (None, None)], "n string, m string")
    out = cast_measures(df, doubles=["m"], longs=["n"]).collect()
    assert [tuple(r) for r in out] == [(12, 3.5), (7, 1000.0), (None, None)]
    bad = spark.createDataFrame([("x", "y")], "n string, m string")
    assert [tuple(r) for r in cast_measures(bad, ["m"], ["n"], strict=False).collect()] == [(None, None)]
    with pytest.raises(Exception):
        cast_measures(bad, ["m"], ["n"]).collect()


def test_year_time_zones(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00+01:00",)], "h string")
    assert derive_year(df, "h").first()["annee"] == 2023  # session zone is UTC in tests
    assert derive_year(df, "h", business_tz="Europe/Paris").first()["annee"] == 2024


def test_numeric_columns(spark):
    df = spark.createDataFrame([(1, 1.0, "a")], "a int, b double, c string") \
        .withColumn("d", F.lit(1).cast("short")).withColumn("e", F.lit(1).cast("decimal(5,2)"))
    assert numeric_columns(df) == ["a", "b"]


def test_detect_column():
    cols = ["Horodate", "region", "total_energie_soutiree_wh"]
    assert detect_column(cols, "energie", "conso") == "total_energie_soutiree_wh"
    assert detect_column(cols, "absent", "horo") == "Horodate"
    assert detect_column(cols, "Horo") is None  # keywords are not lower-cased


def test_detect_roles(spark):
    df = spark.createDataFrame([("r", "2024", 1.0, 5)],
                               ["region", "horodate", "total_energie_soutiree_wh", "nb_points_soutirage"])
    roles = detect_roles(df)
    assert (roles.measure, roles.timestamp, roles.region, roles.sites, roles.profile) == \
        ("total_energie_soutiree_wh", "horodate", "region", "nb_points_soutirage", None)
    assert roles.year == "annee"


def test_scale_settings():
    from strata.session import scale_settings

    big = scale_settings(100 * 1024 ** 4, 8000)
    assert big["spark.sql.shuffle.partitions"] == "409600"
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 256 * 1024 * 1024
    small = scale_settings(10 * 1024 ** 2, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"


from hypothesis import given
from hypothesis import strategies as st


@given(st.text(max_size=30))
def test_standardize_name_properties(name):
    out = standardize_name(name)
    assert out == out.lower() and out.isascii()
    assert not out.startswith("_") and not out.endswith("_") and "__" not in out
    assert standardize_name(out) == out
