"""Complementary suppression: linear algebra finds no sensitive cell that the totals give away."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import cells, kpi

SCHEMA = "region string, annee int, energy_total double, n_records bigint, sites_total bigint"


def recoverable(table, hidden, lines):
    """Hidden cells that the published totals of ``lines`` (lists of cells) determine."""
    unknown = sorted(hidden, key=str)
    at = {k: i for i, k in enumerate(unknown)}
    rows = [[float(k in line) for k in unknown] for line in lines if any(k in at for k in line)]
    if not rows:
        return set()
    a = np.array(rows)
    rank = np.linalg.matrix_rank(a)
    return {k for k in unknown if np.linalg.matrix_rank(np.vstack([a, np.eye(len(unknown))[at[k]]])) == rank}


def some_table(pick, rows, columns, holes):
    table = {}
    for r, c in itertools.product(range(rows), range(columns)):
        if pick.random() >= holes:
            table[f"r{r}" if r else None, 2000 + c if c else None] = pick.choice([1, 2, 3, 4, 5, 9, 40, 80, None])
    return table


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("row_totals", [False, True])
def test_no_sensitive_cell_is_determined(spark, seed, row_totals):
    pick = random.Random(100 * seed + row_totals)
    table = some_table(pick, pick.randint(1, 5), pick.randint(1, 5), pick.choice([0, 0.3]))
    data = [(r, c, 1.0, 1, n) for (r, c), n in table.items()]
    marks = cells.hidden_cells(spark.createDataFrame(data, SCHEMA), "region", "annee", "sites_total", 4,
                               row_totals).collect()
    hidden = {(m.region, m.annee): m for m in marks}
    first = {k for k, n in table.items() if n is None or n < 4}
    assert {k for k, m in hidden.items() if m.hidden == cells.PRIMARY} == first
    bare = {k for k, m in hidden.items() if m.hide_totals}
    lines = [[k for k in table if k[1] == c] for c in {c for _, c in table} - {c for _, c in bare}]
    if row_totals:
        lines += [[k for k in table if k[0] == r] for r in {r for r, _ in table} - {r for r, _ in bare}]
    assert not recoverable(table, set(hidden), lines) & first
    for r, c in bare:  # totals go only where no partner exists
        others = [k for k in table if k[1] == c and k[0] != r]
        corners = [(k, (r, y)) for k in others for y in {y for _, y in table}
                   if y != c and (r, y) in table and (k[0], y) in table]
        assert not (corners if row_totals else others)


def test_least_cell_is_added_and_nothing_else(spark):
    df = spark.createDataFrame([("a", 2000, 5.0, 1, 2), ("b", 2000, 7.0, 1, 9), ("c", 2000, 8.0, 1, 6),
                                ("a", 2001, 1.0, 1, 9), ("b", 2001, 2.0, 1, 9)], SCHEMA)
    out = cells.suppress_cells(df, "region", "annee", "sites_total", 5, ["energy_total", "sites_total"])
    assert sorted((r.annee, r.region, r.energy_total, r.sites_total, r.hidden) for r in out.collect()) == [
        (2000, "a", None, None, "primary"), (2000, "b", 7.0, 9, None), (2000, "c", None, None, "secondary"),
        (2001, "a", 1.0, 9, None), (2001, "b", 2.0, 9, None)]


def test_kpis_published_together(spark):
    rows = [("a", "2000", 1.0, 2), ("a", "2001", 3.0, 9), ("b", "2001", 5.0, 20), ("a", "2002", 2.0, 3),
            ("b", "2002", 6.0, 30), ("c", "2002", 7.0, 11), ("a", "2003", 9.0, 50), ("b", "2003", 9.5, 60)]
    silver = spark.createDataFrame(rows, "region string, annee string, e double, s bigint").select(
        "region", F.col("annee").cast("int").alias("annee"), (F.col("e") * 1_000_000).alias("total_energie_soutiree_wh"),
        F.col("s").alias("nb_points_soutirage"))
    k1, k2 = kpi.kpi_region_year(silver), kpi.kpi_national_trend(silver)
    safe = cells.suppress_kpis(k1, k2, kpi.kpi_top_regions(silver.filter("annee < 2003")), "region", "annee", 5)
    got = {(r.region, r.annee): r.hidden for r in safe["region_year"].collect() if r.hidden}
    assert got == {("a", 2000): "primary", ("a", 2002): "primary", ("c", 2002): "secondary"}
    trend = {r.annee: (r.energy_total, r.yoy_pct, r.hidden) for r in safe["national_trend"].collect()}
    # 2000 stands alone, so its total goes; 2001 has the fewest sites of the others and goes with it
    assert trend[2000] == (None, None, "primary") and trend[2001] == (None, None, "primary")
    assert trend[2002][0] == 15e6 and trend[2002][1:] == (None, "secondary")
    assert trend[2003][0] == 18.5e6 and trend[2003][1] is not None and trend[2003][2] is None


def test_ranking_hides_the_cells_of_the_latest_year(spark):
    rows = [("a", 2001, 2.0, 1, 3), ("b", 2001, 6.0, 1, 30), ("c", 2001, 7.0, 1, 11), ("a", 2000, 2.0, 1, 30)]
    k1 = spark.createDataFrame(rows, SCHEMA)
    top = spark.createDataFrame([("c", 7.0, 11, 1), ("b", 6.0, 30, 2), ("a", 2.0, 3, 3)],
                                "region string, energy_total double, sites_total bigint, ranking int")
    national = k1.groupBy("annee").agg(F.sum("energy_total").alias("energy_total")).withColumn("yoy_pct", F.lit(1.0))
    safe = cells.suppress_kpis(k1, national, top, "region", "annee", 5)["top_regions"]
    assert sorted((r.region, r.energy_total, r.ranking, r.hidden) for r in safe.collect()) == [
        ("a", None, None, "primary"), ("b", 6.0, 2, None), ("c", None, None, "secondary")]


def test_empty_table(spark):
    assert cells.hidden_cells(spark.createDataFrame([], SCHEMA), "region", "annee", "sites_total", 5).count() == 0
