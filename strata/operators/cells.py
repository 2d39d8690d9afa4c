"""Complementary cell suppression: a hidden KPI cell cannot be got by subtraction.

A cell of a two-way KPI table (say region and year) is sensitive when it stands
for too few sites. Hiding it alone is not enough where totals are published:
with one hidden cell in a year, the year's total less the other cells gives it
away. Of the hidden cells of a table, the totals determine exactly those that
lie on no cycle of hidden cells (cells as edges between their row and column).

* Totals per column only: a column with one sensitive cell hides one more.
* Totals per row and column: every sensitive cell becomes a corner of a
  rectangle of hidden cells, which is such a cycle.

The cells hidden in addition are those of least size (already hidden ones
first, ties by name). Where there is no such partner (a year with one region), the
totals of the cell's lines are hidden instead. Everything is joins and aggregates
over KPI-sized frames; nothing is collected. Only exact values are protected, not
the bounds that non-negative figures imply.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRIMARY, SECONDARY = "primary", "secondary"
#: Columns that the functions add: why a cell is hidden, and whether its lines' totals are, too.
HIDDEN, BARE = "hidden", "hide_totals"
_R, _C, _SIZE, _SENSITIVE = "r", "c", "size", "sensitive"


def _cells(df: DataFrame, row: str, column: str, size: str, threshold: int) -> DataFrame:
    """(r, c, size, sensitive); an unknown size is sensitive."""
    n = F.col(size)
    return df.select(F.col(row).alias(_R), F.col(column).alias(_C), F.coalesce(n, F.lit(0)).alias(_SIZE),
                     F.coalesce(n < threshold, F.lit(True)).alias(_SENSITIVE))


def _cost(c: DataFrame) -> Column:
    """What hiding a further cell takes away: nothing if it is sensitive anyway."""
    return F.when(c[_SENSITIVE], F.lit(0)).otherwise(c[_SIZE] + 1)


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _column_partners(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One more cell for every column with a single sensitive one: (partners, bare cells)."""
    free = F.when(~F.col(_SENSITIVE), F.struct(F.col(_SIZE), F.col(_R)))
    lines = cells.groupBy(_C).agg(F.count_if(_SENSITIVE).alias("n"), F.min(free).alias("least"),
                                  F.min(F.when(F.col(_SENSITIVE), F.struct(_R))).alias("one"))
    alone = lines.filter("n = 1")
    partners = alone.filter("least IS NOT NULL").select(F.col(f"least.{_R}").alias(_R), _C)
    return partners, alone.filter("least IS NULL").select(F.col(f"one.{_R}").alias(_R), _C)


def _rectangles(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cheapest rectangle of every sensitive cell: (its other corners, bare cells)."""
    p = cells.filter(_SENSITIVE).alias("p")
    a, b, d = cells.alias("a"), cells.alias("b"), cells.alias("d")
    met = (p.join(a, _same(F.col("p.r"), F.col("a.r")) & ~_same(F.col("p.c"), F.col("a.c")))
           .join(b, _same(F.col("p.c"), F.col("b.c")) & ~_same(F.col("p.r"), F.col("b.r")))
           .join(d, _same(F.col("b.r"), F.col("d.r")) & _same(F.col("a.c"), F.col("d.c"))))
    cost = sum((F.when(F.col(f"{x}.sensitive"), F.lit(0)).otherwise(F.col(f"{x}.size") + 1)
                for x in "abd"), F.lit(0))
    best = (met.groupBy(F.col("p.r").alias("pr"), F.col("p.c").alias("pc"))
            .agg(F.min(F.struct(cost.alias("cost"), F.col("b.r").alias("r2"), F.col("a.c").alias("c2")))
                 .alias("best")))
    corners = best.select(F.explode(F.array(
        F.struct(F.col("pr").alias(_R), F.col("best.c2").alias(_C)),
        F.struct(F.col("best.r2").alias(_R), F.col("pc").alias(_C)),
        F.struct(F.col("best.r2").alias(_R), F.col("best.c2").alias(_C)))).alias("x")).select("x.*")
    bare = cells.filter(_SENSITIVE).alias("q").join(
        best, _same(F.col("q.r"), F.col("pr")) & _same(F.col("q.c"), F.col("pc")), "left_anti")
    return corners, bare.select(_R, _C)


def hidden_cells(df: DataFrame, row: str, column: str, size: str, threshold: int,
                 row_totals: bool = False) -> DataFrame:
    """(row, column, hidden, hide_totals) of every cell that must not be published.

    Totals per ``column`` are published, with ``row_totals`` those per row, too.
    ``hide_totals`` marks cells whose lines' totals have to go as well.
    """
    cells = _cells(df, row, column, size, threshold)
    partners, bare = _rectangles(cells) if row_totals else _column_partners(cells)
    marks = (cells.filter(_SENSITIVE).select(_R, _C, F.lit(True).alias("first"), F.lit(False).alias("alone"))
             .union(partners.select(_R, _C, F.lit(False), F.lit(False)))
             .union(bare.select(_R, _C, F.lit(True), F.lit(True))))
    return marks.groupBy(_R, _C).agg(F.max("first").alias("first"), F.max("alone").alias(BARE)).select(
        F.col(_R).alias(row), F.col(_C).alias(column),
        F.when(F.col("first"), PRIMARY).otherwise(SECONDARY).alias(HIDDEN), BARE)


def _without(df: DataFrame, marks: DataFrame, keys: list[str], figures: list[str], why: Column) -> DataFrame:
    """``df`` with ``figures`` NULL where a mark has the same keys."""
    m = marks.select(*[F.col(k).alias(f"_{k}") for k in keys], why.alias("_why"))
    same = F.lit(True)
    for k in keys:
        same = same & df[k].eqNullSafe(m[f"_{k}"])
    gone = F.col("_why").isNotNull()
    return df.join(m, same, "left").select(
        *[F.when(~gone, F.col(c)).alias(c) if c in figures else F.col(c) for c in df.columns],
        F.col("_why").alias(HIDDEN))


def suppress_cells(df: DataFrame, row: str, column: str, size: str, threshold: int,
                   figures: list[str], row_totals: bool = False) -> DataFrame:
    """``df`` with the figures of hidden cells NULL and ``hidden`` saying why."""
    marks = hidden_cells(df, row, column, size, threshold, row_totals)
    return _without(df, marks, [row, column], figures, F.col(HIDDEN))


def suppress_kpis(region_year: DataFrame, national: DataFrame, top: DataFrame, region: str, year: str,
                  threshold: int, size: str = "sites_total") -> dict[str, DataFrame]:
    """The region-year KPI, the national trend and the ranking, safe to publish together.

    The ranking shows the cells of the latest year, so it hides those that the
    region-year table hides there. The trend is the total per year; a year whose one sensitive
    cell has no partner loses its total, and the change of the year after it goes, too. If
    that is the only year without a total, the year of the fewest sites loses its own as well,
    since the category shares still give the sum of all years.
    """
    marks = hidden_cells(region_year, region, year, size, threshold)
    keep = (region, year, "annee", "region")
    cells = _without(region_year, marks, [region, year],
                     [c for c in region_year.columns if c not in keep], F.col(HIDDEN))
    latest = region_year.select(F.max(year)).scalar()
    ranking = _without(top, marks.filter(F.col(year) == latest), [region],
                       [c for c in top.columns if c != region], F.col(HIDDEN))
    bare = marks.filter(BARE).select(year).distinct()
    sizes = region_year.groupBy(year).agg(F.sum(F.coalesce(F.col(size), F.lit(0))).alias("n"))
    single = bare.agg(F.count(F.lit(1)) == 1).scalar()
    partner = (sizes.join(bare, sizes[year].eqNullSafe(bare[year]), "left_anti").filter(single)
               .orderBy("n", year).limit(1).select(year))
    bare = bare.union(partner)
    order = national.select(F.col(year).alias("y")).distinct()
    after = (order.alias("n").join(bare.alias("b"), F.col("n.y") > F.col(f"b.{year}"))
             .groupBy(F.col(f"b.{year}").alias("of")).agg(F.min("n.y").alias(year)).select(year))
    totals = _without(national, bare, [year], [c for c in national.columns if c != year], F.lit(PRIMARY))
    changes = after.join(bare, year, "left_anti").distinct()
    totals = _without(totals.withColumnRenamed(HIDDEN, "_first"), changes, [year], ["yoy_pct"],
                      F.lit(SECONDARY))
    totals = totals.withColumn(HIDDEN, F.coalesce("_first", HIDDEN)).drop("_first")
    return {"region_year": cells, "national_trend": totals, "top_regions": ranking}
