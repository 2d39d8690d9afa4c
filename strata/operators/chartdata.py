"""Chart-ready frames built from the KPI frames (the data half of charts).

Inputs are already aggregated (a handful of rows), so the global max / mean
used for axis limits and reference lines are windows over those rows.
Labels are built from decimals rounded half-up, so they read the same in
every engine; the numbers are delivered next to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scoring import CATEGORY_UNKNOWN

# Display scale (billions), axis headroom factors, top-k of
# the ranking chart, colours (hex) of the category and ranking charts.
DISPLAY_DIVISOR = 1_000_000_000
TREND_HEADROOM = 1.3
CATEGORY_HEADROOM = 1.5
RANKING_HEADROOM = 1.4
RANKING_TOP_K = 3
COLOUR_DARK = "#003189"
COLOUR_MID = "#0070C0"
COLOUR_LIGHT = "#00AEEF"
COLOUR_OTHER = "#AAAAAA"
CATEGORY_COLOURS = {"TRES ELEVEE": COLOUR_DARK, "ELEVEE": COLOUR_MID, "MODEREE": COLOUR_LIGHT}
UP_CLASS, DOWN_CLASS = "up", "down"
UNIT_LABEL = "bn Wh"


def _all_rows():
    return Window.partitionBy()


def fixed(c: Column, decimals: int) -> Column:
    """Text of ``c`` rounded half-up to ``decimals`` places (always that many)."""
    return F.round(c, decimals).cast(f"decimal(38,{decimals})").cast("string")


def _billions(c: str) -> Column:
    return F.col(c) / F.lit(float(DISPLAY_DIVISOR))


def chart_region_year_matrix(kpi: DataFrame, region: str = "region", year: str = "annee",
                             value: str = "energy_total", years: list[int] | None = None) -> DataFrame:
    """Region rows x one column per year (mean of the value, in billions).

    Rows with a NULL region or year are left out; rows are ordered by the sum
    of their year columns (missing cells count as 0), largest first.

    Without ``years`` the pivot first runs a job for the distinct years of
    its input, so pass a stored KPI table (as the Gold layer writes it) or
    the list of years, not a lazy aggregation over the full data.
    """
    keyed = kpi.filter(F.col(region).isNotNull() & F.col(year).isNotNull())
    wide = keyed.groupBy(region).pivot(year, years).agg(F.avg(F.col(value)))
    year_cols = [c for c in wide.columns if c != region]
    wide = wide.select(region, *[(F.col(f"`{c}`") / F.lit(float(DISPLAY_DIVISOR))).alias(c)
                                 for c in year_cols])
    row_total = sum((F.coalesce(F.col(f"`{c}`"), F.lit(0.0)) for c in year_cols), F.lit(0.0))
    return wide.orderBy(row_total.desc())


def chart_trend_series(kpi: DataFrame, year: str = "annee", value: str = "energy_total",
                       change: str = "yoy_pct") -> DataFrame:
    """Yearly series in billions with labels, change class and axis limit."""
    bn = _billions(value)
    chg = F.col(change)
    sign = F.when(chg > 0, F.lit("+")).otherwise(F.lit(""))
    return kpi.select(
        F.col(year), bn.alias("energy_bn"),
        F.concat(fixed(bn, 1), F.lit(f" {UNIT_LABEL}")).alias("energy_label"),
        chg.alias(change),
        F.when(chg > 0, F.lit(UP_CLASS)).when(chg.isNotNull(), F.lit(DOWN_CLASS)).alias("change_class"),
        F.when(chg.isNotNull(), F.concat(sign, fixed(chg, 1), F.lit("%"))).alias("change_label"),
        (F.max(bn).over(_all_rows()) * F.lit(TREND_HEADROOM)).alias("axis_max"),
    ).orderBy(year)


def chart_category_share(kpi: DataFrame, category: str = "consumption_category",
                         value: str = "energy_total", share: str = "pct_of_total",
                         exclude: str = CATEGORY_UNKNOWN) -> DataFrame:
    """Category bars/pie: unknown category left out, colour per label."""
    kept = kpi.filter(~F.col(category).eqNullSafe(F.lit(exclude)))
    bn = _billions(value)
    colour = F.lit(COLOUR_OTHER)
    for label, hex_code in reversed(list(CATEGORY_COLOURS.items())):
        colour = F.when(F.col(category) == F.lit(label), F.lit(hex_code)).otherwise(colour)
    return kept.select(
        F.col(category), bn.alias("energy_bn"), F.col(share),
        F.concat(fixed(bn, 1), F.lit(f" {UNIT_LABEL}  ("), fixed(F.col(share), 2), F.lit("%)"))
         .alias("label"),
        colour.alias("colour"),
        (F.max(bn).over(_all_rows()) * F.lit(CATEGORY_HEADROOM)).alias("axis_max"),
    ).orderBy(F.col(value).asc_nulls_first())


def chart_region_ranking(kpi: DataFrame, region: str = "region", value: str = "energy_total",
                         rank: str = "ranking", k: int = RANKING_TOP_K) -> DataFrame:
    """Ranking bars: top-k flag and colour, labels, mean line and axis limit."""
    bn = _billions(value)
    top = F.coalesce(F.col(rank) <= F.lit(k), F.lit(False))
    return kpi.select(
        F.col(region), bn.alias("energy_bn"), F.col(rank),
        top.alias("is_top_k"),
        F.when(top, F.lit(COLOUR_DARK)).otherwise(F.lit(COLOUR_LIGHT)).alias("colour"),
        F.concat(fixed(bn, 2), F.lit(f" {UNIT_LABEL}  (rank "), F.col(rank).cast("string"), F.lit(")"))
         .alias("label"),
        F.avg(bn).over(_all_rows()).alias("mean_bn"),
        (F.max(bn).over(_all_rows()) * F.lit(RANKING_HEADROOM)).alias("axis_max"),
    ).orderBy(F.col(value).asc_nulls_first())
