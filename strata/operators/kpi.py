"""The four KPI queries over a cleaned (Silver) frame.

Each one is a single two-phase aggregation (partial aggregate per task, one
shuffle on the group keys) followed by rounding and, where needed, one
window over the aggregated rows. Every KPI also accepts ``gold_base`` in place
of the rows: sums and counts per region, year, category and profile, so one
pass over Silver serves all four. ``ordered`` sorts the result for reading;
stored tables are written unsorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import derive_year
from ..spec import Roles, first_present
from .windows import lag_previous_period, pct_change, rank_desc, share_of_total

# Scale of the national total and the rounding of each figure.
NATIONAL_UNIT_DIVISOR = 1_000_000
TOTAL_DECIMALS = 2
SCALED_DECIMALS = 4
PCT_DECIMALS = 2


def with_year(df: DataFrame, roles: Roles, business_tz: str | None = None) -> DataFrame:
    """Add the year column from the timestamp role when it is not there yet."""
    if roles.year in df.columns or not roles.timestamp or roles.timestamp not in df.columns:
        return df
    return derive_year(df, roles.timestamp, roles.year, business_tz)


# Columns of the shared base: sum and number of measures, rows, sum of sites.
_SUM, _VALUED, _ROWS, _SITES = "_measure_sum", "_measure_count", "_row_count", "_sites_sum"


def gold_base(df: DataFrame, roles: Roles = Roles(), business_tz: str | None = None) -> DataFrame:
    """Unrounded sums and counts per (region, year, category, profile), as far as present.

    One two-phase aggregation over the rows; every KPI can be derived from
    the result, which holds at most regions x years x categories x profiles rows.
    """
    df = with_year(df, roles, business_tz)
    keys = [c for c in (roles.region, roles.year, roles.category, roles.profile) if _has(df, c)]
    aggs = [F.count(F.lit(1)).alias(_ROWS)]
    if _has(df, roles.measure):
        aggs += [F.sum(F.col(roles.measure)).alias(_SUM), F.count(F.col(roles.measure)).alias(_VALUED)]
    if _has(df, roles.sites):
        aggs.append(F.sum(F.col(roles.sites)).alias(_SITES))
    return df.groupBy(*keys).agg(*aggs)


def _has(df: DataFrame, *names: str | None) -> bool:
    return all(n and n in df.columns for n in names)


def _has_measure(df: DataFrame, roles: Roles) -> bool:
    return _has(df, roles.measure) or _has(df, _SUM)


def _total(df: DataFrame, roles: Roles) -> Column:
    return F.sum(F.col(_SUM if _SUM in df.columns else roles.measure))


def _mean(df: DataFrame, roles: Roles) -> Column:
    if _SUM not in df.columns:
        return F.avg(F.col(roles.measure))
    return F.sum(_SUM) / F.nullif(F.sum(_VALUED), F.lit(0))


def _records(df: DataFrame) -> Column:
    return F.sum(_ROWS) if _ROWS in df.columns else F.count(F.lit(1))


def _sites(df: DataFrame, roles: Roles) -> Column | None:
    name = next((c for c in (_SITES, roles.sites) if _has(df, c)), None)
    return F.sum(F.col(name)) if name else None


def kpi_region_year(df: DataFrame, roles: Roles = Roles(), ordered: bool = True) -> DataFrame | None:
    """Per region and year: total, mean, record count, sites and total per site.

    Totals and means are rounded to 2 places; the per-site figure divides the
    *rounded* total and is NULL when the sites total is NULL or not positive.
    None when a needed column is missing.
    """
    df = with_year(df, roles)
    if not (_has(df, roles.region, roles.year) and _has_measure(df, roles)):
        return None
    sites = _sites(df, roles)
    aggs = [_total(df, roles).alias("energy_total"), _mean(df, roles).alias("energy_mean"),
            _records(df).alias("n_records")]
    if sites is not None:
        aggs.append(sites.alias("sites_total"))
    g = df.groupBy(roles.region, roles.year).agg(*aggs)
    total = F.round("energy_total", TOTAL_DECIMALS)
    cols = [roles.region, roles.year, total.alias("energy_total"),
            F.round("energy_mean", TOTAL_DECIMALS).alias("energy_mean"), "n_records"]
    if sites is not None:
        per_site = F.when(F.col("sites_total") > 0, total / F.col("sites_total"))
        cols += ["sites_total", F.round(per_site, TOTAL_DECIMALS).alias("energy_per_site")]
    out = g.select(cols)
    return out.orderBy(roles.region, roles.year) if ordered else out


def kpi_national_trend(df: DataFrame, roles: Roles = Roles(),
                       unit_divisor: float = NATIONAL_UNIT_DIVISOR,
                       total_decimals: int | None = None,
                       strict_calendar: bool = False, ordered: bool = True) -> DataFrame | None:
    """Per year: total, record count, scaled total and change on the previous row.

    The scaled total is round(total / unit_divisor, 4); the change is taken
    on the rounded scaled totals, in percent, rounded to 2, and is NULL for
    the first year or after a zero. The total itself is left unrounded unless
    ``total_decimals`` is given (floating sums depend on summation order).
    """
    df = with_year(df, roles)
    if not (_has(df, roles.year) and _has_measure(df, roles)):
        return None
    g = df.groupBy(roles.year).agg(_total(df, roles).alias("energy_total"),
                                   _records(df).alias("n_records"))
    g = g.withColumn("energy_scaled",
                     F.round(F.col("energy_total") / F.lit(float(unit_divisor)), SCALED_DECIMALS))
    if total_decimals is not None:
        g = g.withColumn("energy_total", F.round("energy_total", total_decimals))
    g = lag_previous_period(g, roles.year, "energy_scaled", "_prev", strict_calendar=strict_calendar)
    out = g.withColumn("yoy_pct", pct_change(F.col("energy_scaled"), F.col("_prev"), PCT_DECIMALS)).drop("_prev")
    return out.orderBy(roles.year) if ordered else out


def category_column(df: DataFrame, roles: Roles) -> str | None:
    """The category column: the computed category, else the profile, else none."""
    return first_present(df, [roles.category, roles.profile])


def kpi_category_share(df: DataFrame, roles: Roles = Roles(),
                       category: str | None = None, ordered: bool = True) -> DataFrame | None:
    """Per category: record count, rounded total and share of all rounded totals."""
    cat = category or category_column(df, roles)
    if not (_has(df, cat) and _has_measure(df, roles)):
        return None
    g = df.groupBy(cat).agg(_records(df).alias("n_records"),
                            F.round(_total(df, roles), TOTAL_DECIMALS).alias("energy_total"))
    out = share_of_total(g, "energy_total", "pct_of_total", PCT_DECIMALS)
    return out.orderBy(F.col("energy_total").desc_nulls_last()) if ordered else out


def kpi_top_regions(df: DataFrame, roles: Roles = Roles(), ordered: bool = True) -> DataFrame | None:
    """Regions of the latest year, ranked by rounded total (ties share a rank).

    The latest year is a scalar subquery inside the same plan; on a table
    partitioned by year the equality becomes a partition filter.
    """
    df = with_year(df, roles)
    if not (_has(df, roles.region, roles.year) and _has_measure(df, roles)):
        return None
    latest = df.select(F.max(F.col(roles.year))).scalar()
    sites = _sites(df, roles)
    sites = (F.lit(None).cast("bigint") if sites is None else sites).alias("sites_total")
    g = (df.filter(F.col(roles.year) == latest)
           .groupBy(roles.region)
           .agg(F.round(_total(df, roles), TOTAL_DECIMALS).alias("energy_total"), sites))
    out = rank_desc(g, "energy_total", "ranking")
    return out.orderBy("ranking") if ordered else out


def latest_year(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """One row: the greatest year (NULL for an empty input)."""
    df = with_year(df, roles)
    return df.agg(F.max(F.col(roles.year)).alias("latest_year"))


def latest_year_rows(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Rows of the greatest year (none when the input is empty)."""
    df = with_year(df, roles)
    return df.filter(F.col(roles.year) == df.select(F.max(F.col(roles.year))).scalar())
