"""Banding and scoring of a measure as native Spark expressions.

The same definitions are offered three ways: as ``Column`` builders, as SQL
text, and as session-scoped SQL functions (``CREATE TEMPORARY FUNCTION ...
RETURN``) that Catalyst inlines, so they run inside whole-stage codegen with
no Python worker in the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Consumption bands (exclusive upper bound in Wh, label), the
# label above the last bound, and the label for a missing measure.
CATEGORY_BANDS = (
    (1000.0, "TRES FAIBLE"),
    (5000.0, "FAIBLE"),
    (20000.0, "MODEREE"),
    (100000.0, "ELEVEE"),
)
CATEGORY_TOP = "TRES ELEVEE"
CATEGORY_UNKNOWN = "INCONNU"

# Normalised score = per-site measure / 50, one decimal, capped.
NORMALISED_DIVISOR = 50.0
NORMALISED_CAP = 100.0
# Emission factor per kWh for the emission score, two decimals.
EMISSION_FACTOR = 0.0571
EMISSION_DECIMALS = 2

# SQL names under which ``register_sql_functions`` exposes the definitions;
# the ``*_udf`` names keep existing SQL text working unchanged.
SQL_NAMES = {
    "categorize": ("categorize_consumption", "categorize_consumption_udf"),
    "normalised": ("carbon_score_normalised", "compute_carbon_score_udf"),
    "emission": ("carbon_score_emission",),
}


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def categorize(measure: Column | str) -> Column:
    """Band label of a measure; NULL gives the unknown label.

    Bounds are exclusive upward (1000 falls in the second band); negatives
    land in the first band and NaN (greater than every number in Spark) in
    the top band.
    """
    m = _c(measure)
    out = F.when(m.isNull(), F.lit(CATEGORY_UNKNOWN))
    for bound, label in CATEGORY_BANDS:
        out = out.when(m < F.lit(bound), F.lit(label))
    return out.otherwise(F.lit(CATEGORY_TOP))


def _usable(measure: Column, sites: Column) -> Column:
    return measure.isNotNull() & sites.isNotNull() & (sites != 0)


def carbon_score_normalised(measure: Column | str, sites: Column | str) -> Column:
    """min(100, round_half_even(measure / sites / 50, 1)); NULL when unusable.

    Half-to-even at one decimal is taken on the value times ten, which is
    what ``bround(v, 0)`` does; there is no lower cap.
    """
    m, n = _c(measure).cast("double"), _c(sites)
    per_site = m / n.cast("double")
    scaled = F.bround(per_site / F.lit(NORMALISED_DIVISOR) * F.lit(10.0), 0) / F.lit(10.0)
    return F.when(_usable(m, n), F.least(F.lit(NORMALISED_CAP), scaled))


def carbon_score_emission(measure_wh: Column | str, sites: Column | str) -> Column:
    """round(measure_wh / 1000 * factor / sites, 2); NULL when unusable."""
    m, n = _c(measure_wh).cast("double"), _c(sites)
    value = m / F.lit(1000.0) * F.lit(EMISSION_FACTOR) / n.cast("double")
    return F.when(_usable(m, n), F.round(value, EMISSION_DECIMALS))


# --- SQL text of the same definitions -------------------------------------

def categorize_sql(arg: str) -> str:
    parts = [f"WHEN {arg} IS NULL THEN '{CATEGORY_UNKNOWN}'"]
    parts += [f"WHEN {arg} < {bound!r} THEN '{label}'" for bound, label in CATEGORY_BANDS]
    return "CASE " + " ".join(parts) + f" ELSE '{CATEGORY_TOP}' END"


def _usable_sql(m: str, n: str) -> str:
    return f"{m} IS NOT NULL AND {n} IS NOT NULL AND {n} <> 0"


def carbon_score_normalised_sql(m: str, n: str) -> str:
    scaled = (f"bround(CAST({m} AS DOUBLE) / CAST({n} AS DOUBLE) / {NORMALISED_DIVISOR!r}"
              f" * 10.0, 0) / 10.0")
    return f"CASE WHEN {_usable_sql(m, n)} THEN least({NORMALISED_CAP!r}, {scaled}) END"


def carbon_score_emission_sql(m: str, n: str) -> str:
    value = f"CAST({m} AS DOUBLE) / 1000.0 * {EMISSION_FACTOR!r} / CAST({n} AS DOUBLE)"
    return f"CASE WHEN {_usable_sql(m, n)} THEN round({value}, {EMISSION_DECIMALS}) END"


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the scoring functions as temporary SQL functions; return their names."""
    bodies = {
        "categorize": ("x DOUBLE", "STRING", categorize_sql("x")),
        "normalised": ("x DOUBLE, n BIGINT", "DOUBLE", carbon_score_normalised_sql("x", "n")),
        "emission": ("x DOUBLE, n BIGINT", "DOUBLE", carbon_score_emission_sql("x", "n")),
    }
    created = []
    for key, (params, returns, body) in bodies.items():
        for name in SQL_NAMES[key]:
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) "
                      f"RETURNS {returns} RETURN {body}")
            created.append(name)
    return created
