"""Column-level operators: audit drop, name standardisation, casts, year.

Renaming works on the schema only (driver metadata); casts and the year are
plain projections that stay inside whole-stage codegen.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Audit columns added by the Bronze layer.
BRONZE_AUDIT_COLUMNS = (
    "_ingestion_timestamp",
    "_ingestion_date",
    "_source_dataset",
    "_source_url",
    "_source_description",
)

_NON_ALNUM = re.compile(r"[^A-Za-z0-9]+")


def standardize_name(name: str) -> str:
    """ASCII snake-case of a header.

    Accents are split off by NFD and dropped with every other non-ASCII
    character (so a letter without decomposition, such as the oe ligature,
    disappears); each run of non-alphanumerics becomes one underscore; the
    result is lower-cased and stripped of outer underscores.
    """
    ascii_only = unicodedata.normalize("NFD", name).encode("ascii", "ignore").decode("ascii")
    return _NON_ALNUM.sub("_", ascii_only).lower().strip("_")


def standardized_names(columns: list[str]) -> list[str]:
    """Standardised names, refusing empty results and collisions."""
    new = [standardize_name(c) for c in columns]
    empty = [old for old, n in zip(columns, new) if not n]
    if empty:
        raise ValueError(f"columns with no usable characters: {empty}")
    seen: dict[str, str] = {}
    clashes = []
    for old, n in zip(columns, new):
        if n in seen:
            clashes.append((seen[n], old, n))
        seen.setdefault(n, old)
    if clashes:
        raise ValueError(f"column names collide after standardisation: {clashes}")
    return new


def standardize_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*standardized_names(df.columns))


def drop_audit_columns(df: DataFrame, audit: tuple[str, ...] = BRONZE_AUDIT_COLUMNS) -> DataFrame:
    """Drop the audit columns that are present (absent names are ignored)."""
    return df.drop(*[c for c in audit if c in df.columns])


_COUNT_TEXT = "decimal(38,10)"


def _to_double(c: Column, strict: bool) -> Column:
    return c.cast("double") if strict else c.try_cast("double")


def as_measure(col: Column, strict: bool = True) -> Column:
    """A measure as double."""
    return _to_double(col, strict)


def as_count(col: Column, source: T.DataType, strict: bool = True) -> Column:
    """A count as bigint.

    Text goes through ``decimal(38,10)``, so ``'12.0'`` becomes 12 and every
    bigint stays exact; values are truncated toward zero like a cast from
    double. (A direct ``try_cast`` to bigint would fail through an exception
    on every such row, which is ~25x slower.)
    """
    if isinstance(source, T.LongType):
        return col
    if isinstance(source, T.StringType):
        return col.cast(_COUNT_TEXT).cast("bigint") if strict else col.try_cast(_COUNT_TEXT).try_cast("bigint")
    return col.cast("bigint") if strict else col.try_cast("bigint")


def cast_measures(df: DataFrame, doubles: list[str | None] = (), longs: list[str | None] = (),
                  strict: bool = True) -> DataFrame:
    """Cast measure columns to double and count columns to bigint.

    ``strict=False`` turns unparsable values into NULL instead of failing.
    """
    changes: dict[str, Column] = {}
    for name in (c for c in doubles if c and c in df.columns):
        changes[name] = as_measure(F.col(name), strict)
    for name in (c for c in longs if c and c in df.columns):
        changes[name] = as_count(F.col(name), df.schema[name].dataType, strict)
    return df.withColumns(changes) if changes else df


def year_of(c: Column | str, business_tz: str | None = None, strict: bool = True) -> Column:
    """Calendar year of a timestamp or timestamp text.

    Text with an offset is placed on the session clock first; ``business_tz``
    shifts that clock to another zone before taking the year.
    """
    col = F.col(c) if isinstance(c, str) else c
    ts = F.to_timestamp(col) if strict else F.try_to_timestamp(col)
    if business_tz:
        ts = F.from_utc_timestamp(F.to_utc_timestamp(ts, F.current_timezone()), business_tz)
    return F.year(ts)


def year_expr(col: Column, source: T.DataType, business_tz: str | None = None,
              strict: bool = True) -> Column:
    """Year of a column typed ``source`` (timestamp, timestamp_ntz, date or text)."""
    if isinstance(source, (T.TimestampNTZType, T.DateType)) and not business_tz:
        return F.year(col)
    return year_of(col, business_tz, strict)


def derive_year(df: DataFrame, source: str, target: str = "annee",
                business_tz: str | None = None, strict: bool = True) -> DataFrame:
    return df.withColumn(target, year_expr(F.col(source), df.schema[source].dataType, business_tz, strict))


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns typed double, float, bigint or int (not short, byte or decimal)."""
    kinds = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]
