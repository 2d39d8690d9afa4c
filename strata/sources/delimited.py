"""Delimited landing files into DataFrames.

The scan is Spark's own CSV reader (parallel, splittable for uncompressed
files). Cells are read as text, the missing-value tokens are turned into
NULL and only then are columns cast: the CSV reader's single ``nullValue``
cannot express a token list, and one stray token would make schema
inference fall back to text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from ..functions.columns import as_count
from ..spec import DatasetSpec


def _na_to_null(c: Column, tokens: tuple[str, ...]) -> Column:
    return F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c) if tokens else c


# Name of the raw text of a record whose field count differs from the header's.
_RECORD = "__strata_record"
# Extra fields of a record beyond the header's (0 for most), carried by lenient scans.
SURPLUS = "__strata_surplus"


def _reader(reader, spec: DatasetSpec):
    # enforceSchema=false: every file's header must name the columns in this order.
    return (reader.option("sep", spec.sep).option("header", spec.header)
            .option("encoding", spec.encoding).option("escape", '"')
            .option("emptyValue", "").option("multiLine", spec.multi_line)
            .option("columnPruning", False).option("enforceSchema", not spec.header))


def header_names(spark: SparkSession, spec: DatasetSpec) -> list[str]:
    """Column names of the landing files (no type inference)."""
    return _reader(spark.read, spec).option("enforceSchema", True).csv(spec.location).columns


def read_text_cells(spark: SparkSession, spec: DatasetSpec, strict: bool = True,
                    stream: DataStreamReader | None = None) -> DataFrame:
    """All columns as text, missing-value tokens already NULL.

    Doubled quotes stand for one quote. A file whose header differs from the
    others', in names or order, is an error. A short record leaves its last
    cells NULL. A record with surplus fields, or broken by a line break inside
    quotes (see ``multi_line``), raises; lenient scans keep it and count the
    surplus fields in ``SURPLUS``. With ``stream`` the frame is a stream.
    """
    raw, names, surplus, broken = _scan(spark, spec, stream)
    cells = [_na_to_null(F.col(f"`{c}`"), spec.na_tokens).alias(c) for c in names]
    if not strict:
        return raw.select(*cells, surplus.alias(SURPLUS))
    # The message reads a data column, as Spark refuses plans over the raw record alone.
    message = F.concat(F.lit(f"malformed record in {spec.name} (surplus fields, or a line break in "
                             "quotes without multi_line): "), F.col(_RECORD),
                       F.substring(F.coalesce(F.col(f"`{names[0]}`"), F.lit("")), 1, 0))
    sound = F.when(broken, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return raw.filter(sound).select(cells)


def _scan(spark: SparkSession, spec: DatasetSpec, stream: DataStreamReader | None = None
          ) -> tuple[DataFrame, list[str], Column, Column]:
    """(rows of text cells and ``_RECORD``, header names, surplus fields of a row, is it malformed)."""
    names = header_names(spark, spec)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _RECORD]])
    raw = (_reader(stream or spark.read, spec).schema(schema)
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RECORD).csv(spec.location))
    record = F.col(_RECORD)
    # Possessive and without a group: Java would recurse (or backtrack) once per character of a
    # long cell. Doubled quotes are just two runs.
    bare = F.regexp_replace(record, r'"[^"]*+"', "")
    fields = (F.length(bare) - F.length(F.replace(bare, F.lit(spec.sep)))) / len(spec.sep) + 1
    surplus = F.greatest(F.lit(0), F.coalesce(fields.cast("int"), F.lit(0)) - F.lit(len(names)))
    quotes = F.length(record) - F.length(F.replace(record, F.lit('"')))
    broken = record.isNotNull() & ((surplus > 0) | (quotes % 2 == 1))
    return raw, names, surplus, broken


# Columns of a rejected record beside the audit columns: why, the raw record (of a malformed
# one), the cells as they were read, and the columns whose cells could not be parsed.
REASON, RECORD, CELLS, BAD_COLUMNS = "_reason", "_record", "_cells", "_bad_columns"
SURPLUS_FIELDS, OPEN_QUOTE, UNPARSABLE = "surplus fields", "open quote", "unparsable cells"


def read_marked(spark: SparkSession, spec: DatasetSpec) -> DataFrame:
    """Every record, typed, with why it must be rejected (``REASON`` NULL: it is sound).

    One scan, no record is lost and none raises: a malformed record carries its
    raw text, one with unparsable cells the text of every cell.
    """
    raw, names, surplus, broken = _scan(spark, spec)
    text = [F.col(f"`{c}`") for c in names]
    marked = raw.select(
        *[_na_to_null(c, spec.na_tokens).alias(n) for c, n in zip(text, names)],
        F.when(broken, F.when(surplus > 0, SURPLUS_FIELDS).otherwise(OPEN_QUOTE)).alias("_broken"),
        F.col(_RECORD).alias(RECORD),
        F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*text)).alias(CELLS))
    types = cell_types(marked.select([F.col(f"`{c}`") for c in names]), spec)
    typed, bad = [], []
    for c in names:
        cell, kind = F.col(f"`{c}`"), types.get(c, "string")
        parsed = _parsed(cell, kind, strict=False)
        typed.append(parsed.alias(c))
        if kind != "string":
            bad.append(F.when(cell.isNotNull() & parsed.isNull(), F.lit(c)))
    bad_columns = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")
    bad_columns = F.when(F.col("_broken").isNull(), bad_columns).otherwise(
        F.array().cast("array<string>"))  # a malformed record's cells mean nothing
    out = marked.select(*typed, "_broken", RECORD, CELLS, bad_columns.alias(BAD_COLUMNS))
    reason = F.coalesce("_broken", F.when(F.size(BAD_COLUMNS) > 0, UNPARSABLE))
    return out.select(*[F.col(f"`{c}`") for c in names], reason.alias(REASON),
                      F.when(F.col("_broken").isNotNull(), F.col(RECORD)).alias(RECORD),
                      F.when(reason.isNotNull(), F.col(CELLS)).alias(CELLS),
                      F.when(reason.isNotNull(), F.col(BAD_COLUMNS)).alias(BAD_COLUMNS))


# Text shapes that parse as a whole number (fits bigint) or as a number.
_WHOLE = r"^\s*[+-]?[0-9]+\s*$"
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$|^\s*(?i)[+-]?(inf|infinity)\s*$"


def infer_cell_types(df: DataFrame) -> dict[str, str]:
    """Narrowest of bigint / double / string per text column, in one pass.

    A column is bigint when every non-NULL cell is a whole number that fits,
    double when every cell is a number; otherwise it stays text. The tests
    are JVM regular expressions and lenient casts (none fails), and the whole input is
    one aggregate with partial aggregation per task.
    """
    probes = []
    for i, c in enumerate(df.columns):
        col = F.col(f"`{c}`")
        probes.append(F.count_if(col.isNotNull() & ~col.rlike(_NUMBER)).alias(f"d{i}"))
        fits = col.rlike(_WHOLE) & F.trim(col).try_cast("bigint").isNotNull()
        probes.append(F.count_if(col.isNotNull() & ~fits).alias(f"l{i}"))
    row = df.agg(*probes).first()
    kinds = {}
    for i, c in enumerate(df.columns):
        not_double, not_long = row[f"d{i}"], row[f"l{i}"]
        kinds[c] = "bigint" if not_long == 0 else ("double" if not_double == 0 else "string")
    return kinds


def read_delimited(spark: SparkSession, spec: DatasetSpec, strict: bool = True,
                   bad_cells_column: str | None = None) -> DataFrame:
    """Scan ``spec.location`` into typed columns.

    Types come from ``spec.columns`` (raw header -> Spark type); columns not
    listed stay text unless ``spec.infer_types``. ``strict=False`` turns
    unparsable cells into NULL instead of failing the job; with
    ``bad_cells_column`` each row then also carries how many of its cells
    were turned into NULL or dropped that way, so the loss can be counted.
    Whole numbers may be written as ``12.0``.
    """
    cells = read_text_cells(spark, spec, strict)
    df = typed_cells(cells, cell_types(cells, spec), strict, bad_cells_column)
    return apply_row_cap(df, spec.row_cap)


def cell_types(cells: DataFrame, spec: DatasetSpec) -> dict[str, str]:
    """Declared types, and inferred ones (an extra pass over the text) where asked for."""
    types = dict(spec.columns or ())
    if spec.infer_types:
        open_columns = [c for c in cells.columns if c not in types and c != SURPLUS]
        types = {**infer_cell_types(cells.select([F.col(f"`{c}`") for c in open_columns])), **types}
    return types


def _parsed(text: Column, kind: str, strict: bool) -> Column:
    """A text cell as ``kind``; what cannot be parsed raises, or is NULL when lenient."""
    if kind in ("bigint", "long"):
        return as_count(text, T.StringType(), strict)
    if kind == "string":
        return text
    return text.cast(kind) if strict else text.try_cast(kind)


def typed_cells(cells: DataFrame, types: dict[str, str], strict: bool = True,
                bad_cells_column: str | None = None) -> DataFrame:
    """Text cells cast to ``types``; columns without a type stay text."""
    out, lost = [], [F.col(SURPLUS)] if SURPLUS in cells.columns else []
    for c in (c for c in cells.columns if c != SURPLUS):
        text = F.col(f"`{c}`")
        kind = types.get(c, "string")
        col = _parsed(text, kind, strict)
        if kind != "string" and not strict:
            lost.append(F.when(text.isNotNull() & col.isNull(), 1).otherwise(0))
        out.append(col.alias(c))
    if bad_cells_column and not strict:
        out.append(sum(lost, F.lit(0)).alias(bad_cells_column))
    return cells.select(out)


def apply_row_cap(df: DataFrame, row_cap: int) -> DataFrame:
    """The first ``row_cap`` records of a file scan; a negative cap keeps all.

    First means in the order of the files' paths and of the records in them, so
    the same rows stay on every run. Spark takes them as a top-k: each task
    forwards at most ``row_cap`` rows, though every file is read for it.
    """
    if row_cap is None or row_cap < 0:
        return df
    place = [F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"),
             F.monotonically_increasing_id().alias("_i")]
    return (df.select(F.struct("*").alias("_row"), *place).orderBy("_f", "_b", "_i").limit(row_cap)
            .select("_row.*"))


def add_audit_columns(df: DataFrame, spec: DatasetSpec, with_clock: bool = True) -> DataFrame:
    """Lineage columns of the Bronze layer.

    The clock columns are evaluated once per query, so every row of one
    write carries the same values.
    """
    cols: dict[str, Column] = {}
    if with_clock:
        cols["_ingestion_timestamp"] = F.current_timestamp()
        cols["_ingestion_date"] = F.current_date()
    cols["_source_dataset"] = F.lit(spec.name)
    cols["_source_url"] = F.lit(spec.location)
    cols["_source_description"] = F.lit(spec.description)
    return df.withColumns(cols)


def write_delimited(df: DataFrame, path: str, sep: str = ";", na_token: str = "",
                    timestamp_format: str = "yyyy-MM-dd HH:mm:ss") -> str:
    """Write a landing file set (header row, one part file per partition)."""
    (df.write.mode("overwrite").option("sep", sep).option("header", True)
       .option("nullValue", na_token).option("emptyValue", '""').option("escape", '"')
       .option("timestampNTZFormat", timestamp_format)
       .option("timestampFormat", timestamp_format)
       .csv(path))
    return path
