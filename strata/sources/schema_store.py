"""Inferred column types, kept per dataset and version.

Type inference reads all landing files once. Its outcome is stored, and as long
as the header stays the same the next run takes the stored types and starts no
inference job. A header that changed gives a new version: known columns keep their
types, only new ones are inferred. Versions are never changed; ``drift`` says what
each one changed. ``recheck`` infers again on request and records a column whose
cells no longer fit (wider types only: bigint, double, string).
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..spec import DatasetSpec
from .catalog import TableStore
from .delimited import header_names, infer_cell_types, read_text_cells
from .partitions import write_partitions

TABLE = "strata_schemas"
SCHEMA = "dataset string, version int, position int, column_name string, type string, entry string"
_ORDER = ("bigint", "double", "string")  # each holds what the ones before it hold


class SchemaStore:
    def __init__(self, store: TableStore) -> None:
        self.store = store

    @property
    def spark(self) -> SparkSession:
        return self.store.spark

    def versions(self) -> DataFrame:
        """(dataset, version, position, column_name, type) of all versions."""
        if not self.store.exists(TABLE):
            return self.spark.createDataFrame([], SCHEMA).drop("entry")
        return self.store.read(TABLE).select("dataset", "version", "position", "column_name", "type")

    def latest(self, dataset: str) -> tuple[int, list[tuple[str, str]]]:
        """(version, [(column, type)]); version 0 when nothing is stored."""
        rows = self.versions().filter(F.col("dataset") == dataset).collect()
        version = max((r.version for r in rows), default=0)
        last = sorted((r.position, r.column_name, r.type) for r in rows if r.version == version)
        return version, [(name, kind) for _, name, kind in last]

    def resolve(self, spec: DatasetSpec) -> DatasetSpec:
        """The dataset with all types declared: stored ones, and inferred ones for new columns."""
        names = header_names(self.spark, spec)
        declared = dict(spec.columns or ())
        version, known = self.latest(spec.name)
        have = dict(known)
        types = {n: declared.get(n, have.get(n)) for n in names}
        unknown = [n for n, kind in types.items() if kind is None]
        if unknown:
            types |= self._inferred(spec, unknown) if spec.infer_types else dict.fromkeys(unknown, "string")
        if [*types.items()] != known:
            self._save(spec.name, version + 1, types)
        return self._typed(spec, types)

    def recheck(self, spec: DatasetSpec) -> DatasetSpec:
        """Infer all undeclared columns again; a type that became too narrow gives a new version."""
        resolved = self.resolve(spec)
        version, known = self.latest(spec.name)
        declared = dict(spec.columns or ())
        found = self._inferred(spec, [n for n, kind in known if n not in declared and kind in _ORDER])
        types = {n: max(kind, found.get(n, kind), key=_ORDER.index) if n in found else kind for n, kind in known}
        if types == dict(known):
            return resolved
        self._save(spec.name, version + 1, types)
        return self._typed(spec, types)

    @staticmethod
    def _typed(spec: DatasetSpec, types: dict[str, str]) -> DatasetSpec:
        return replace(spec, infer_types=False, columns=tuple(types.items()))

    def _inferred(self, spec: DatasetSpec, names: list[str]) -> dict[str, str]:
        cells = read_text_cells(self.spark, spec, strict=False)
        return infer_cell_types(cells.select([F.col(f"`{n}`") for n in names])) if names else {}

    def _save(self, dataset: str, version: int, types: dict[str, str]) -> None:
        entry = f"{dataset}.{version}"
        rows = [(dataset, version, i, n, kind, entry) for i, (n, kind) in enumerate(types.items())]
        write_partitions(self.store, self.spark.createDataFrame(rows, SCHEMA), TABLE, "entry")

    def drift(self, dataset: str) -> DataFrame:
        """(version, column_name, change, old_type, new_type): added, removed, moved or retyped."""
        mine = self.versions().filter(F.col("dataset") == dataset)
        numbered = mine.select("version").distinct().withColumn(
            "previous", F.lag("version").over(Window.orderBy("version"))).filter("previous IS NOT NULL")
        new = mine.join(numbered, "version").select(
            "version", "column_name", F.col("type").alias("new_type"), F.col("position").alias("at"))
        old = (numbered.join(mine.withColumnRenamed("version", "previous"), "previous")
               .select("version", "column_name", F.col("type").alias("old_type"), F.col("position").alias("was")))
        change = (F.when(F.col("old_type").isNull(), "added").when(F.col("new_type").isNull(), "removed")
                  .when(F.col("old_type") != F.col("new_type"), "retyped")
                  .when(F.col("at") != F.col("was"), "moved"))
        return (new.join(old, ["version", "column_name"], "full").withColumn("change", change)
                .filter("change IS NOT NULL")
                .select("version", "column_name", "change", "old_type", "new_type"))
