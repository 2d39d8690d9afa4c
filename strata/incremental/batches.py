"""A new Bronze batch through Silver and Gold, without reading history again.

What a batch costs grows with the batch, the key index (16 bytes a stored row,
read in place) and the Silver partitions (years) it has rows for:

1. the batch is grouped by itself and joined with the key index;
2. its unseen keys go on record, its check states are stored;
3. its unseen rows are cleaned; each year they touch is written anew beside the
   stored one and swapped in, other years are not read;
4. the Gold base is computed anew for those years; the KPI tables follow from it.

Every step replaces what the same batch left before, so a run that failed
anywhere is simply run again. After many batches the result equals one run
over all rows. Batches of one dataset run one after the other; only the newest
batch may be run again with other contents.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import BRONZE_AUDIT_COLUMNS, as_count, numeric_columns, standardized_names
from ..operators.privacy import DEFAULT_MIN_SITES
from ..operators.quality import grouped_rows
from ..plans.pipeline import check_suppressible, silver_rows
from ..session import scratch_path
from ..sources.catalog import TableStore
from ..sources.partitions import write_partitions
from ..spec import Roles, bind_roles
from . import states
from .history import BATCH, BUCKETS, KEY, SEEN, RowHistory, get_names, row_key, set_names

#: Silver rows carry the batch that brought them.
SILVER_BATCH = "_batch"


@dataclass
class BatchResult:
    batch: str
    years: list
    metrics: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Incremental:
    """The tables of one dataset that is fed by batches."""

    store: TableStore
    dataset: str
    roles: Roles | None = None
    min_sites: int = DEFAULT_MIN_SITES
    strict: bool = True
    business_tz: str | None = None
    allow_unsuppressed: bool = False
    buckets: int = BUCKETS  # of the key index; fixed by the first batch

    @property
    def silver(self) -> str:
        return f"silver_{self.dataset}"

    @property
    def checks(self) -> str:
        return f"quality_state_{self.dataset}"

    @property
    def history(self) -> RowHistory:
        return RowHistory(self.store, self.dataset, self.buckets)

    def run_batch(self, bronze: DataFrame, batch: str, gold: bool = True) -> BatchResult:
        """Bring one batch of Bronze rows into all layers; ``batch`` names it for good."""
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
            raise ValueError(f"batch name {batch!r}: use letters, digits, '_', '.' and '-'")
        kept = [c for c in bronze.columns if c not in BRONZE_AUDIT_COLUMNS]
        rows = bronze.select([F.col(f"`{old}`").alias(new)
                              for old, new in zip(kept, standardized_names(kept))])
        columns, numeric = rows.columns, numeric_columns(rows)
        types = {f.name: f.dataType for f in rows.schema.fields}
        roles = self.roles or bind_roles(columns)
        check_suppressible(types, roles, self.allow_unsuppressed)
        self.history.check_columns(columns)

        keyed = grouped_rows(rows).withColumn(KEY, row_key(rows, columns))
        grouped = self._staged(self.history.mark_seen(keyed, batch))
        again = batch in self._batches()
        fresh = grouped.filter(~F.col(SEEN))
        self.history.record(fresh, batch, columns)

        sites = None
        if roles.sites in types:
            sites = as_count(F.col(roles.sites), types[roles.sites], self.strict)
        keep = F.coalesce(sites >= self.min_sites, F.lit(False)) if sites is not None else F.lit(True)
        found = states.check_states(grouped, columns, numeric, keep).withColumn(BATCH, F.lit(batch))
        write_partitions(self.store, found, self.checks, BATCH, [batch])
        set_names(self.store, self.checks, columns=columns, numeric=numeric)

        cleaned = silver_rows(fresh, columns, types, roles, self.min_sites, self.strict,
                              self.business_tz).withColumn(SILVER_BATCH, F.lit(batch))
        years = self._merge(cleaned, roles, batch, again)
        if gold:
            states.refresh_base(self.store, self.dataset, years, roles)
            if self.store.exists(f"gold_base_{self.dataset}"):
                states.write_gold_from_base(self.store, self.dataset, roles)
        mine = self.store.read(self.checks).filter(F.col(BATCH) == batch)
        return BatchResult(batch, years, states.merged_metrics(mine).first().asDict())

    def _staged(self, df: DataFrame) -> DataFrame:
        """Write a frame of the batch's size once; what follows reads it several times."""
        path = scratch_path(self.store.spark, f"batch-{self.dataset}")
        df.write.parquet(path)
        return self.store.spark.read.schema(df.schema).parquet(path)

    def _batches(self) -> list[str]:
        if not self.store.exists(self.checks):
            return []
        rows = self.store.spark.sql(f"SHOW PARTITIONS {self.store.qualify(self.checks)}").collect()
        return [r[0].split("=", 1)[1] for r in rows]

    def _merge(self, cleaned: DataFrame, roles: Roles, batch: str, again: bool) -> list:
        """Swap in the years that the batch has rows for (or had, when it ran before).

        ``cleaned`` is a narrow plan over the staged rows: finding its years reads two columns.
        """
        if not roles.year or roles.year not in cleaned.columns:
            raise ValueError("Silver is kept by year: name a year or a timestamp column")
        years = [r[0] for r in cleaned.select(roles.year).distinct().collect()]
        if not self.store.exists(self.silver):
            write_partitions(self.store, cleaned, self.silver, roles.year)
            return years
        stored = self.store.read(self.silver)
        if again:
            before = stored.filter(F.col(SILVER_BATCH) == batch).select(roles.year).distinct()
            years = list({*years, *(r[0] for r in before.collect())})
        if not years:
            return []
        others = states.of_years(stored, roles.year, years).filter(F.col(SILVER_BATCH) != batch)
        merged = others.unionByName(cleaned.select(*others.columns))
        write_partitions(self.store, merged, self.silver, roles.year, years)
        return years

    def quality_report(self) -> DataFrame:
        """Report of all batches, from their states."""
        names = [get_names(self.store, self.checks, k) or [] for k in ("columns", "numeric")]
        return states.merged_report(self.store.read(self.checks), *names)

    def metrics(self) -> DataFrame:
        return states.merged_metrics(self.store.read(self.checks))
