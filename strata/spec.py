"""Dataset descriptions, column roles and table names.

All of this is driver-side metadata: nothing here touches rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

# pandas' default tokens for a missing cell. A landing file
# written by tools that follow pandas conventions uses these for "no value".
DEFAULT_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


@dataclass(frozen=True)
class DatasetSpec:
    """One source dataset of the Bronze layer.

    ``location`` is a path (file, folder or glob) that ``spark.read.csv``
    understands; ``columns`` is an optional ``((raw name, spark type), ...)``
    schema. Without it every column stays text unless ``infer_types`` is set.
    ``row_cap`` < 0 means no cap; a cap is recorded in the run log.
    ``multi_line`` accepts line breaks inside quoted cells; such files are
    read whole by one task each, so it is off by default and a record broken
    by a line break is an error.
    """

    name: str
    location: str
    description: str = ""
    sep: str = ";"
    header: bool = True
    columns: tuple[tuple[str, str], ...] | None = None
    row_cap: int = -1
    na_tokens: tuple[str, ...] = DEFAULT_NA_TOKENS
    infer_types: bool = False
    encoding: str = "UTF-8"
    multi_line: bool = False


@dataclass(frozen=True)
class Roles:
    """Which column plays which part; ``None`` switches the dependent step off.

    Defaults are the standardised column names of the energy datasets.
    """

    measure: str | None = "total_energie_soutiree_wh"
    timestamp: str | None = "horodate"
    year: str | None = "annee"
    region: str | None = "region"
    sites: str | None = "nb_points_soutirage"
    profile: str | None = "profil"
    category: str | None = "consumption_category"
    score: str | None = "carbon_score"

    def without(self, *names: str) -> "Roles":
        return replace(self, **{n: None for n in names})


@dataclass(frozen=True)
class TableName:
    """Layered table naming: ``<layer>_<dataset>`` inside an optional database."""

    layer: str
    dataset: str
    database: str | None = field(default=None, compare=False)

    @property
    def short(self) -> str:
        return f"{self.layer}_{self.dataset}"

    @property
    def qualified(self) -> str:
        return f"{self.database}.{self.short}" if self.database else self.short

    def __str__(self) -> str:
        return self.qualified


def detect_column(columns: list[str] | DataFrame, *keywords: str) -> str | None:
    """First column whose lower-cased name contains a keyword.

    Keywords are tried in the given order; for each keyword the columns are
    scanned left to right. The keyword itself is used as given.
    """
    names = columns.columns if isinstance(columns, DataFrame) else list(columns)
    lowered = [(name, name.lower()) for name in names]
    for keyword in keywords:
        hit = next((name for name, low in lowered if keyword in low), None)
        if hit is not None:
            return hit
    return None


def first_present(df: DataFrame, candidates: list[str | None]) -> str | None:
    """First candidate that is a column of ``df``."""
    present = set(df.columns)
    return next((c for c in candidates if c and c in present), None)


# Default keywords that identify each role in a standardised header, tried
# in order (see ``detect_column``).
ROLE_KEYWORDS = {
    "measure": ("energie", "conso", "energy"),
    "timestamp": ("horodate", "date", "time"),
    "region": ("region",),
    "sites": ("nb_points", "points", "sites"),
    "profile": ("profil",),
}


def detect_roles(df: DataFrame, keywords: dict[str, tuple[str, ...]] | None = None,
                 base: Roles = Roles()) -> Roles:
    """Bind each keyword role to the first matching column (None when absent).

    Roles without keywords (year, category, score: columns this library
    derives) keep their names from ``base``.
    """
    found = {role: detect_column(df, *kws) for role, kws in (keywords or ROLE_KEYWORDS).items()}
    return replace(base, **found)


def bind_roles(columns: list[str], base: Roles = Roles()) -> Roles:
    """Roles of a dataset: the default name where it is a column, else the first keyword match.

    Columns whose names start with ``_`` (audit and clock columns) are never bound.
    """
    own = [c for c in columns if not c.startswith("_")]
    bound = {role: getattr(base, role) if getattr(base, role) in own else detect_column(own, *kws)
             for role, kws in ROLE_KEYWORDS.items()}
    return replace(base, **bound)
