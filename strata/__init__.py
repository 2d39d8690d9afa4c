"""strata: layered (raw -> cleaned -> KPI) analytics on Spark DataFrames."""

from .spec import DatasetSpec, Roles, TableName, detect_column, first_present

__all__ = ["DatasetSpec", "Roles", "TableName", "detect_column", "first_present"]
