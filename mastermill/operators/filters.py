"""Row filters. Each is one predicate, so Catalyst pushes it into the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key columns are all non-null."""
    return df.na.drop(subset=list(keys))


def require_source(df: DataFrame, column: str) -> DataFrame:
    """Rows whose lookup source is non-null."""
    return df.filter(F.col(column).isNotNull())


def require_code(df: DataFrame, column: str = "code") -> DataFrame:
    """Rows with a non-null code."""
    return df.filter(F.col(column).isNotNull())


def has_columns(df: DataFrame, names: Sequence[str]) -> bool:
    """Whether the frame has every named column, whatever the case."""
    have = {c.lower() for c in df.columns}
    return all(n.lower() in have for n in names)
