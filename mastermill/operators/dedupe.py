"""De-duplication and distinct."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_key_rank"


def dedupe_keys(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest by ``order_by``, then by all other columns in name order, nulls last.

    The order is total, so the survivor does not depend on partitioning or retries. Spark turns the
    ``row_number() = 1`` filter into a group limit on both sides of the shuffle: each map task keeps one row
    per key first, so a key that holds a third of the rows sends one row per task. The result stays
    partitioned and sorted by the keys, which the following join on the same keys reuses.
    """
    rest = [c for c in order_by if c not in keys]
    rest += sorted(c for c in df.columns if c not in keys and c not in rest)
    order = [F.col(f"`{c}`").desc_nulls_last() for c in rest] or [F.lit(1)]
    window = Window.partitionBy(*[f"`{k}`" for k in keys]).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def dedupe_codes(df: DataFrame, code: str = "code") -> DataFrame:
    """The distinct codes; pre-aggregated in every map task."""
    return df.select(code).distinct()


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct."""
    return df.distinct()


def union_branches(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union by name; branches may lack columns, which become null."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
