"""Change classification against the stored fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.keys import packed_hash

INSERT, UPDATE, UNCHANGED = "insert", "update", "unchanged"
CHANGE = "_change"
OLD_HASH = "_old_hash"  # the packed hash of the stored row




def classify_delta(incoming: DataFrame, state: DataFrame, keys: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Add ``_change`` (insert, update, unchanged) to every incoming row with one left join on the key.

    A row is changed when its hash differs from the stored hash of the same key. ``carry`` names state
    columns to bring along, such as the segment that holds the row, or ``OLD_HASH``. The stored hashes are packed for the join.
    """
    known = state.select(
        *keys, packed_hash(F.col("hash_value")).alias(OLD_HASH), F.lit(True).alias("_known"), *[c for c in carry if c != OLD_HASH]
    )
    change = (
        F.when(F.col("_known").isNull(), INSERT)
        .when(packed_hash(F.col("hash_value")).eqNullSafe(F.col(OLD_HASH)), UNCHANGED)
        .otherwise(UPDATE)
    )
    joined = incoming.join(known, list(keys), "left").withColumn(CHANGE, change)
    return joined.select(*incoming.columns, *carry, CHANGE)


def delta_new(incoming: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in the state."""
    return incoming.join(state.select(*keys), list(keys), "left_anti")


def delta_existing(incoming: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is in the state, without state columns."""
    return incoming.join(state.select(*keys), list(keys), "left_semi")


def delta_changed(incoming: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is in the state under another hash."""
    known = state.select(*keys, F.col("hash_value").alias("_old_hash"))
    joined = incoming.join(known, list(keys), "inner")
    return joined.filter(~F.col("hash_value").eqNullSafe(F.col("_old_hash"))).select(*incoming.columns)


def count_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while another action runs, instead of scanning for the count."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def count_changes(classified: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count inserts, updates, unchanged and all rows while another action runs."""
    observation = Observation(name)
    counts = [F.count_if(F.col(CHANGE) == c).alias(c) for c in (INSERT, UPDATE, UNCHANGED)]
    return classified.observe(observation, *counts, F.count("*").alias("total")), observation
