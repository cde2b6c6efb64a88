"""Apply classified changes to the target and the state."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .delta import CHANGE, INSERT, UPDATE
from .schema import pad_columns, project_state

CREATED_COLUMNS = ("created_date", "created_by")


def apply_updates(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], update_columns: Sequence[str]
) -> DataFrame:
    """Target rows with ``update_columns`` taken from the update of the same key; nulls overwrite.

    Columns the updates lack become null, as if the update row held a null there.
    """
    names = {c: f"_new_{n}" for n, c in enumerate(update_columns)}
    types = {f.name: f.dataType.simpleString() for f in target.schema.fields}
    right = pad_columns(updates, {c: types[c] for c in [*keys, *[c for c in update_columns if c not in keys]]})
    right = right.selectExpr(
        *[f"`{k}`" for k in keys], "true AS _hit", *[f"`{c}` AS {new}" for c, new in names.items()]
    )
    joined = target.join(right, list(keys), "left")
    return joined.selectExpr(
        *[f"CASE WHEN _hit THEN {names[c]} ELSE `{c}` END AS `{c}`" if c in names else f"`{c}`" for c in target.columns]
    )


def updated_rows(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], update_columns: Sequence[str], carry: Sequence[str] = ()
) -> DataFrame:
    """The new versions of the target rows that have an update, as :func:`apply_updates` makes them, with the ``carry`` columns of the old rows.

    Of the old rows only the columns are read that an update leaves as they were.
    """
    kept = [c for c in target.columns if c not in carry]
    columns = [c for c in kept if c in update_columns]
    types = {f.name: f.dataType.simpleString() for f in target.schema.fields}
    right = pad_columns(updates, {c: types[c] for c in [*keys, *[c for c in columns if c not in keys]]})
    old = target.select(*keys, *[c for c in kept if c not in columns and c not in keys], *carry)
    return old.join(right, list(keys)).select(*kept, *carry)


def align(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like``, in its order and types; absent ones are null."""
    return pad_columns(df, {f.name: f.dataType.simpleString() for f in like.schema.fields})


def merge(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str],
    preserve_created: bool = False,
) -> DataFrame:
    """The target after the insert and update rows of ``changes`` (see ``classify_delta``), by one join.

    ``preserve_created`` keeps the created columns of updated rows.
    """
    if preserve_created:
        update_columns = [c for c in update_columns if c not in CREATED_COLUMNS]
    joined, names = _meet(target, changes, keys)
    columns = []
    for c, new in names.items():
        taken = f"_old IS NULL OR {_NEW}" if c in update_columns else "_old IS NULL"
        columns.append(f"CASE WHEN {taken} THEN {new} ELSE `{c}` END AS `{c}`")
    return joined.filter(f"_old OR {CHANGE} = '{INSERT}'").selectExpr(*columns)


def advance_state(state: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state after the changes: untouched fingerprints and the new ones of inserts and updates, by one join."""
    state = project_state(state, keys)
    joined, names = _meet(state, changes, keys)
    return joined.selectExpr(*[f"CASE WHEN {_NEW} THEN {new} ELSE `{c}` END AS `{c}`" for c, new in names.items()])


_NEW = f"{CHANGE} IS NOT NULL"


def _meet(stored: DataFrame, changes: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """Stored rows beside the update of their key, inserts and other updates alone; and the names of the new columns.

    ``_old`` marks stored rows, ``CHANGE`` those that have a change.
    """
    names = {c: f"_new_{n}" for n, c in enumerate(stored.columns)}
    fresh = changes.filter(F.col(CHANGE).isin(INSERT, UPDATE))
    values = align(fresh.select(*[c for c in fresh.columns if c in names], CHANGE), stored.withColumn(CHANGE, F.lit("")))
    right = values.selectExpr(*[f"`{c}` AS {new}" for c, new in names.items()], CHANGE)
    same = [F.col(f"`{k}`") == F.col(names[k]) for k in keys]
    on = functools.reduce(lambda a, b: a & b, same, F.col(CHANGE) == UPDATE)
    return stored.withColumn("_old", F.lit(True)).join(right, on, "full"), names
