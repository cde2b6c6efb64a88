"""Projections: names, types, constants, audit columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import AUDIT_COLUMNS


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case all column names; two names that differ only in case are an error."""
    lowered = [c.lower() for c in df.columns]
    doubled = sorted({c for c in lowered if lowered.count(c) > 1})
    if doubled:
        raise ValueError(f"column names that are equal but for case: {', '.join(doubled)}")
    return df.toDF(*lowered)


def _typed(field: T.StructField, dtype: str) -> str:
    """SQL that casts a column and gives null for unreadable values.

    Text with a decimal fraction reads as an integer by cutting the fraction off (``"7.50"`` is 7); the
    pattern is only tried on text that is not a plain integer.
    """
    name = f"`{field.name}`"
    if dtype != "int" or not isinstance(field.dataType, T.StringType):
        return f"try_cast({name} AS {dtype})"
    whole = f"CASE WHEN {name} RLIKE '^ *[+-]?[0-9]+[.][0-9]* *$' THEN try_cast(substring_index({name}, '.', 1) AS int) END"
    return f"coalesce(try_cast({name} AS int), {whole})"


def conform(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Cast the columns named in ``schema`` in one projection; unreadable values become null.

    Columns outside the schema pass through, missing ones are not added.
    """
    return df.selectExpr(
        *[f"{_typed(f, schema[f.name])} AS `{f.name}`" if f.name in schema else f"`{f.name}`" for f in df.schema.fields]
    )


def pad_columns(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Exactly the columns of ``schema``, in that order and of these types; absent ones are null."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def padded(name: str, dtype: str) -> str:
        if have.get(name) == dtype:
            return f"`{name}`"
        return f"CAST({f'`{name}`' if name in have else 'NULL'} AS {dtype}) AS `{name}`"

    return df.selectExpr(*[padded(c, t) for c, t in schema.items()])


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the named columns where present, whatever their case."""
    gone = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in gone])


def force_constants(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    """Add or overwrite columns with literals."""
    return df.withColumns({c: F.lit(v) for c, v in constants.items()}) if constants else df


# Fixed rule: the region codes of source directories.
def region_code(region: str) -> str:
    """Region code of a source directory: AUS keeps its own, every other directory is CA."""
    return "AUS" if region == "AUS" else "CA"


def default_region(df: DataFrame, region: str, column: str = "rgcd") -> DataFrame:
    """Add the region column when the extract has none. Call after :func:`lower_names`."""
    if column in df.columns:
        return df
    return df.withColumn(column, F.lit(region_code(region)))


def audit_values(run_ts: datetime, user: str = "system", status: str = "true") -> dict[str, object]:
    """The seven audit values of a run."""
    return {
        "updated_by": user,
        "updated_date": run_ts,
        "validationstatus": status,
        "is_valid": False,
        "created_date": run_ts,
        "created_by": user,
        "comment": " ",
    }


def stamp_audit(df: DataFrame, run_ts: datetime, user: str = "system", status: str = "true") -> DataFrame:
    """Add the audit columns; one timestamp for the whole run."""
    values = audit_values(run_ts, user, status)
    return df.withColumns({c: F.lit(values[c]).cast(t) for c, t in AUDIT_COLUMNS.items()})


def select_except(df: DataFrame, names: Iterable[str] = ("id", "code")) -> DataFrame:
    """All columns but the named ones."""
    return df.drop(*names)


def project_state(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The fingerprint columns: keys, ``code``, ``hash_value``, ``check_sum``."""
    return df.select(*[k for k in keys if k != "code"], "code", "hash_value", "check_sum")


def narrow_decimals(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Truncate decimal columns to integers; out-of-range values become null."""
    return df.withColumns({c: F.col(c).try_cast("int") for c in names if c in df.columns})


def override_columns(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace existing columns by constants, for instance contact columns in a restored copy."""
    missing = [c for c in values if c not in df.columns]
    if missing:
        raise ValueError(f"columns to override are missing: {', '.join(missing)}")
    return df.withColumns({c: F.lit(v).cast(df.schema[c].dataType) for c, v in values.items()})


def assert_overridden(df: DataFrame, values: Mapping[str, object]) -> None:
    """Raise when any row holds another value; one aggregate over the named columns."""
    wrong = df.agg(*[F.count_if(~F.col(c).eqNullSafe(F.lit(v))).alias(c) for c, v in values.items()]).first()
    bad = {c: n for c, n in wrong.asDict().items() if n}
    if bad:
        raise AssertionError(f"rows that keep another value: {bad}")
