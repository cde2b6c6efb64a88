"""Dimension lookups, code registration and the dated-action gate.

A dimension is broadcast where its caller has counted it and says that it is small, otherwise the choice is Catalyst's; a
dimension as large as the fact table is shuffled.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import key_text
from ..session import new_work_path
from ..spec import AUDIT_COLUMNS
from .schema import audit_values

_CODE, _SALT, _SLOTS, _HIT = "_lookup_code", "_lookup_salt", "_lookup_slots", "_lookup_hit"
TARGET_ROWS = 1_000_000  # rows of one code that one task may take
SPLIT_CODES = 1 << 18  # the most codes that are split, which bounds their broadcast; beyond it a task takes more rows of a code
ID_BUCKET_DIGITS = 3
NUMBERED_FILES, BROADCAST_FILES = 1 << 12, 1 << 21
# Fixed value: the name of a registered code.
PLACEHOLDER_NAME = "to be filled"


def one_per_code(dim: DataFrame, values: Sequence[str] = ("id",)) -> DataFrame:
    """One row per non-null code (the smallest value row), so that a lookup cannot multiply rows."""
    dim = dim.filter(F.col("code").isNotNull())
    if len(values) == 1:
        return dim.groupBy("code").agg(F.min(values[0]).alias(values[0]))
    return dim.groupBy("code").agg(F.min(F.struct(*values)).alias("_v")).select("code", "_v.*")


def code_counts(df: DataFrame, code: Column) -> DataFrame:
    """``code, rows`` of the non-null codes; the counts are combined in the map tasks."""
    counts = df.select(code.cast("string").alias("code")).filter(F.col("code").isNotNull()).groupBy("code").agg(F.count("*").alias("rows"))
    return counts


def split_codes(counts: DataFrame, target_rows: int = TARGET_ROWS) -> DataFrame:
    """``code, slots`` of the codes with more than ``target_rows`` rows: twice as many slots as would hold them at that size, because
    rows fall into slots by hash. At most ``SPLIT_CODES`` codes can have that many rows: the size grows with the total where need be."""
    total = counts.agg(F.coalesce(F.sum("rows"), F.lit(0))).scalar()
    size = F.greatest(F.lit(target_rows), (total / SPLIT_CODES).cast("bigint"))
    hot = counts.filter(F.col("rows") > size)
    return hot.select(F.col("code").cast("string").alias("code"), (2 * F.ceil(F.col("rows") / size)).cast("int").alias("slots"))


def spread(left: DataFrame, right: DataFrame, on: str, split: DataFrame | Mapping[str, int]) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join on ``on`` with a further key that divides the rows of the ``split`` codes; ``right`` is repeated for these alone.

    ``split`` has the slots of each code, as rows of :func:`split_codes` or by name. Rows of ``left`` without a code meet nothing and are dealt
    over as many keys as a shuffle has partitions.
    """

    def with_slots(df: DataFrame) -> DataFrame:
        if isinstance(split, DataFrame):
            hot = F.broadcast(split.select(F.col("code").alias(on), F.col("slots").alias(_SLOTS)))
            return df.join(hot, on, "left").withColumn(_SLOTS, F.coalesce(_SLOTS, F.lit(1)))
        slots = F.coalesce(*[F.when(F.col(on) == code, n) for code, n in split.items()], F.lit(1))
        return df.withColumn(_SLOTS, slots)

    nulls = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns if c != on])
    slot = F.pmod(row, F.when(F.col(on).isNull(), nulls).otherwise(F.col(_SLOTS))).cast("int")
    left = with_slots(left).withColumn(_SALT, slot).drop(_SLOTS)
    return left, with_slots(right).withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.col(_SLOTS) - 1))).drop(_SLOTS)


def _attach(
    df: DataFrame,
    dim: DataFrame,
    code: Column,
    outputs: Mapping[str, tuple[str, str]],
    how: str,
    small: bool,
    salt: int,
    hot: Sequence[str] | None,
    counts: DataFrame | None,
    target_rows: int,
) -> DataFrame:
    names = {out: f"_lookup_{n}" for n, out in enumerate(outputs)}
    right = dim.select(
        F.col("code").cast("string").alias(_CODE),
        *[F.col(value).try_cast(dtype).alias(names[out]) for out, (value, dtype) in outputs.items()],
    )
    left = df.withColumn(_CODE, code.cast("string"))
    on = [_CODE]
    if small:
        right = F.broadcast(right)
    elif salt or counts is not None:
        if hot is not None:
            split = dict.fromkeys(hot, salt)
        else:
            split = split_codes(code_counts(df, code) if counts is None else counts, target_rows)
        left, right = spread(left, right, _CODE, split)
        on = [_CODE, _SALT]
    joined = left.join(right, on, how)
    kept = [f"{names[c]} AS `{c}`" if c in outputs else f"`{c}`" for c in df.columns]
    return joined.selectExpr(*kept, *[f"{names[o]} AS `{o}`" for o in outputs if o not in df.columns])


def lookup_required(
    df: DataFrame,
    dim: DataFrame,
    code: Column,
    outputs: Mapping[str, tuple[str, str]],
    small: bool = False,
    salt: int = 0,
    hot: Sequence[str] | None = None,
    counts: DataFrame | None = None,
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """Inner join on the dimension's ``code``; only the output columns of the dimension survive.

    ``small`` asks for a broadcast, for dimensions whose row count was checked. For larger ones ``counts`` (:func:`code_counts`), or ``salt``
    where they are to be made from ``df``, divides every code of more than ``target_rows`` rows over as many join keys as its rows
    need; ``hot`` names the codes instead, each of ``salt`` keys.
    """
    return _attach(df, dim, code, outputs, "inner", small, salt, hot, counts, target_rows)


def lookup_or_drop(df: DataFrame, dim: DataFrame, code: Column, outputs: Mapping[str, tuple[str, str]], **kw) -> DataFrame:
    """Rows without a dimension row disappear; unlike registration, the dimension stays as it is."""
    return lookup_required(df, dim, code, outputs, **kw)


def lookup_optional(
    df: DataFrame,
    dim: DataFrame,
    code: Column,
    outputs: Mapping[str, tuple[str, str]],
    small: bool = False,
    salt: int = 0,
    hot: Sequence[str] | None = None,
    counts: DataFrame | None = None,
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """Keep all rows; the output columns are null where the code is unknown."""
    return _attach(df, dim, code, outputs, "left", small, salt, hot, counts, target_rows)


def unregistered_codes(df: DataFrame, dim: DataFrame, code: Column) -> DataFrame:
    """The distinct non-null codes that the dimension lacks.

    Distinct comes before the anti join: a frequent code shrinks to one row per map task, and only codes are
    shuffled.
    """
    codes = df.select(code.cast("string").alias("code")).filter(F.col("code").isNotNull()).distinct()
    return codes.join(dim.select(F.col("code").cast("string").alias("code")), "code", "left_anti")


def assign_ids(
    new_rows: DataFrame,
    keys: Sequence[str],
    existing: DataFrame | None = None,
    start: Column | int = 0,
    within: Sequence[str] = (),
    id_column: str = "id",
) -> DataFrame:
    """Dense ids after the greatest id of ``existing``, or after ``start``; the same on every run.

    Rows are numbered inside buckets taken from a digest of the key, and each bucket starts where the
    preceding ones end. Numbering is parallel over 4096 buckets of distinct keys; only the bucket counts, at
    most 4096 rows for each group of ``within``, meet in one place.
    """
    text = key_text(keys)
    rows = new_rows.withColumn("_text", text).withColumn("_bucket", F.substring(F.sha1("_text"), 1, ID_BUCKET_DIGITS))
    group = [*within, "_bucket"]
    before = Window.partitionBy(*within).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(*group)
        .agg(F.count("*").alias("_n"))
        .select(*group, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    inside = F.row_number().over(Window.partitionBy(*group).orderBy("_text"))
    if existing is not None:
        start = existing.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("top")).scalar()
    elif isinstance(start, int):
        start = F.lit(start)
    numbered = rows.withColumn("_rank", inside).join(F.broadcast(starts), group)
    return numbered.select(
        (start + F.col("_start") + F.col("_rank")).cast("bigint").alias(id_column),
        *[F.col(f"`{c}`") for c in new_rows.columns if c != id_column],
    )


def number_by_position(stored: DataFrame, start: int = 0, id_column: str = "id", parts: Sequence[DataFrame] = ()) -> DataFrame:
    """Dense ids after ``start`` for rows read from Parquet, without a shuffle or a sort.

    The id is the number of rows in the preceding files plus the row's index in its own file, so it is the
    same on every read of the same files. ``stored`` must hold whole files: filter it by partition columns
    only. Files stand in the order of a hash of their paths. More than ``NUMBERED_FILES`` are summed up within 4096 groups of files first, then over
    the groups, so no task holds them all; what rows are joined with is 16 bytes a file, broadcast while the files are at most ``BROADCAST_FILES``.
    ``parts`` are scans that together read the files of ``stored``: the numbered rows are then their union, with the same ids.
    """
    path = F.col("_metadata.file_path")

    def placed(df: DataFrame) -> DataFrame:
        return df.select("*", path.alias("_path"), F.xxhash64(path).alias("_file"), F.col("_metadata.row_index").alias("_row"))

    rows = placed(stored)
    files = rows.groupBy("_file").agg(F.count("*").alias("_n"), F.min("_path").alias("least"), F.max("_path").alias("most"))
    two = F.raise_error(F.lit("two files have one hash")).cast("bigint")
    files = files.select("_file", F.when(F.col("least") == F.col("most"), F.col("_n")).otherwise(two).alias("_n"))
    count, nothing = len(stored.inputFiles()), F.lit(0)
    if count <= NUMBERED_FILES:
        before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
        starts = files.select("_file", F.coalesce(F.sum("_n").over(before), nothing).alias("_start"))
    else:
        files = files.withColumn("_group", F.shiftright("_file", 52))
        groups = files.groupBy("_group").agg(F.sum("_n").alias("_n"))
        before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
        inside = Window.partitionBy("_group").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
        groups = groups.select("_group", F.coalesce(F.sum("_n").over(before), nothing).alias("_before"))
        start_of = F.col("_before") + F.coalesce(F.sum("_n").over(inside), nothing)
        starts = files.join(F.broadcast(groups), "_group").select("_file", start_of.alias("_start"))
    if count <= BROADCAST_FILES:
        starts = F.broadcast(starts)
    ids = (F.lit(start) + F.col("_start") + F.col("_row") + 1).cast("bigint").alias(id_column)
    columns = [ids, *[F.col(f"`{c}`") for c in stored.columns if c != id_column]]
    numbered = [df.join(starts, "_file").select(*columns) for df in ([placed(part) for part in parts] or [rows])]
    return functools.reduce(DataFrame.unionByName, numbered)


def new_dimension_rows(
    codes: DataFrame,
    dim: DataFrame | None,
    run_ts: datetime,
    user: str = "system",
    start: Column | int = 0,
    within: Sequence[str] = (),
    name: str = PLACEHOLDER_NAME,
) -> DataFrame:
    """Dimension rows for unregistered codes: next ids, placeholder name, audit columns.

    ``within`` numbers several dimensions at once, told apart by these columns.
    """
    values = audit_values(run_ts, user)
    return assign_ids(codes.select(*within, "code"), ["code"], dim, start, within).select(
        *within,
        "id",
        "code",
        F.lit(name).alias("name"),
        *[F.lit(values[c]).cast(t).alias(c) for c, t in AUDIT_COLUMNS.items()],
    )


def register_codes(df: DataFrame, dim: DataFrame, code: Column, run_ts: datetime, user: str = "system") -> DataFrame:
    """The rows to append to the dimension so that it covers every code of ``df``."""
    return new_dimension_rows(unregistered_codes(df, dim, code), dim, run_ts, user)


def register_and_lookup(
    df: DataFrame, dim: DataFrame, code: Column, output: str, run_ts: datetime, user: str = "system", salt: int = 0
) -> tuple[DataFrame, DataFrame]:
    """``(rows with the id in output, new dimension rows)``.

    The codes of the rows and their counts are written once; the new codes, the ids and the division of frequent codes all start
    from there, so the rows themselves are read once for their codes and once for the lookup.
    Callers that store the dimension write the new rows first and look up in the stored table, so that an id
    is durable before a row refers to it.
    """
    path = new_work_path(df.sparkSession, "codes")
    code_counts(df, code).write.parquet(path)
    counts = df.sparkSession.read.schema("code string, rows bigint").parquet(path)
    fresh = register_codes(counts, dim, F.col("code"), run_ts, user)
    full = dim.select("id", "code").unionByName(fresh.select("id", "code"))
    return lookup_required(df, full, code, {output: ("id", "bigint")}, salt=salt, counts=counts if salt else None), fresh


def qualifying_codes(
    actions: DataFrame,
    flags: DataFrame,
    file_date: date,
    flag_code: str = "True",
    app_value: str = "yes",
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """Distinct codes with an applied action that takes effect on the file date and whose flag is set.

    The date test is a half-open range on the stored timestamp, so the scan can prune by it. Most actions
    point at the same one or two flags: equal actions are one row, and flags of more than ``target_rows`` of these are divided by their counts.
    """
    start = datetime(file_date.year, file_date.month, file_date.day)
    active = actions.filter(
        (F.col("app") == app_value)
        & (F.col("effdt") >= F.lit(start.isoformat(" ")).cast("timestamp"))
        & (F.col("effdt") < F.lit((start + timedelta(days=1)).isoformat(" ")).cast("timestamp"))
    )
    on = flags.filter(F.col("code") == flag_code).select(F.col("id").cast("string").alias("attr")).distinct()
    active = active.select(F.col("code").cast("string").alias("code"), F.col("attr").cast("string").alias("attr")).distinct()
    active, on = spread(active, on, "attr", split_codes(code_counts(active, F.col("attr")), target_rows))
    return active.join(on, ["attr", _SALT], "left_semi").select("code").distinct()


def action_gate(df: DataFrame, codes: DataFrame, code: Column, gated: Sequence[str]) -> DataFrame:
    """Keep the gated columns on rows whose code qualifies; null them on all other rows.

    ``codes`` is distinct, so the join never multiplies rows.
    """
    hits = codes.select(F.col("code").cast("string").alias(_CODE), F.lit(True).alias(_HIT))
    joined = df.withColumn(_CODE, code.cast("string")).join(hits, _CODE, "left")
    return joined.select(
        *[F.when(F.col(_HIT), F.col(f"`{c}`")).alias(c) if c in gated else F.col(f"`{c}`") for c in df.columns]
    )
