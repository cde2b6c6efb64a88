"""Business keys, row fingerprints and other scalar expressions. All stay inside whole-stage codegen."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import AUDIT_DATES


def business_key(keys: Sequence[str]) -> Column:
    """The key columns joined without a separator; for display and export, never for joins."""
    return F.concat_ws("", *[F.col(k).cast("string") for k in keys])


def _marked(text: str) -> str:
    return f"coalesce({text}, chr(0))"


def key_text(keys: Sequence[str]) -> Column:
    """The key columns as one unambiguous string."""
    return F.expr(f"concat_ws(chr(31), {', '.join(_marked(f'CAST(`{k}` AS STRING)') for k in keys)})")


def canonical_text(field: T.StructField) -> str:
    """SQL for a column as a string that does not depend on the session time zone."""
    if isinstance(field.dataType, T.TimestampType):
        return f"CAST(unix_micros(`{field.name}`) AS STRING)"
    return f"CAST(`{field.name}` AS STRING)"


def row_text(df: DataFrame, exclude: Iterable[str] = AUDIT_DATES, legacy: bool = False) -> Column:
    """All columns but ``exclude`` as one string.

    The default sorts the columns by name, separates the fields with U+001F and marks nulls with U+0000, so
    column order, shifted field borders and null against empty cannot make two different rows look equal.
    ``legacy`` keeps the frame's column order, uses no separator and skips nulls.
    """
    skip = set(exclude)
    fields = [f for f in df.schema.fields if f.name not in skip]
    if legacy:
        return F.expr(f"concat_ws('', {', '.join(f'CAST(`{f.name}` AS STRING)' for f in fields)})")
    fields = sorted(fields, key=lambda f: f.name)
    return F.expr(f"concat_ws(chr(31), {', '.join(_marked(canonical_text(f)) for f in fields)})")


def row_fingerprint(df: DataFrame, exclude: Iterable[str] = AUDIT_DATES, legacy: bool = False) -> Column:
    """SHA-1 of :func:`row_text`, as 40 hex digits."""
    return F.sha1(row_text(df, exclude, legacy))


def checksum(df: DataFrame, exclude: Iterable[str] = AUDIT_DATES, legacy: bool = False) -> Column:
    """32-bit Murmur3 checksum of :func:`row_text`."""
    return F.hash(row_text(df, exclude, legacy))


def with_fingerprint(
    df: DataFrame, exclude: Iterable[str] = AUDIT_DATES, legacy: bool = False, method: str = "sha1"
) -> DataFrame:
    """Add ``hash_value`` and ``check_sum``. ``method="murmur"`` stores the checksum in both."""
    value = "CAST(hash(_row_text) AS STRING)" if method == "murmur" else "sha1(_row_text)"
    texts = df.withColumn("_row_text", row_text(df, exclude, legacy))
    return texts.selectExpr(*[f"`{c}`" for c in df.columns], f"{value} AS hash_value", "hash(_row_text) AS check_sum")


def packed_hash(hashed: Column) -> Column:
    """A stored hash as fewer bytes, for shuffles and intermediate tables: hex digits in pairs, any other text as it is, told apart by the first byte."""
    digits = hashed.rlike("^([0-9a-f][0-9a-f])+$")
    return F.when(digits, F.concat(F.unhex(F.lit("01")), F.unhex(hashed))).otherwise(F.concat(F.unhex(F.lit("00")), F.encode(hashed, "UTF-8")))


def unpacked_hash(packed: Column) -> Column:
    """The text that :func:`packed_hash` was made from."""
    rest = F.substring(packed, 2, 1 << 30)
    return F.when(F.substring(packed, 1, 1) == F.unhex(F.lit("01")), F.lower(F.hex(rest))).otherwise(F.decode(rest, "UTF-8"))


@dataclass(frozen=True)
class Signature:
    """How rows were hashed: the method, the columns with their types in the order they were joined in, and whether without separator."""

    method: str
    columns: tuple[str, ...]
    legacy: bool = False

    @property
    def name(self) -> str:
        return hashlib.sha1(json.dumps(asdict(self)).encode()).hexdigest()[:12]

    def of(self, df: DataFrame) -> Column:
        """The ``hash_value`` that rows had under this signature; columns that are no longer there count as null."""
        have = {f.name: f for f in df.schema.fields}
        texts = [(canonical_text(have[c]) if not self.legacy else f"CAST(`{c}` AS STRING)") if c in have else "CAST(NULL AS STRING)" for c in self.columns]
        joined = f"concat_ws('', {', '.join(texts)})" if self.legacy else f"concat_ws(chr(31), {', '.join(map(_marked, texts))})"
        return F.expr(f"CAST(hash({joined}) AS STRING)" if self.method == "murmur" else f"sha1({joined})")


def signature(df: DataFrame, exclude: Iterable[str] = AUDIT_DATES, legacy: bool = False, method: str = "sha1") -> Signature:
    """The signature of :func:`with_fingerprint` with the same arguments."""
    skip = set(exclude)
    names = [f.name for f in df.schema.fields if f.name not in skip]
    return Signature(method, tuple(names if legacy else sorted(names)), legacy)


def code_prefix(column: str, length: int | None) -> Column:
    """The first ``length`` characters of a column, or the whole column as a string."""
    text = F.col(column).cast("string")
    return text if length is None else F.substring(text, 1, length)


def category_ladder(source: str = "cat_cd", prefix: str = "cc", levels: int = 5) -> dict[str, Column]:
    """``cc1 .. cc5``: the first 1 to 5 characters of the category code; null stays null."""
    return {f"{prefix}{n}": F.substring(F.col(source), 1, n) for n in range(1, levels + 1)}


def file_code(name: Column) -> Column:
    """SHA-256 of a file name, 64 hex digits."""
    return F.sha2(name, 256)


def file_date(name: Column) -> Column:
    """The ``yyyymmdd`` between the last underscore and the following dot, as a date; null if unreadable."""
    digits = F.regexp_extract(name, r"_(\d{8})\.[^_]*$", 1)
    return F.try_to_date(digits, "yyyyMMdd")
