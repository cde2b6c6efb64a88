"""The run-audit record: one row per processed or failed file."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import append_table, one_row

SUCCESS, FAILED, EMPTY, SKIPPED = "Success", "Failed", "Empty", "Skipped"

# The columns of the audit table.
AUDIT_SCHEMA = """
    file_name string, table_name string, region string, csv_count bigint, data_insert_count bigint,
    data_update_count bigint, status string, created_date timestamp, file_code string, error_message string,
    success_message string, start_time timestamp, end_time timestamp, duration string
"""
AUDIT_FIELDS = ", ".join(f"{name}: {kind}" for name, kind in (c.split() for c in AUDIT_SCHEMA.split(",")))


def _now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass
class RunRecord:
    """Facts about one run; a new record per file, so nothing leaks from one run into the next."""

    table_name: str
    file_name: str = ""
    region: str = ""
    csv_count: int = 0
    data_insert_count: int = 0
    data_update_count: int = 0
    status: str = ""
    created_date: datetime = field(default_factory=_now)
    file_code: str = ""
    error_message: str = ""
    success_message: str = ""
    start_time: datetime = field(default_factory=_now)
    end_time: datetime | None = None
    duration: str = ""
    units_read: int = 0  # slices of the state that the run compared with; not part of the audit table

    def __post_init__(self):
        self.file_code = self.file_code or hashlib.sha256(self.file_name.encode()).hexdigest()

    def close(self, status: str, message: str = "") -> RunRecord:
        self.status = status
        if status == FAILED:
            self.error_message = message
        else:
            self.success_message = message
        self.end_time = _now()
        self.duration = str(self.end_time - self.start_time)
        return self


def audit_frame(spark: SparkSession, records: RunRecord | Sequence[RunRecord]) -> DataFrame:
    """The records as rows of the audit table, without starting a Python worker."""
    records = [records] if isinstance(records, RunRecord) else records
    values = [{k: v.isoformat() if isinstance(v, datetime) else v for k, v in asdict(r).items()} for r in records]
    rows = one_row(spark, {"rows": values}, f"rows array<struct<{AUDIT_FIELDS}>>")
    return rows.select(F.inline("rows"))


def append_audit(spark: SparkSession, records: RunRecord | Sequence[RunRecord], location: str, fmt: str = "parquet", **options) -> None:
    """Append the records to the run-audit table."""
    if isinstance(records, RunRecord) or records:
        append_table(audit_frame(spark, records), location, fmt, **options)
