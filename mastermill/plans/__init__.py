"""Complete runs."""

from .audit import AUDIT_SCHEMA, RunRecord, append_audit, audit_frame
from .daily import run_day
from .entity import RunOptions, compact, conform_extract, finish_rows, open_store, run_entity, valid_rows

__all__ = [name for name in dir() if not name.startswith("_")]
