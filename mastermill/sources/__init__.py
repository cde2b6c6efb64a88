"""Sources and sinks."""

from .files import discover_files, is_accepted, is_empty, list_files, read_extract, require_accepted, select_files
from .tables import Commit, SnapshotStore, append_table, path_exists, read_table, replace_table

__all__ = [name for name in dir() if not name.startswith("_")]
