"""Spark-native loading of master-data extracts into governed target tables."""

from .entities import ENTITIES
from .plans import RunOptions, compact, open_store, run_day, run_entity
from .session import build_session, work_dir
from .spec import EntitySpec, GateRule, LookupRule

__all__ = [
    "ENTITIES",
    "EntitySpec",
    "GateRule",
    "LookupRule",
    "RunOptions",
    "build_session",
    "compact",
    "open_store",
    "run_day",
    "run_entity",
    "work_dir",
]
