"""Declarative description of an entity: columns, keys, lookup rules and update columns."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

_COLUMN = re.compile(r"(\w+)\s+(\w+(?:\(\d+,\s*\d+\))?)")

# The audit columns of every target.
AUDIT_COLUMNS = {
    "updated_by": "string",
    "updated_date": "timestamp",
    "validationstatus": "string",
    "is_valid": "boolean",
    "created_date": "timestamp",
    "created_by": "string",
    "comment": "string",
}
AUDIT_DATES = ("created_date", "updated_date")


def columns(text: str) -> dict[str, str]:
    """``"a string, b decimal(16,6)"`` as an ordered ``{name: type}`` mapping."""
    return dict(_COLUMN.findall(text))


@dataclass(frozen=True)
class LookupRule:
    """Replace or add columns from a dimension, matched on its ``code``.

    ``missing`` says what happens to rows whose code is not in the dimension: ``register`` adds the code to
    the dimension first, ``null`` keeps the row with nulls, ``drop`` removes the row.
    ``outputs`` maps an output column to ``(dimension column, type)``. ``spread`` says that few codes may hold most rows.
    """

    source: str
    dimension: str
    outputs: Mapping[str, tuple[str, str]]
    prefix: int | None = None
    missing: str = "register"
    require_source: bool = False
    spread: bool = False

    def __post_init__(self):
        if self.missing not in ("register", "null", "drop"):
            raise ValueError(f"unknown missing-code policy {self.missing!r}")


def register(source: str, dimension: str, output: str | None = None, **kw) -> LookupRule:
    """Rule that stores the dimension id of ``source`` in ``output``, registering unseen codes."""
    return LookupRule(source, dimension, {output or source: ("id", "bigint")}, missing="register", **kw)


@dataclass(frozen=True)
class GateRule:
    """Keep ``columns`` only on rows that have a qualifying dated action (matched on ``source``).

    The gate runs only when every column of ``guard`` is in the extract.
    """

    source: str
    actions: str
    flags: str
    columns: tuple[str, ...]
    guard: tuple[str, ...]
    flag_code: str = "True"
    app_value: str = "yes"


@dataclass(frozen=True)
class EntitySpec:
    name: str
    files: Mapping[str, str]
    schema: Mapping[str, str]
    keys: tuple[str, ...]
    merge_keys: tuple[str, ...] = ()
    code_from: tuple[str, ...] = ()
    constants: Mapping[str, object] = field(default_factory=dict)
    drop: tuple[str, ...] = ()
    region_default: bool = False
    category_ladder: bool = False
    rules: tuple[LookupRule | GateRule, ...] = ()
    target_extra: Mapping[str, str] = field(default_factory=dict)
    keep_code: bool = False
    not_updated: tuple[str, ...] = ()
    narrow: tuple[str, ...] = ()
    fingerprint: str = "sha1"
    validation_status: str = "true"
    order_by: tuple[str, ...] = ()

    def __post_init__(self):
        replaced: set[str] = set()
        for rule in self.rules:
            if rule.source in replaced:
                raise ValueError(f"{self.name}: rule source {rule.source!r} was replaced by an earlier rule")
            if isinstance(rule, LookupRule):
                replaced |= set(rule.outputs)

    @property
    def delta_keys(self) -> tuple[str, ...]:
        """Keys that identify a row in the state and target tables."""
        return self.merge_keys or self.keys

    @property
    def cluster_keys(self) -> tuple[str, ...]:
        """The keys that vary within an extract. Catalyst folds constant ones out of shuffles and joins, so
        stored rows clustered by the others line up with an extract."""
        fixed = set(self.constants) | ({"rgcd"} if self.region_default else set())
        return tuple(k for k in self.delta_keys if k not in fixed)

    @property
    def code_columns(self) -> tuple[str, ...]:
        return self.code_from or self.delta_keys

    @property
    def target_columns(self) -> dict[str, str]:
        """Columns of the target table: schema, lookup outputs, extras and audit columns, without code and id."""
        cols = dict(self.schema)
        cols.pop("id", None)
        if not self.keep_code:
            cols.pop("code", None)
        for name in self.drop:
            cols.pop(name, None)
        for rule in self.rules:
            if isinstance(rule, LookupRule):
                cols.update({out: dtype for out, (_, dtype) in rule.outputs.items()})
        return cols | dict(self.target_extra) | AUDIT_COLUMNS

    @property
    def update_columns(self) -> list[str]:
        """Columns a changed row overwrites in the target; key columns are equal by construction."""
        skip = set(self.not_updated) | set(self.delta_keys)
        return [c for c in self.target_columns if c not in skip]
