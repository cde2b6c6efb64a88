"""DataFrame-to-DataFrame operators."""

from .dedupe import dedupe_codes, dedupe_keys, distinct_rows, union_branches
from .delta import classify_delta, count_changes, count_rows, delta_changed, delta_existing, delta_new
from .filters import has_columns, require_code, require_keys, require_source
from .lookups import (
    action_gate,
    assign_ids,
    code_counts,
    lookup_optional,
    lookup_or_drop,
    lookup_required,
    new_dimension_rows,
    number_by_position,
    one_per_code,
    qualifying_codes,
    register_and_lookup,
    register_codes,
    split_codes,
    spread,
    unregistered_codes,
)
from .merge import advance_state, align, apply_updates, merge, updated_rows
from .schema import (
    assert_overridden,
    conform,
    default_region,
    drop_columns,
    force_constants,
    lower_names,
    narrow_decimals,
    override_columns,
    pad_columns,
    project_state,
    region_code,
    select_except,
    stamp_audit,
)

__all__ = [name for name in dir() if not name.startswith("_")]
