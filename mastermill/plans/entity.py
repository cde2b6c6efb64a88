"""Load one extract into an entity: conform, resolve codes, classify, merge, publish, audit."""

from __future__ import annotations

import functools
import uuid
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import Signature, business_key, category_ladder, code_prefix, packed_hash, signature, unpacked_hash, with_fingerprint
from ..operators.dedupe import dedupe_keys
from ..operators.delta import CHANGE, INSERT, OLD_HASH, UNCHANGED, UPDATE, classify_delta, count_changes, count_rows
from ..operators.filters import has_columns, require_keys, require_source
from ..operators.lookups import (
    TARGET_ROWS,
    action_gate,
    lookup_optional,
    lookup_or_drop,
    lookup_required,
    number_by_position,
    one_per_code,
    qualifying_codes,
)
from ..operators.merge import CREATED_COLUMNS, align, apply_updates, updated_rows
from ..operators.schema import (
    audit_values,
    conform,
    default_region,
    drop_columns,
    force_constants,
    lower_names,
    narrow_decimals,
    pad_columns,
    project_state,
    stamp_audit,
)
from ..session import new_work_path
from ..sources import small_files
from ..sources.files import is_empty
from ..sources.tables import COMPRESSION, FILE, PRUNED_UNITS, ROW, SEGMENT, Commit, SnapshotStore, Unit
from ..spec import AUDIT_COLUMNS, AUDIT_DATES, EntitySpec, GateRule
from .audit import EMPTY, FAILED, SKIPPED, SUCCESS, RunRecord, append_audit
from .dimensions import DIMENSION, DIMENSIONS, STORED_SCHEMA, Dimensions, by_file

TARGET, STATE, AUDIT = "target", "state", "run_audit"
RENEWAL = "renewal"  # a row whose stored hash alone is replaced
ORIGIN = "_origin"  # the file of a row, in runs of several files
FOLLOWS = "state.follows"  # a counter of commits: 1 while every stored hash and code can be made from the row of the target
PLACES = (SEGMENT, FILE, ROW)
BROADCAST_UPDATES = 1 << 16  # the most updated rows that are broadcast to the stored ones


@dataclass(frozen=True)
class RunOptions:
    """Choices of one run that are not part of the entity.

    ``broadcast_bytes`` is the greatest counted size of a dimension that is broadcast; beyond it, codes of more than ``target_rows`` rows are divided.
    """

    run_ts: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    region: str = ""
    file_name: str = ""
    file_date: date | None = None
    run_id: str = ""
    user: str = "system"
    legacy_fingerprint: bool = False
    preserve_created: bool = False
    narrow_inserts: bool = False
    broadcast_bytes: int = 64 << 20
    target_rows: int = TARGET_ROWS


def open_store(
    spark, root: str, spec: EntitySpec, buckets: int = 0, unit_rows: int = 1_000_000, rewrite_rows: int = 1024
) -> SnapshotStore:
    """Store of one entity, cut by the row key into slices of about ``unit_rows``; with ``buckets`` its target and state are
    clustered by that key. Slices of up to ``rewrite_rows`` are rewritten for an update."""
    return SnapshotStore(spark, root, buckets, {TARGET: spec.cluster_keys, STATE: spec.cluster_keys}, unit_rows, rewrite_rows)


def compact(store: SnapshotStore, most: int = 256, deleted_share: float = 0.1) -> int:
    """Rewrite at most ``most`` slices of target and state that are small or of which ``deleted_share`` is deleted, and as many small
    dimension segments, as fewer larger ones.

    Loads never do this. Call it between loads until it returns 0; it returns how many pieces it replaced, and publishes
    like a run. The rows stay the same.
    """
    head, before = store.head(), set(store.registered)
    if head is None:
        return 0
    tables: dict[str, list[str]] = {}
    facts: dict[str, dict[str, Unit]] = {}
    live = store.live_segments(STATE, head)
    small = store.small_units(STATE, live, most)
    number, holed = store.slices(sum(n for _, n in small)), _holed(store, head, deleted_share)
    gone = [unit for unit, _ in small] if number < len(small) else []
    gone = [*gone, *[unit for unit in holed if unit not in gone][: most - len(gone)]]
    replaced, known = 0, head.units.get(STATE, {})
    if gone:  # the rows of a slice have one signature
        sorts = Counter(known[unit].signature for unit in gone)
        first = max(sorts, key=lambda name: (sorts[name], str(name)))
        gone = [unit for unit in gone if known[unit].signature == first]
        if set(gone).isdisjoint(holed) and store.slices(sum(known[u].rows for u in gone)) >= len(gone):
            gone = []
    if gone:
        segment, keys = f"s{uuid.uuid4().hex}", store.bucket_keys[STATE]
        number = store.slices(sum(known[u].rows for u in gone) or sum(n for _, n in small))
        replaced += len(gone)
        store.write_segment(TARGET, store.rows(TARGET, head, gone), segment=segment, slices=number)
        packed = store.rows(STATE, head, gone).withColumn("hash_value", packed_hash(F.col("hash_value")))
        written = store.write_segment(STATE, (packed.drop(SEGMENT), _unpacked), segment=segment, slices=number)
        tables = dict.fromkeys((TARGET, STATE), [u for u in live if u not in set(gone)] + written)
        facts = dict.fromkeys((TARGET, STATE), store.describe(STATE, written, keys, number, first))
    live = store.live_segments(DIMENSIONS, head)
    gone = [s for s, _ in store.small_units(DIMENSIONS, live, most, STORED_SCHEMA)]
    if len(gone) > 1:
        replaced += len(gone)
        rows = by_file(store.read_segments(DIMENSIONS, gone, STORED_SCHEMA))
        written = store.write_segment(DIMENSIONS, rows, partition_by=[DIMENSION])
        tables[DIMENSIONS] = [s for s in live if s not in set(gone)] + written
    if tables:
        store.commit(f"compact-{uuid.uuid4().hex}", tables, head, facts=facts)
    store.release(keep=before)
    return replaced


def _unpacked(df: DataFrame) -> DataFrame:
    return df.withColumn("hash_value", unpacked_hash(F.col("hash_value")))


def _holed(store: SnapshotStore, head: Commit, share: float) -> list[str]:
    """Units of which that share of the rows, or more, is deleted."""
    if not head.deletes.get(STATE):
        return []
    units = head.units[STATE]
    counts = store.deleted_counts(STATE, head)
    return [unit for unit, n in counts.items() if unit in units and n >= share * max(1, units[unit].rows)]


def conform_extract(extract: DataFrame, spec: EntitySpec, region: str = "") -> DataFrame:
    """Names, constants, types and derived columns of an extract; one projection over the scan."""
    df = drop_columns(lower_names(extract), spec.drop)
    df = force_constants(df, spec.constants)
    if spec.region_default:
        df = default_region(df, region)
    missing = [k for k in spec.keys if k not in df.columns]
    if missing:
        raise ValueError(f"{spec.name}: key columns missing in the extract: {', '.join(missing)}")
    df = conform(df, spec.schema)
    if spec.category_ladder and "cat_cd" in df.columns:
        df = df.withColumns(category_ladder())
    return df


def valid_rows(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """Rows with complete keys, one per key; of several files the last by name that has the key."""
    first = [ORIGIN] if ORIGIN in df.columns else []
    return dedupe_keys(require_keys(df, spec.keys), spec.keys, [*first, *spec.order_by])


def finish_rows(df: DataFrame, spec: EntitySpec, options: RunOptions) -> DataFrame:
    """Target columns, ``code`` and fingerprint of resolved rows.

    Columns that the target does not hold and audit columns are left out of the hash, so neither they nor another
    user cause updates. The legacy fingerprint instead takes every column in file order.
    """
    df = df.withColumn("code", business_key(spec.code_columns))
    df = stamp_audit(df, options.run_ts, options.user, spec.validation_status)
    wanted, origin = dict(spec.target_columns), {ORIGIN: "string"} if ORIGIN in df.columns else {}
    if options.legacy_fingerprint:
        df = with_fingerprint(df, exclude=(*AUDIT_DATES, ORIGIN), legacy=True, method=spec.fingerprint)
        return pad_columns(df, wanted | {"code": "string", "hash_value": "string", "check_sum": "int"} | origin)
    df = pad_columns(df, wanted | {"code": "string"} | origin)
    return with_fingerprint(df, exclude=_unhashed(spec), method=spec.fingerprint)


def _unhashed(spec: EntitySpec) -> tuple[str, ...]:
    return (*AUDIT_COLUMNS, *(() if spec.keep_code else ("code",)), ORIGIN)


@dataclass(frozen=True)
class LeanRows:
    """Which columns of finished rows have to be kept, and how the others are made again.

    Audit columns and columns that the resolved rows lack have one value in a run, and code and fingerprint follow from the row (the legacy
    fingerprint is kept in packed form: it has columns that the target lacks). Shuffles, sorts and intermediate tables hold the rest alone.
    """

    spec: EntitySpec
    options: RunOptions
    types: Mapping[str, str]  # of the finished rows
    constant: tuple[str, ...]
    derived: tuple[str, ...]

    @classmethod
    def of(cls, finished: DataFrame, resolved: DataFrame, spec: EntitySpec, options: RunOptions) -> LeanRows:
        types = {f.name: f.dataType.simpleString() for f in finished.schema.fields}
        made = ("code", "hash_value", "check_sum")
        constant = tuple(c for c in types if c not in made and (c in AUDIT_COLUMNS or c not in resolved.columns))
        code = ("code",) if set(spec.code_columns) <= set(types) - set(constant) else ()
        return cls(spec, options, types, constant, code if options.legacy_fingerprint else (*code, "hash_value", "check_sum"))

    def lean(self, finished: DataFrame) -> DataFrame:
        """The columns to keep, and those that were added to the finished rows."""
        df = finished.drop(*self.constant, *self.derived)
        return df.withColumn("hash_value", packed_hash(F.col("hash_value"))) if "hash_value" in df.columns else df

    def full(self, lean: DataFrame) -> DataFrame:
        """The finished rows that :meth:`lean` was made from, with the added columns; without the file of a row where that was left out since."""
        added, options = [c for c in lean.columns if c not in self.types], self.options
        audit = audit_values(options.run_ts, options.user, self.spec.validation_status)
        df = lean.withColumns({c: F.lit(audit.get(c)).cast(self.types[c]) for c in self.constant})
        if "code" in self.derived:
            df = df.withColumn("code", business_key(self.spec.code_columns))
        if "hash_value" in self.derived:
            df = with_fingerprint(df, exclude=(*_unhashed(self.spec), *added), method=self.spec.fingerprint)
        else:
            df = _unpacked(df)
        return df.select(*[F.col(f"`{c}`") for c in [*self.types, *added] if c != ORIGIN or ORIGIN in lean.columns])

    def follows_from_target(self, target: DataFrame) -> bool:
        """Whether the state of a new row can be made from its row in a target of these columns: it holds all that is hashed, as it was hashed."""
        made = {"code", "hash_value"} <= set(self.derived) and not self.options.narrow_inserts
        have, wanted = dict(target.dtypes), self.spec.target_columns
        return made and set(self.spec.code_columns) <= set(wanted) and all(c == "code" or have.get(c) == self.types.get(c) for c in wanted)

    def updates_follow(self, target: DataFrame, update_columns: Sequence[str], keys: Sequence[str]) -> bool:
        """Whether the same holds of a row of this target after its update: the update overwrites all that is hashed and all of its code."""
        hashed = set(self.spec.target_columns) - set(_unhashed(self.spec))
        return self.follows_from_target(target) and hashed | set(self.spec.code_columns) <= {*update_columns, *keys}

    def state_of_target(
        self, target: DataFrame, keys: Sequence[str], earlier: bool = False
    ) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
        """As :meth:`state`, from the target's rows of new keys; where :meth:`follows_from_target`. The columns that a run has one value of are not read.

        With ``earlier`` the target holds rows of earlier runs as well, so these columns are read but for the audit columns.
        """
        absent = [c for c in self.constant if c in AUDIT_COLUMNS or not earlier]
        lean = target.select(*[c for c in self.spec.target_columns if c not in absent])

        def stored(df: DataFrame) -> DataFrame:
            nulls = {c: F.lit(None).cast(t) for c, t in self.spec.target_columns.items() if c in absent and c not in AUDIT_COLUMNS}
            df = df.withColumns(nulls).withColumn("code", business_key(self.spec.code_columns))
            return project_state(with_fingerprint(df, exclude=_unhashed(self.spec), method=self.spec.fingerprint), keys)

        return self._packed(stored(lean), keys) if earlier else (lean, stored)

    def state(self, lean: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
        """The rows of the state, as a part of a segment: hashes are packed, and a code that follows from the keys is left out."""
        return self._packed(project_state(self.full(lean), keys), keys)

    def _packed(self, rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
        rows = rows.withColumn("hash_value", packed_hash(F.col("hash_value")))
        follows = "code" in self.derived and "code" not in keys and set(self.spec.code_columns) <= set(keys)

        def stored(df: DataFrame) -> DataFrame:
            df = _unpacked(df)
            return project_state(df.withColumn("code", business_key(self.spec.code_columns)) if follows else df, keys)

        return (rows.drop("code") if follows else rows), stored


def row_signature(finished: DataFrame, spec: EntitySpec, options: RunOptions) -> Signature | None:
    """How :func:`finish_rows` hashed the rows; ``None`` for the legacy fingerprint, whose columns are those of the file."""
    if options.legacy_fingerprint:
        return None
    return signature(finished.drop("hash_value", "check_sum"), exclude=_unhashed(spec), method=spec.fingerprint)


def resolve_codes(df: DataFrame, spec: EntitySpec, dims: Dimensions, options: RunOptions) -> DataFrame:
    """Register unseen codes, then apply the rules in order as joins of one plan."""
    dims.register_all(df, spec)
    for rule in spec.rules:
        if isinstance(rule, GateRule):
            df = _gate(df, rule, dims, options)
            continue
        code = code_prefix(rule.source, rule.prefix)
        if rule.require_source or rule.missing != "null":
            df = require_source(df, rule.source)
        if rule.missing == "register":
            dim = dims.stored(rule.dimension)
        else:
            values = list(dict.fromkeys(value for value, _ in rule.outputs.values()))
            dim = one_per_code(dims.given_frame(rule.dimension), values)
        lookup = {"register": lookup_required, "null": lookup_optional, "drop": lookup_or_drop}[rule.missing]
        df = lookup(df, dim, code, rule.outputs, **dims.strategy(rule))
    return df


def _gate(df: DataFrame, rule: GateRule, dims: Dimensions, options: RunOptions) -> DataFrame:
    if not has_columns(df, rule.guard):
        return df
    if options.file_date is None:
        raise ValueError("the action gate needs the date of the file")
    actions, flags = dims.given_frame(rule.actions), dims.given_frame(rule.flags)
    codes = qualifying_codes(actions, flags, options.file_date, rule.flag_code, rule.app_value, options.target_rows)
    return action_gate(df, codes, F.col(rule.source), rule.columns)


def run_entity(
    store: SnapshotStore,
    spec: EntitySpec,
    extract: DataFrame,
    options: RunOptions | None = None,
    dimensions: Mapping[str, DataFrame] | None = None,
) -> RunRecord:
    """Load one extract and publish the result; returns the audit record, which is also appended.

    On failure nothing is published, the audit row says so and the error is raised. A run id that was
    published before is skipped, so a repeated delivery changes nothing; a run that changed nothing counts as published.
    """
    options = options or RunOptions()
    record = RunRecord(spec.name, options.file_name, options.region)

    def conformed() -> DataFrame | None:
        if options.run_id and store.has_run(options.run_id):
            record.close(SKIPPED, "run was published before")
        elif is_empty(extract):
            record.close(EMPTY, "extract has no rows")
        else:
            return conform_extract(extract, spec, options.region)

    run_conformed(store, spec, conformed, [record], [options.run_id] if options.run_id else [], options, dimensions)
    return record


def run_conformed(
    store: SnapshotStore,
    spec: EntitySpec,
    conformed: Callable[[], DataFrame | None],
    records: Sequence[RunRecord],
    run_ids: Sequence[str],
    options: RunOptions,
    dimensions: Mapping[str, DataFrame] | None = None,
) -> None:
    """Load the frame that ``conformed`` makes as one commit that stands for ``run_ids``, and append the audit records of its files.

    With several records the frame tells the file of a row in ``ORIGIN``. An error, also one while the frame is made, closes all
    records as failed and is raised.
    """
    before, work = set(store.registered), []
    try:
        frame = conformed()
        if frame is not None:
            _load(store, spec, frame, records, run_ids, options, dimensions or {}, work)
    except Exception as error:
        for record in records:
            record.close(FAILED, str(error))
        raise
    finally:
        store.release(keep=before)
        append_audit(store.spark, records, f"{store.root}/{AUDIT}")
        for folder in work:
            small_files.delete(store.spark, folder)


def _load(store, spec, conformed, records, run_ids, options, given, work) -> None:
    spark, head = store.spark, store.head()

    def staged(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
        path = new_work_path(spark, f"{spec.name}-{label}")
        work.append(path)
        df.write.option("compression", COMPRESSION).partitionBy(*partition_by).parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    dims = Dimensions(store, head, given, options)
    several = ORIGIN in conformed.columns
    read, uncounted = {}, conformed
    if several:
        read = {r[ORIGIN]: r["count"] for r in conformed.groupBy(ORIGIN).count().collect()}
    else:
        conformed, counted_rows = count_rows(conformed, f"read-{uuid.uuid4().hex}")
    rows = valid_rows(conformed, spec)
    if spec.rules:
        # Several jobs read the valid rows: keep them as columns on shared storage.
        rows = resolve_codes(staged(rows, "rows"), spec, dims, options)
    resolved, rows = rows, finish_rows(rows, spec, options)
    leaner = LeanRows.of(rows, resolved, spec, options)

    keys, looked = list(spec.delta_keys), store.live_segments(STATE, head)
    # Only an extract that is small against the stored rows is kept for the search below: a large one would be written and shuffled once more to find
    # that all slices are read. So its rows are counted first, where no job has done it yet.
    few = False
    if len(looked) >= PRUNED_UNITS:
        count = sum(read.values()) if several else counted_rows.get.get("rows", 0) if spec.rules else uncounted.count()
        few = store.prunable(STATE, head, count)
    if few:
        # Only the slices that may hold a key are read. The rows are needed twice for that, so they are kept.
        rows, found = count_rows(rows, f"keys-{uuid.uuid4().hex}")
        kept = staged(leaner.lean(rows), "keyed")
        looked = store.units_with(STATE, head, kept, keys, found.get.get("rows", 0))
        rows = leaner.full(kept.repartition(*keys))  # the join moves lean rows; their hashes are made after it
    state, now = store.rows(STATE, head, looked, places=True), row_signature(rows, spec, options)
    if state is None:
        nothing = {SEGMENT: "string", FILE: "string", ROW: "bigint"}
        classified = rows.withColumns({c: F.lit(None).cast(t) for c, t in nothing.items()}).withColumn(CHANGE, F.lit(INSERT))
    else:
        classified = _classified(rows, state, keys, head, looked, now)
    classified, counted = count_changes(classified, f"changes-{uuid.uuid4().hex}")
    changes = staged(leaner.lean(classified.filter(F.col(CHANGE) != UNCHANGED)), "changes", [CHANGE])
    kept_at = work[-1]
    inserted, updated, total = (counted.get.get(c, 0) for c in (INSERT, UPDATE, "total"))
    renewed = total - inserted - updated - counted.get.get(UNCHANGED, 0)
    by_file = {}
    if several and (inserted or updated):
        by_file = {(r[ORIGIN], r[CHANGE]): r["count"] for r in changes.groupBy(ORIGIN, CHANGE).count().collect()}
    for record in records:
        record.units_read = len(looked)
        record.csv_count = read.get(record.file_name, 0) if several else counted_rows.get.get("rows", 0)
        record.data_insert_count = by_file.get((record.file_name, INSERT), 0) if several else inserted
        record.data_update_count = by_file.get((record.file_name, UPDATE), 0) if several else updated

    tables = {DIMENSIONS: dims.segments} if dims.grown else {}
    counters = {name: dims.counters[name] for name in dims.grown}
    facts, deletes = {}, {}
    if inserted or updated or renewed:
        written, facts, deletes, follows = _write_version(
            store, spec, changes, f"{kept_at}/{CHANGE}={INSERT}", head, options, inserted, updated, renewed, now, staged, leaner
        )
        tables |= written
        counters[FOLLOWS] = int(follows)
        counters[TARGET] = (head.counters.get(TARGET, 0) if head else 0) + inserted
    if tables or run_ids:
        signatures = {now.name: asdict(now)} if now is not None else {}
        store.commit(run_ids[0] if run_ids else uuid.uuid4().hex, tables, head, counters, facts, deletes, run_ids, signatures)
    for record in records:
        empty = several and not record.csv_count
        record.close(EMPTY if empty else SUCCESS, "extract has no rows" if empty else "extract loaded")


def _classified(rows, state, keys, head, looked, now: Signature | None) -> DataFrame:
    """The rows with their change, each compared by the signature that its stored row was hashed with.

    A row that is the same under an older signature is a renewal: only its stored hash changes.
    """
    known = {unit: head.units[STATE][unit].signature for unit in looked}
    older = {name for name in known.values() if name in head.signatures and now is not None and name != now.name}
    if not older:
        return classify_delta(rows, state, keys, carry=PLACES)
    names = F.broadcast(state.sparkSession.createDataFrame([(u, n) for u, n in known.items() if n in older], f"{SEGMENT} string, _signature string"))
    state = state.join(names, SEGMENT, "left")
    columns = {name: Signature(**head.signatures[name] | {"columns": tuple(head.signatures[name]["columns"])}).of(rows) for name in sorted(older)}
    before = rows.withColumns({f"_hash_{name}": hashed for name, hashed in columns.items()})
    classified = classify_delta(before, state, keys, carry=[*PLACES, OLD_HASH, "_signature"])
    same = functools.reduce(lambda a, b: a | b, [(F.col("_signature") == n) & (packed_hash(F.col(f"_hash_{n}")) == F.col(OLD_HASH)) for n in columns])
    change = F.when((F.col(CHANGE) == UPDATE) & F.coalesce(same, F.lit(False)), RENEWAL).otherwise(F.col(CHANGE))
    return classified.withColumn(CHANGE, change).drop(OLD_HASH, "_signature", *[f"_hash_{n}" for n in columns])


def _write_version(
    store, spec, changes, inserts_at, head, options, inserted, updated, renewed, now, staged, leaner
) -> tuple[dict, dict, dict, bool]:
    """Write the segment of new rows and new versions of rows; the live units, their facts, the sets of deleted rows and ``FOLLOWS``.

    Old versions are left where they are and their places are stored as deleted. Slices that are small, or of which much changed, are
    replaced by the new segment instead, unless rows of them stay that were hashed in another way: the rows of a slice have one signature. A renewed
    row moves with its target row, so both tables keep the same slices. ``changes`` are lean rows, the new ones of them in the folder ``inserts_at``.

    New rows stand in the staged files as the shuffle by their keys left them. Where these files hold few slices each, they are written from there
    and move no more.

    While all stored hashes follow from the target, the state of a segment that replaces slices is made from the target's new slices and moves no rows of its own.
    """
    spark, keys, live = store.spark, list(spec.delta_keys), store.live_segments(STATE, head)
    inserts, updates = changes.filter(F.col(CHANGE) == INSERT), leaner.full(changes.filter(F.col(CHANGE).isin(UPDATE, RENEWAL))).drop(ORIGIN)
    rewritten: list[str] = []
    emptied: list[str] = []  # those of the rewritten slices whose rows all have a new version
    marked: list[str] = []
    name = now.name if now is not None else None
    if updated or renewed:
        for row in updates.groupBy(SEGMENT).count().toLocalIterator():
            unit = head.units[STATE][row[SEGMENT]]
            small, whole = unit.rows <= store.rewrite_rows or row["count"] * 10 >= unit.rows, row["count"] == unit.rows
            (rewritten if whole or small and unit.signature == name else marked).append(row[SEGMENT])
            if whole:
                emptied.append(row[SEGMENT])

    def numbered(parts: Sequence[DataFrame] = ()) -> DataFrame:
        return number_by_position(inserts, head.counters.get(TARGET, 0) if head else 0, parts=parts).drop(CHANGE, ORIGIN, *PLACES)

    fresh = numbered()

    def stored(lean: DataFrame) -> DataFrame:
        df = leaner.full(lean)
        if options.narrow_inserts:
            df = narrow_decimals(df, spec.narrow)
        return pad_columns(df, {"id": "bigint"} | spec.target_columns)

    target, state, deletes, moved, shape, together = [(fresh, stored)], [], {}, 0, stored(fresh), []
    update_columns = spec.update_columns
    if options.preserve_created:
        update_columns = [c for c in update_columns if c not in CREATED_COLUMNS]
    follows = leaner.follows_from_target(shape) and not renewed and (not live or head.counters.get(FOLLOWS) == 1)
    if rewritten:
        rest = store.rows(TARGET, head, rewritten).drop(SEGMENT)
        shape = rest
        target = [(fresh, lambda lean: align(stored(lean), shape))]
        follows = follows and leaner.updates_follow(rest, update_columns, keys)
    if marked:
        named = F.broadcast(spark.createDataFrame([(u,) for u in marked], f"{SEGMENT} string"))
        some = updates.join(named, SEGMENT, "left_semi")
        old = store.rows(TARGET, head, marked, places=True)
        follows = follows and leaner.updates_follow(old, update_columns, keys)
        changed = some.filter(F.col(CHANGE) == UPDATE)
        if updated <= BROADCAST_UPDATES and not store.buckets:
            changed = F.broadcast(changed)  # the stored rows stay where they are
        replaced = updated_rows(old, changed, keys, update_columns, carry=PLACES)
        if renewed:
            same = old.join(some.filter(F.col(CHANGE) == RENEWAL).select(*keys), keys, "left_semi")
            replaced = replaced.unionByName(same.select(*replaced.columns))
        replaced = staged(replaced, "replaced")
        moved = replaced.count()
        target.append(align(replaced, shape))
        keep = [u for u in live if u not in set(rewritten)]
        deletes = {
            TARGET: store.write_deletes(TARGET, replaced, moved, head, keep),
            STATE: store.write_deletes(STATE, some, moved, head, keep),
        }
    segment, number = f"s{uuid.uuid4().hex}", store.slices(inserted + moved, len(rewritten)) if rewritten else store.dealt_slices(inserted + moved)
    standing = []
    if inserted and not rewritten and (number > 1 or store.buckets) and store.stand(TARGET, inserts, number, inserted):
        standing = [(numbered(store.scans(inserts_at, changes, inserted)), target.pop(0)[1])]
    if rewritten:
        changed = changes.filter(F.col(CHANGE) == UPDATE)
        if number > 1 and not store.buckets and keys == list(store.bucket_keys[TARGET]):
            # Both sides are dealt by slice, so the joined rows stand in their slices and are not moved again.
            rest, changed = rest.repartition(number, *keys), changed.repartition(number, *keys)
            together = [apply_updates(rest, leaner.full(changed), keys, update_columns)]
        else:
            target.insert(0, apply_updates(rest, leaner.full(changed), keys, update_columns))
        partly = [u for u in rewritten if u not in set(emptied)]
        if partly and not follows:
            old_state = store.rows(STATE, head, partly).drop(SEGMENT)
            state = [old_state.join(updates.select(*keys), keys, "left_anti")]
    written, placed = store.write_segment(TARGET, *target, segment=segment, slices=number, placed=together, standing=standing), []
    if rewritten and follows:
        placed = [leaner.state_of_target(store.placed_rows(TARGET, written), keys, earlier=True)]
    elif inserted and leaner.follows_from_target(shape):
        # New rows, told by their ids, are hashed as they stand in the new slices of the target: they move once for both tables.
        start = head.counters.get(TARGET, 0) if head else 0
        placed = [leaner.state_of_target(store.placed_rows(TARGET, written).filter(F.col("id") > start), keys)]
        changes = changes.filter(F.col(CHANGE) != INSERT)
    if not (rewritten and follows) and (updated or renewed or not placed):
        state.append(leaner.state(changes, keys))
    written = store.write_segment(STATE, *state, segment=segment, slices=number, placed=placed)
    gone = set(rewritten)
    kept = [u for u in live if u not in gone] + written
    facts = store.describe(STATE, written, keys, number, name)
    return {TARGET: kept, STATE: kept}, {TARGET: facts, STATE: facts}, deletes, follows
