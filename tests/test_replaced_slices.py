"""What a load moves for slices that it replaces: old rows once for the target and not at all for the state, where its hashes follow from the target."""

from dataclasses import replace

from pyspark.sql import functions as F

from mastermill import ENTITIES, RunOptions, open_store, run_entity
from mastermill.plans import entity
from mastermill.plans.entity import FOLLOWS
from mastermill.sources import SnapshotStore

from .conftest import rows

BOM = ENTITIES["bill_of_materials"]


def load(store, ids, revnum, qty=None, spec=BOM, **options):
    data = [(f"A{i}", "C", revnum, qty and qty(i)) for i in ids]
    header = "ASSEMB string, COMPNT string, REVNUM string" + (", COMQTY string" if qty else "")
    return run_entity(store, spec, store.spark.createDataFrame([r[: 4 if qty else 3] for r in data], header), RunOptions(**options))


def watch(monkeypatch):
    """For each segment: the table, the parts that are moved, and the plans of those that are not."""
    seen, write = [], SnapshotStore.write_segment

    def watched(self, table, *parts, placed=(), **kw):
        frames = [p[0] if isinstance(p, tuple) else p for p in placed]
        seen.append((table, len(parts), [df._jdf.queryExecution().executedPlan().toString() for df in frames]))
        return write(self, table, *parts, placed=placed, **kw)

    monkeypatch.setattr(SnapshotStore, "write_segment", watched)
    return seen


def held(store, spec=BOM):
    """The stored state beside the one that the target's rows have."""
    target = store.read("target")
    want = entity.finish_rows(target.select(*[c for c in target.columns if c != "id"]), spec, RunOptions())
    want = want.select(*spec.delta_keys, "code", "hash_value", "check_sum")
    return rows(store.read("state"), *want.columns), rows(want)


def test_old_rows_move_once_for_the_target_and_not_for_the_state(spark, tmp_path, monkeypatch):
    """Before, the joined rows were shuffled again by slice, and the old state beside them."""
    store = open_store(spark, str(tmp_path / "s"), BOM, unit_rows=50, rewrite_rows=0)
    load(store, range(200), "n", qty=str)
    seen = watch(monkeypatch)
    record = load(store, [*range(0, 200, 2), *range(200, 260)], "m")  # no quantity: null in updated rows, kept in the others
    assert (record.data_insert_count, record.data_update_count) == (60, 100)
    (table, moved, joined), (other, none, state) = seen
    assert (table, moved, other, none) == ("target", 1, "state", 0)
    assert len(joined) == len(state) == 1
    assert joined[0].count("Exchange hashpartitioning") <= 2 and "REPARTITION_BY_NUM" in joined[0]
    assert "Exchange" not in state[0]
    got, want = held(store)
    assert got == want and len(got) == 260
    shown = {r.assemb: (r.revnum, r.comqty) for r in store.read("target").collect()}
    assert shown["A2"] == ("m", None) and shown["A3"] == ("n", 3) and shown["A201"] == ("m", None)
    units = store.head().units
    assert list(units["target"]) == list(units["state"]) and store.head().counters[FOLLOWS] == 1
    for unit in units["state"]:
        both = [store.read_segments(t, [unit]).select(*BOM.delta_keys, F.lit(1)) for t in ("target", "state")]
        assert rows(both[0]) == rows(both[1])


def test_state_that_does_not_follow_from_the_target_is_kept(spark, tmp_path):
    """Hashes of columns that the target holds otherwise are carried over; a later run finds the rows unchanged."""
    spec = replace(BOM, not_updated=("revnum",))
    store = open_store(spark, str(tmp_path / "s"), spec, unit_rows=50, rewrite_rows=0)
    load(store, range(200), "n", spec=spec)
    assert store.head().counters[FOLLOWS] == 1
    load(store, range(0, 200, 2), "m", spec=spec)  # the target keeps "n", the state has the hash with "m"
    assert store.head().counters[FOLLOWS] == 0
    load(store, range(1, 200, 4), "o", qty=str)  # slices are replaced again, also by a spec that would follow
    assert store.head().counters[FOLLOWS] == 0
    record = load(store, range(0, 200, 2), "m")
    assert (record.data_insert_count, record.data_update_count) == (0, 0)
    got, want = held(store)
    assert len(got) == 200 and got != want
