"""What a load moves: no copy of a large extract for the search of slices, and new rows once for target and state."""

from pyspark.sql import functions as F

from mastermill import ENTITIES, RunOptions, open_store, run_entity
from mastermill.plans import entity
from mastermill.sources import SnapshotStore

from .conftest import rows

BOM = ENTITIES["bill_of_materials"]


def load(store, ids, name="n"):
    data = [(f"A{i}", "C", name) for i in ids]
    return run_entity(store, BOM, store.spark.createDataFrame(data, "ASSEMB string, COMPNT string, NAME string"), RunOptions())


def test_a_large_extract_is_not_kept_for_the_search_of_slices(spark, tmp_path, monkeypatch):
    """Before, it was written and shuffled once more whatever its size."""
    labels, new_path = [], entity.new_work_path
    monkeypatch.setattr(entity, "new_work_path", lambda spark, label: labels.append(label) or new_path(spark, label))
    store = open_store(spark, str(tmp_path / "s"), BOM, unit_rows=50, rewrite_rows=0)
    load(store, range(500))
    record = load(store, range(600), "m")
    assert (record.data_insert_count, record.data_update_count, record.units_read) == (100, 500, 10)
    assert not [label for label in labels if label.endswith("-keyed")]
    record = load(store, [5, 700], "o")
    assert (record.data_insert_count, record.data_update_count) == (1, 1)
    assert [label for label in labels if label.endswith("-keyed")]


def test_new_rows_are_moved_once_for_target_and_state(spark, tmp_path, monkeypatch):
    """Before, the state of new rows was shuffled beside the target."""
    plans, write = [], SnapshotStore.write_segment

    def watched(self, table, *parts, placed=(), **kw):
        plans.extend((table, len(parts), done(df)._jdf.queryExecution().executedPlan().toString()) for df, done in placed)
        return write(self, table, *parts, placed=placed, **kw)

    monkeypatch.setattr(SnapshotStore, "write_segment", watched)
    store = open_store(spark, str(tmp_path / "s"), BOM, unit_rows=50, rewrite_rows=0)
    load(store, range(200))
    load(store, [3, *range(200, 300)], "m")
    assert [(table, parts) for table, parts, _ in plans] == [("state", 0), ("state", 1)]
    assert not any("Exchange" in text for _, _, text in plans)
    target = store.read("target")
    resolved = target.select(*[c for c in target.columns if c != "id"])
    want = entity.finish_rows(resolved, BOM, RunOptions()).select(*BOM.delta_keys, "code", "hash_value", "check_sum")
    assert rows(store.read("state"), *want.columns) == rows(want) and target.count() == 300
    units = store.head().units
    assert list(units["target"]) == list(units["state"])
    for unit in units["state"]:
        held = [store.read_segments(t, [unit]).select(*BOM.delta_keys, F.lit(1)) for t in ("target", "state")]
        assert rows(held[0]) == rows(held[1])
