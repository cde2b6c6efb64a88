"""New rows are written from the staged files, where their shuffle by key left them, and are not moved for their slices."""

import pytest
from pyspark.sql import functions as F

from mastermill import ENTITIES, RunOptions, open_store, run_entity
from mastermill.operators import number_by_position
from mastermill.plans import entity
from mastermill.sources import SnapshotStore, tables

from .conftest import rows

BOM = ENTITIES["bill_of_materials"]


def load(store, ids, name="n"):
    data = [(f"A{i}", "C", name) for i in ids]
    return run_entity(store, BOM, store.spark.createDataFrame(data, "ASSEMB string, COMPNT string, NAME string"), RunOptions())


def right(store, names):
    target = store.read("target")
    assert rows(target, "assemb", "name") == sorted(names.items())
    assert sorted(r.id for r in target.select("id").collect()) == list(range(1, len(names) + 1))
    resolved = target.select(*[c for c in target.columns if c != "id"])
    want = entity.finish_rows(resolved, BOM, RunOptions()).select(*BOM.delta_keys, "code", "hash_value", "check_sum")
    assert rows(store.read("state"), *want.columns) == rows(want)
    for unit in store.head().units["state"]:
        held = [store.read_segments(t, [unit]).select(*BOM.delta_keys) for t in ("target", "state")]
        assert rows(held[0]) == rows(held[1])
    store.release()


@pytest.mark.parametrize(("buckets", "files"), [(0, 16), (4, 16), (0, 0)])
def test_new_rows_are_not_moved_for_their_slices(spark, tmp_path, monkeypatch, buckets, files):
    """Before, every new row was shuffled from the staged files into its slice; rows whose files hold many slices still are."""
    seen, write = [], SnapshotStore.write_segment

    def watched(self, table, *parts, **kw):
        if table == "target":
            seen.append((len(parts), len(kw.get("standing", ()))))
        return write(self, table, *parts, **kw)

    monkeypatch.setattr(SnapshotStore, "write_segment", watched)
    monkeypatch.setattr(tables, "STANDING_FILES", files)
    monkeypatch.setattr(tables, "SCANNED_ROWS", 20)  # several scans
    store = open_store(spark, str(tmp_path / "s"), BOM, buckets=buckets, unit_rows=50, rewrite_rows=0)
    names = {f"A{i}": "n" for i in range(200)}
    assert load(store, range(200)).data_insert_count == 200
    right(store, names)
    record = load(store, [3, *range(200, 300)], "m")
    assert (record.data_insert_count, record.data_update_count) == (100, 1)
    right(store, names | {f"A{i}": "m" for i in [3, *range(200, 300)]})
    assert seen == ([(0, 1), (1, 1)] if files else [(1, 0), (2, 0)])


def test_scans_of_a_few_files_number_rows_as_one_scan_does(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "SCANNED_ROWS", 1)
    store, path = open_store(spark, str(tmp_path / "s"), BOM), str(tmp_path / "a folder")
    spark.range(1000).withColumn("kind", F.lit("x")).repartition(11).write.partitionBy("kind").parquet(path)
    stored = spark.read.parquet(path)
    parts = store.scans(f"{path}/kind=x", stored, 1000)
    assert len(parts) == -(-11 // spark.sparkContext.defaultParallelism)
    assert rows(number_by_position(stored.withColumnRenamed("id", "v"), 5)) == rows(
        number_by_position(stored.withColumnRenamed("id", "v"), 5, parts=[p.withColumnRenamed("id", "v") for p in parts])
    )


def test_slices_divide_the_partitions_of_the_shuffle(spark, tmp_path):
    """A divisor is taken while its slices hold 0.6 to 1.25 times the rows of a unit."""
    store = open_store(spark, str(tmp_path / "s"), BOM, unit_rows=100)  # the session has 4 partitions
    assert [store.dealt_slices(n) for n in (100, 101, 200, 260, 400, 500, 501, 1000)] == [1, 2, 2, 4, 4, 4, 6, 10]
