"""End-to-end runs of the simple entities against a store."""

from datetime import datetime, timezone

import pytest

from mastermill import ENTITIES, RunOptions, compact, open_store, run_entity
from mastermill.plans.entity import AUDIT
from tests.conftest import rows

BOM = ENTITIES["bill_of_materials"]


def extract(spark, data, columns="ASSEMB string, COMPNT string, NAME string, COMQTY string, CRTDAT string"):
    return spark.createDataFrame(data, columns)


DAY_ONE = [
    ("A1", "C1", "first", "3", "2024-01-01 00:00:00"),
    ("A1", "C2", "second", "x", "not a date"),
    ("A1", "C2", "second", "4", None),
    ("A2", "C1", None, "5", None),
    (None, "C1", "no key", "6", None),
    ("A3", None, "no key", "6", None),
]


def options(run_ts, **kw):
    return RunOptions(run_ts=run_ts, **kw)


@pytest.fixture(params=[0, 4], ids=["plain", "bucketed"])
def store(request, spark, tmp_path):
    return open_store(spark, str(tmp_path / "bom"), BOM, buckets=request.param)


def test_first_load(spark, store, run_ts):
    record = run_entity(store, BOM, extract(spark, DAY_ONE), options(run_ts, file_name="f.csv", region="AUS"))
    assert (record.csv_count, record.data_insert_count, record.data_update_count) == (6, 3, 0)
    assert record.status == "Success"
    target = store.read("target")
    assert target.columns == ["id", *BOM.target_columns]
    assert rows(target, "assemb", "compnt", "name", "comqty") == [
        ("A1", "C1", "first", 3),
        ("A1", "C2", "second", 4),
        ("A2", "C1", None, 5),
    ]
    assert sorted(r.id for r in target.collect()) == [1, 2, 3]
    state = store.read("state")
    assert state.columns == ["assemb", "compnt", "code", "hash_value", "check_sum"]
    assert {r.code for r in state.collect()} == {"A1C1", "A1C2", "A2C1"}
    audit = spark.read.parquet(f"{store.root}/{AUDIT}").first()
    assert audit.file_name == "f.csv" and len(audit.file_code) == 64


def test_same_file_twice_changes_nothing(spark, store, run_ts):
    run_entity(store, BOM, extract(spark, DAY_ONE), options(run_ts))
    before = store.head()
    later = datetime(2025, 1, 1, tzinfo=timezone.utc)
    shuffled = extract(spark, DAY_ONE[::-1]).select("CRTDAT", "COMQTY", "NAME", "COMPNT", "ASSEMB")
    record = run_entity(store, BOM, shuffled, options(later))
    assert (record.data_insert_count, record.data_update_count) == (0, 0)
    assert store.head() == before


def test_updates_inserts_and_nulls(spark, store, run_ts):
    run_entity(store, BOM, extract(spark, DAY_ONE), options(run_ts))
    ids = {(r.assemb, r.compnt): r.id for r in store.read("target").collect()}
    later = datetime(2025, 1, 1, tzinfo=timezone.utc)
    day_two = [("A1", "C1", None, "3", "2024-01-01 00:00:00"), ("A1", "C2", "second", "4", None), ("B1", "C1", "new", "1", None)]
    record = run_entity(store, BOM, extract(spark, day_two), options(later))
    assert (record.data_insert_count, record.data_update_count) == (1, 1)
    target = store.read("target")
    assert store.registered if store.buckets else not store.registered
    assert rows(target, "assemb", "compnt", "name") == [
        ("A1", "C1", None),
        ("A1", "C2", "second"),
        ("A2", "C1", None),
        ("B1", "C1", "new"),
    ]
    after = {(r.assemb, r.compnt): r for r in target.collect()}
    assert {k: after[k].id for k in ids} == ids and after[("B1", "C1")].id == 4
    assert after[("A1", "C1")].created_date.year == 2025 and after[("A1", "C2")].created_date.year == 2024
    assert store.read("state").count() == 4
    assert store.read("state").select("assemb", "compnt").distinct().count() == 4


def test_preserve_created(spark, store, run_ts):
    run_entity(store, BOM, extract(spark, DAY_ONE), options(run_ts))
    later = datetime(2025, 1, 1, tzinfo=timezone.utc)
    run_entity(store, BOM, extract(spark, [("A1", "C1", "x", "3", None)]), options(later, preserve_created=True))
    row = store.read("target").filter("assemb = 'A1' and compnt = 'C1'").first()
    assert row.name == "x" and row.created_date.year == 2024 and row.updated_date.year == 2025


def test_insert_only_run_keeps_segments_and_update_rewrites_only_its_segment(spark, store, run_ts):
    run_entity(store, BOM, extract(spark, DAY_ONE), options(run_ts))
    first = store.live_segments("target", store.head())
    run_entity(store, BOM, extract(spark, [("B1", "C1", "n", "1", None)]), options(run_ts))
    second = store.live_segments("target", store.head())
    assert second[:1] == first and len(second) == 2
    run_entity(store, BOM, extract(spark, [("B1", "C1", "m", "1", None)]), options(run_ts))
    third = store.live_segments("target", store.head())
    assert third[:1] == first and len(third) == 2 and third[1] != second[1]
    assert store.read("target").count() == 4


def test_compaction(spark, store, run_ts):
    for n in range(4):
        run_entity(store, BOM, extract(spark, [(f"B{n}", "C1", "n", "1", None)]), options(run_ts))
    before = sorted(store.read("target").collect())
    assert len(store.live_segments("target", store.head())) == 4
    assert compact(store, most=3) == 3 and compact(store) == 2 and compact(store) == 0
    assert len(store.live_segments("target", store.head())) == 1
    assert sorted(store.read("target").collect()) == before and store.read("state").count() == 4


@pytest.mark.parametrize("buckets", [0, 8])
def test_one_update_rewrites_one_slice_of_target_and_state(spark, tmp_path, run_ts, buckets):
    store = open_store(spark, str(tmp_path / "s"), BOM, buckets, unit_rows=500)
    rows = [(f"A{n}", "C1", "n", "1", None) for n in range(4000)]
    run_entity(store, BOM, extract(spark, rows), options(run_ts))
    for change in "xy":
        before = store.head()
        record = run_entity(store, BOM, extract(spark, [("A7", "C1", change, "1", None)]), options(run_ts))
        assert record.data_update_count == 1
        for table in ("target", "state"):
            old, new = store.live_segments(table, before), store.live_segments(table, store.head())
            written = [u for u in new if u not in old]
            assert len(old) == len(new) == 8 and len(written) == 1 and len(set(old) - set(new)) == 1
            assert 300 < store.read_segments(table, written).count() < 700
        assert store.read("target").count() == store.read("state").count() == 4000
        assert [r.assemb for r in store.read("target").filter(f"name = '{change}'").collect()] == ["A7"]


def test_swapped_contents_are_both_updates(spark, store, run_ts):
    run_entity(store, BOM, extract(spark, [("A", "C", "x", "1", None), ("B", "C", "y", "2", None)]), options(run_ts))
    swapped = extract(spark, [("A", "C", "y", "2", None), ("B", "C", "x", "1", None)])
    assert run_entity(store, BOM, swapped, options(run_ts)).data_update_count == 2


def test_ambiguous_concatenated_keys_stay_apart(spark, store, run_ts):
    data = [("ab", "c", "x", "1", None), ("a", "bc", "y", "2", None)]
    assert run_entity(store, BOM, extract(spark, data), options(run_ts)).data_insert_count == 2
    assert run_entity(store, BOM, extract(spark, data), options(run_ts)).data_update_count == 0


def test_null_and_empty_differ(spark, store, run_ts):
    run_entity(store, BOM, extract(spark, [("A", "C", None, "1", None)]), options(run_ts))
    assert run_entity(store, BOM, extract(spark, [("A", "C", "", "1", None)]), options(run_ts)).data_update_count == 1


def test_all_keys_null(spark, store, run_ts):
    record = run_entity(store, BOM, extract(spark, [(None, "C", "x", "1", None), ("A", None, "x", "1", None)]), options(run_ts))
    assert (record.csv_count, record.data_insert_count, record.status) == (2, 0, "Success")
    assert store.head() is None


def test_empty_extract(spark, store, run_ts):
    assert run_entity(store, BOM, extract(spark, []), options(run_ts)).status == "Empty"
    assert store.head() is None


def test_failure_is_audited_and_publishes_nothing(spark, store, run_ts):
    with pytest.raises(ValueError, match="equal but for case"):
        run_entity(store, BOM, spark.createDataFrame([("a", "b")], "RGCD string, rgcd string"), options(run_ts))
    with pytest.raises(ValueError, match="key columns missing"):
        run_entity(store, BOM, spark.createDataFrame([("a",)], "assemb string"), options(run_ts))
    audit = spark.read.parquet(f"{store.root}/{AUDIT}")
    assert {r.status for r in audit.collect()} == {"Failed"}
    assert store.head() is None


def test_run_id_is_loaded_once(spark, store, run_ts):
    run_entity(store, BOM, extract(spark, DAY_ONE), options(run_ts, run_id="AUS/f.csv"))
    again = run_entity(store, BOM, extract(spark, [("Z", "Z", "z", "1", None)]), options(run_ts, run_id="AUS/f.csv"))
    assert again.status == "Skipped" and store.read("target").count() == 3
