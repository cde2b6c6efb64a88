"""Commits, manifests, deleted rows, pruning and removal in the store; skew by counts."""

import os
import threading
from dataclasses import replace
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from mastermill import ENTITIES, RunOptions, compact, open_store, run_entity
from mastermill.operators import lookups
from mastermill.operators.lookups import code_counts, lookup_optional, number_by_position, qualifying_codes, register_and_lookup, split_codes, spread
from mastermill.sources import SnapshotStore, small_files, tables
from mastermill.streaming import ingest_stream
from tests.conftest import rows

BOM = ENTITIES["bill_of_materials"]


def extract(spark, ids, name="n"):
    data = [(f"A{i}", "C", name) for i in ids]
    return spark.createDataFrame(data, "ASSEMB string, COMPNT string, NAME string")


def load(store, ids, name="n", spec=BOM, **options):
    return run_entity(store, spec, extract(store.spark, ids, name), RunOptions(**options))


def shown(store, at=None):
    return sorted((r.id, r.assemb, r.name) for r in store.read("target", at).collect())


# -- commits -----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("create", [small_files.write_new, small_files._renamed], ids=["link", "rename"])
def test_one_of_many_writers_creates_a_file(spark, tmp_path, create):
    target, won = f"{tmp_path}/v1.json", []

    def write(n):
        if create is small_files.write_new:
            won.append((n, create(spark, target, str(n))))
        else:
            small_files.write_text(spark, f"{tmp_path}/own{n}", str(n))
            won.append((n, create(spark, f"{tmp_path}/own{n}", target)))

    numbers = range(1) if create is small_files._renamed else range(8)
    threads = [threading.Thread(target=write, args=(n,)) for n in numbers]
    [t.start() for t in threads]
    [t.join() for t in threads]
    if create is small_files._renamed:
        write(9)
    winners = [n for n, ok in won if ok]
    assert len(winners) == 1 and small_files.read_text(spark, target) == str(winners[0])
    assert small_files.read_text(spark, f"{tmp_path}/none") is None


@pytest.mark.parametrize("clocks", [(1, 2), (2, 1)])
def test_two_writers_give_one_winner_whatever_their_clocks(spark, tmp_path, monkeypatch, clocks):
    a, b = SnapshotStore(spark, str(tmp_path / "s")), SnapshotStore(spark, str(tmp_path / "s"))
    base = a.commit("first", {"target": ["x"]}, None)
    heads = a.head(), b.head()

    class Clock(datetime):
        hour = 0

        @classmethod
        def now(cls, tz=None):
            return datetime(2024, 1, cls.hour, tzinfo=tz)

    monkeypatch.setattr(tables, "datetime", Clock)
    Clock.hour = clocks[0]
    b.commit("B", {"target": ["x", "b"]}, heads[1])
    Clock.hour = clocks[1]
    with pytest.raises(RuntimeError, match="version 2 already exists"):
        a.commit("A", {"target": ["x", "a"]}, heads[0])
    assert a.head().run_id == "B" and a.has_run("B") and not a.has_run("A") and a.has_run("first") and base.version == 1


def test_a_commit_does_not_grow_with_the_units(spark, tmp_path):
    store, sizes, head = SnapshotStore(spark, str(tmp_path / "s")), {}, None
    units = []
    for n in range(1, 40):
        units = [*units, *[f"s{n}-{k}" for k in range(100 if n == 20 else 1)]]
        head = store.commit(f"run{n}", {"target": units}, head)
        sizes[n] = os.path.getsize(store._commit_path(n).removeprefix("file:"))
    assert max(sizes[n] for n in range(20, 40)) < 64 * 200 and max(sizes[n] for n in range(21, 30)) < 2500
    assert store.head() == head and list(SnapshotStore(spark, store.root).head().tables["target"]) == units
    start, tail = store._log()
    assert start == 32 and len(tail) == 8 and store.known_runs(["run1", "run32", "run39", "run40"]) == {"run1", "run32", "run39"}
    assert store.runs().count() == 39 and store.at(3).tables == {"target": units[:3]}


def test_the_ledger_of_runs(spark, tmp_path):
    store = open_store(spark, str(tmp_path / "s"), BOM)
    assert [load(store, range(5), run_id=name).status for name in ("a", "b", "b")] == ["Success", "Success", "Skipped"]


# -- updates in proportion ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("buckets", [0, 4])
def test_updates_write_their_rows_and_the_places_of_the_old_ones(spark, tmp_path, buckets):
    store = open_store(spark, str(tmp_path / "s"), BOM, buckets, unit_rows=250, rewrite_rows=0)
    load(store, range(2000))
    first = store.head()
    assert len(first.tables["target"]) == (4 if buckets else 8)
    before = shown(store)
    record = load(store, range(0, 2000, 100), "changed")
    head = store.head()
    new = [u for u in head.tables["state"] if u not in first.tables["state"]]
    assert record.data_update_count == 20 and set(first.tables["target"]) < set(head.tables["target"])
    assert [store.read_segments(t, new).count() for t in ("target", "state")] == [20, 20]
    want = [(i, a, "changed" if int(a[1:]) % 100 == 0 else n) for i, a, n in before]
    assert shown(store) == want and store.read("state").count() == 2000 and shown(store, first) == before
    assert load(store, range(2000)).data_update_count == 20 and shown(store) == before
    assert load(store, [5, 2001], "x").data_insert_count == 1
    again = shown(store)
    while compact(store, deleted_share=0.001):
        pass
    assert shown(store) == again and not set(store.head().tables["state"]) & set(first.tables["state"])


def test_many_sets_of_deleted_rows_become_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "CHECKPOINT_EVERY", 3)
    store = open_store(spark, str(tmp_path / "s"), BOM, unit_rows=500, rewrite_rows=0)
    load(store, range(1000))
    for n in range(5):
        load(store, [n, 7], f"v{n}")
    head = store.head()
    assert len(head.deletes["target"]) <= 3 and store.deleted_counts("target", head)
    names = {a: n for _, a, n in shown(store)}
    assert [names[f"A{n}"] for n in range(6)] == ["v0", "v1", "v2", "v3", "v4", "n"] and names["A7"] == "v4" and len(names) == 1000


def test_readers_of_an_older_commit_and_removal(spark, tmp_path):
    store = open_store(spark, str(tmp_path / "s"), BOM, unit_rows=500)
    load(store, range(1000))
    old = store.head()
    load(store, range(1000), "m")
    want = shown(store)
    assert store.vacuum(timedelta(days=1)) == 0 and shown(store, old)[0][2] == "n"
    gone = store.vacuum(timedelta(0))
    assert gone >= 4 and shown(store) == want and store.read("state").count() == 1000
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        store.read("target", old).count()
    assert load(store, [1, 5000], "o").data_insert_count == 1 and store.vacuum(timedelta(0)) >= 0 and store.read("target").count() == 1001


# -- pruning -----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("buckets", [0, 4])
def test_a_small_extract_opens_the_slices_that_may_hold_its_keys(spark, tmp_path, monkeypatch, buckets):
    monkeypatch.setattr(tables, "FILTER_ROWS", 0)
    store = open_store(spark, str(tmp_path / "s"), BOM, buckets, unit_rows=400)
    for n in range(4):
        load(store, range(n * 1000, n * 1000 + 1000))
    units = len(store.head().tables["state"])
    assert units >= 8
    record = load(store, [5, 1005, 9005], "c")
    assert (record.data_insert_count, record.data_update_count) == (1, 2) and 2 <= record.units_read <= units // 2
    names = {a: n for _, a, n in shown(store)}
    assert names["A5"] == names["A1005"] == names["A9005"] == "c" and len(names) == 4001
    big = load(store, range(4000), "d")
    assert big.units_read == len(store.at(5).tables["state"]) and big.data_update_count == 4000


def test_filters_hold_every_key_and_few_others(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "FILTER_ROWS", 0)
    store = open_store(spark, str(tmp_path / "s"), BOM, unit_rows=100)
    load(store, range(0, 4000, 2))
    head = store.head()
    for ids in ([8], [2000, 2002]):
        keys = extract(spark, ids).select(F.col("ASSEMB").alias("assemb"), F.col("COMPNT").alias("compnt"))
        found = store.units_with("state", head, keys, ["assemb", "compnt"], len(ids))
        held = store.read_segments("state", found).filter(F.col("assemb").isin([f"A{i}" for i in ids])).count()
        assert held == len(ids) and len(found) <= len(ids)
    misses = extract(spark, range(1, 160, 2)).select(F.col("ASSEMB").alias("assemb"), F.col("COMPNT").alias("compnt"))
    assert len(store.units_with("state", head, misses, ["assemb", "compnt"], 80)) <= 8


# -- fingerprints ------------------------------------------------------------------------------------------------


def test_another_method_renews_hashes_and_updates_nothing(spark, tmp_path):
    store = open_store(spark, str(tmp_path / "s"), BOM, unit_rows=300)
    load(store, range(600))
    murmur = replace(BOM, fingerprint="murmur")
    before = shown(store)
    record = load(store, [*range(300), 900], spec=murmur)
    assert (record.data_insert_count, record.data_update_count) == (1, 0) and shown(store)[:600] == before
    lengths = sorted(len(r.hash_value) for r in store.read("state").collect())
    assert lengths.count(40) == 300 and len(lengths) == 601
    while compact(store, deleted_share=0.01):
        pass
    record = load(store, range(600), "n", spec=murmur)
    assert record.data_update_count == 0 and store.read("state").filter("length(hash_value) = 40").count() == 0
    assert load(store, range(600), "z", spec=murmur).data_update_count == 600


# -- files -------------------------------------------------------------------------------------------------------


def test_twenty_files_of_a_batch_make_one_commit(spark, tmp_path):
    supplier = ENTITIES["supplier"]
    folder = tmp_path / "AUS"
    folder.mkdir()
    for n in range(20):
        (folder / f"AUSSUPPLR_2024_{n:02d}_20240508.csv").write_text(f"VACODE,VANAME\nS{n},own\nS0,from {n:02d}\n")
    (folder / "AUSSUPPLR_2024_20_20240508.csv.gz").write_bytes(b"not gzip")
    store = open_store(spark, str(tmp_path / "store"), supplier)
    ingest_stream(store, supplier, str(folder), str(tmp_path / "checkpoint"), "AUS", RunOptions()).awaitTermination()
    assert store.head().version == 1 and store.read("target").count() == 20
    assert rows(store.read("target").filter("vacode = 'S0'"), "vaname") == [("from 19",)]
    audit = spark.read.parquet(f"{store.root}/run_audit")
    counts = {r.file_name: (r.status, r.csv_count, r.data_insert_count) for r in audit.collect()}
    assert counts["AUSSUPPLR_2024_20_20240508.csv.gz"][0] == "Failed" and len(counts) == 21
    assert counts["AUSSUPPLR_2024_19_20240508.csv"] == ("Success", 2, 2) and counts["AUSSUPPLR_2024_00_20240508.csv"] == ("Success", 2, 0)


# -- skew --------------------------------------------------------------------------------------------------------


def test_two_hundred_frequent_codes_none_above_the_target(spark):
    facts = spark.range(40_000).select(F.when(F.col("id") % 50 == 0, None).otherwise((F.col("id") % 201).cast("string")).alias("code"), "id")
    dim = spark.range(201).select(F.col("id").cast("string").alias("code"), "id")
    split = split_codes(code_counts(facts, F.col("code")), 100)
    assert split.count() == 201
    left, right = spread(facts, dim, "code", split)
    sizes = left.filter("code IS NOT NULL").groupBy("code", "_lookup_salt").count()
    assert sizes.agg(F.max("count")).first()[0] <= 100 and right.count() == split.agg(F.sum("slots")).first()[0]
    found = lookup_optional(facts, dim.withColumnRenamed("id", "of"), F.col("code"), {"of": ("of", "bigint")}, counts=code_counts(facts, F.col("code")), target_rows=100)
    assert found.count() == 40_000 and found.filter("cast(code as bigint) <> of OR (code IS NULL) <> (of IS NULL)").count() == 0


def test_split_codes_stay_within_their_bound(spark, monkeypatch):
    monkeypatch.setattr(lookups, "SPLIT_CODES", 10)
    facts = spark.range(1000).select((F.col("id") % 100).cast("string").alias("code"))
    assert split_codes(code_counts(facts, F.col("code")), 1).count() == 0


def test_flags_are_divided_by_their_counts(spark):
    actions = spark.range(3000).selectExpr("cast(id as string) AS code", "'F1' AS attr", "'yes' AS app", "timestamp '2024-05-08 10:00:00' AS effdt")
    flags = spark.createDataFrame([("F1", "True"), ("F2", "False")], "id string, code string")
    assert qualifying_codes(actions, flags, date(2024, 5, 8), target_rows=50).count() == 3000


def test_registration_reads_the_rows_once_for_codes_and_once_for_the_lookup(spark, tmp_path):
    spark.range(1000).selectExpr("cast(id % 7 as string) AS c", "id").write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    dim = spark.createDataFrame([("3", 1)], "code string, id bigint")
    found, fresh = register_and_lookup(facts, dim, F.col("c"), "out", datetime(2024, 5, 8, tzinfo=timezone.utc), salt=1)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [c#") == 1
    assert rows(fresh, "id") == [(i,) for i in range(2, 8)] and found.select("c", "out").distinct().count() == 7


def test_numbering_over_many_files(spark, tmp_path, monkeypatch):
    spark.range(500).repartition(9).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    want = rows(number_by_position(stored.withColumnRenamed("id", "v"), 5))
    monkeypatch.setattr(lookups, "NUMBERED_FILES", 1)
    monkeypatch.setattr(lookups, "BROADCAST_FILES", 1)
    assert rows(number_by_position(stored.withColumnRenamed("id", "v"), 5)) == want and sorted(i for i, _ in want) == list(range(6, 506))
