"""Rows without what can be made again: the same after a round trip, and what a run keeps and publishes."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from mastermill import ENTITIES, RunOptions, open_store, run_entity
from mastermill.functions.keys import packed_hash, unpacked_hash
from mastermill.plans.entity import LeanRows, conform_extract, finish_rows, valid_rows

from .conftest import rows

MAP = ENTITIES["franchise_code_map"]
HEADER = "fsoldt string, frchdisp string, fdscd string, fshipt string, other string"
LINES = [("a", "1", "x", "s", "o"), ("b", "2", "y", None, "p"), ("c", "3", "z", "t", None)]


def test_packed_hashes_keep_every_text_apart(spark):
    texts = ["0a" * 20, "0A" * 20, "-17", "12", "123", "", None, "\x01ab", "g0"]
    df = spark.createDataFrame([(t,) for t in texts], "hash_value string").withColumn("packed", packed_hash(F.col("hash_value")))
    assert rows(df.select("hash_value")) == rows(df.select(unpacked_hash(F.col("packed"))))
    assert df.select("packed").distinct().count() == len(texts)
    assert len(df.first().packed) == 21


@pytest.mark.parametrize("legacy", [False, True])
def test_lean_rows_are_made_whole_again(spark, run_ts, legacy):
    options = RunOptions(run_ts=run_ts, legacy_fingerprint=legacy)
    resolved = valid_rows(conform_extract(spark.createDataFrame(LINES, HEADER), MAP), MAP)
    finished = finish_rows(resolved, MAP, options)
    leaner = LeanRows.of(finished, resolved, MAP, options)
    lean = leaner.lean(finished.withColumn("_change", F.lit("insert")))
    assert set(lean.columns) == {"fsoldt", "frchdisp", "fdscd", "fshipt", "_change"} | ({"hash_value", "check_sum"} if legacy else set())
    again = leaner.full(lean)
    assert dict(again.drop("_change").dtypes) == dict(finished.dtypes)
    assert rows(again, *finished.columns) == rows(finished)
    part, stored = leaner.state(lean, list(MAP.delta_keys))
    assert "code" not in part.columns and dict(part.dtypes)["hash_value"] == "binary"
    assert rows(stored(part)) == rows(finished.select(*MAP.delta_keys, "code", "hash_value", "check_sum"))


def test_slices_hashed_in_another_way_are_replaced_when_all_their_rows_come(spark, tmp_path, run_ts):
    """Before, every old row of such a slice was listed as deleted and the slice stayed."""
    store = open_store(spark, str(tmp_path / "s"), MAP, unit_rows=2, rewrite_rows=0)
    options = RunOptions(run_ts=run_ts)
    run_entity(store, MAP, spark.createDataFrame(LINES, HEADER), options)
    before = store.head()
    changed = [("a", "1", "x", "new", "o"), *LINES[1:], ("d", "4", "w", "s", "o")]
    record = run_entity(store, replace(MAP, fingerprint="murmur"), spark.createDataFrame(changed, HEADER), options)
    head = store.head()
    assert (record.data_insert_count, record.data_update_count) == (1, 1)
    assert not any(head.deletes.values())
    assert not set(head.units["target"]) & set(before.units["target"])
    assert rows(store.read("target"), "fsoldt", "fshipt") == [("a", "new"), ("b", None), ("c", "t"), ("d", "s")]
    assert store.read("target").select("id").distinct().count() == 4
    assert store.read("state").filter(F.col("hash_value") == F.col("check_sum").cast("string")).count() == 4
