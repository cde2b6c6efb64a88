"""Daily use that once went wrong: late seeds, empty code columns, leftovers of dead writers, another user."""

import os
from dataclasses import replace

import pytest

from mastermill import ENTITIES, open_store, run_entity
from mastermill.plans.entity import RunOptions

SPEC = ENTITIES["customer"]


def extract(spark, chain, keys=("1", "2")):
    names = sorted({*SPEC.keys, *(r.source for r in SPEC.rules), "name"})
    rows = [tuple(chain if c == "chainc" else k if c in SPEC.keys else None for c in names) for k in keys]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names))


def load(store, spec, df, user="system", dims=None, run="r"):
    return run_entity(store, spec, df, RunOptions(run_id=run, user=user), dims or {})


def simple_rows(spark, spec, n=5):
    names = [c for c in spec.target_columns if c in (*spec.keys, "name")]
    return spark.createDataFrame([tuple(str(i) for _ in names) for i in range(n)], ", ".join(f"{c} string" for c in names))


def test_another_user_causes_no_updates(spark, tmp_path):
    spec = ENTITIES["franchise_code_map"]
    store = open_store(spark, str(tmp_path / "s"), spec)
    first = load(store, spec, simple_rows(spark, spec), run="a")
    second = load(store, spec, simple_rows(spark, spec), user="other", run="b")
    assert first.data_insert_count == 5 and (second.data_insert_count, second.data_update_count) == (0, 0)


def test_a_leftover_folder_does_not_wedge_the_store(spark, tmp_path):
    spec = ENTITIES["franchise_code_map"]
    store = open_store(spark, str(tmp_path / "s"), spec)
    load(store, spec, simple_rows(spark, spec), run="a")
    os.makedirs(tmp_path / "s" / "commit_log" / "v0000000002")
    assert load(store, spec, simple_rows(spark, spec, 7), run="b").data_insert_count == 2


def test_two_commits_from_one_head(spark, tmp_path):
    spec = ENTITIES["franchise_code_map"]
    store = open_store(spark, str(tmp_path / "s"), spec)
    store.commit("a", {"target": ["x"]}, None)
    with pytest.raises(RuntimeError, match="already exists"):
        store.commit("b", {"target": ["y"]}, None)
    assert store.head().run_id == "a" and not store.has_run("b")
    assert replace(spec) == spec


@pytest.mark.parametrize("chain", [None, "A"])
def test_seeds_given_later_keep_their_ids(spark, tmp_path, chain):
    register = {r.dimension for r in SPEC.rules if getattr(r, "missing", "") == "register"}
    store = open_store(spark, str(tmp_path / "s"), SPEC)
    load(store, SPEC, extract(spark, chain), run="a")
    name = next(r.dimension for r in SPEC.rules if getattr(r, "source", "") == "chainc")
    assert name in register
    seed = spark.createDataFrame([(500, "B", "late")], "id long, code string, name string")
    load(store, SPEC, extract(spark, "B", ("3",)), dims={name: seed}, run="b")
    load(store, SPEC, extract(spark, "C", ("4",)), run="c")
    ids = {r.code: r.id for r in store.read("dimensions").filter(f"dimension = '{name}'").collect()}
    assert ids["B"] == 500 and ids["C"] == 501 and len(set(ids.values())) == len(ids)
    wrong = spark.createDataFrame([(7, "B", "other")], "id long, code string, name string")
    with pytest.raises(ValueError, match="stored 500"):
        load(store, SPEC, extract(spark, "D", ("5",)), dims={name: wrong}, run="d")
