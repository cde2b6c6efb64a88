"""Random extracts against a brute-force model of the target."""

import hashlib
import random
from datetime import datetime, timedelta, timezone

import pytest

from mastermill import ENTITIES, RunOptions, compact, open_store, run_entity
from mastermill.plans.entity import finish_rows
from tests.conftest import rows

MAP = ENTITIES["franchise_code_map"]


def greatest(versions):
    """The surviving payload of a key: greatest ``fshipt``, then ``name``, nulls last."""
    return max(versions, key=lambda v: [(x is not None, x or "") for x in v])


@pytest.mark.parametrize("buckets", [0, 4])
def test_target_matches_the_model(spark, tmp_path, buckets):
    rng = random.Random(7)
    store, model = open_store(spark, str(tmp_path / "s"), MAP, buckets), {}
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    for day in range(4):
        data = [
            (rng.choice("abcde"), str(rng.randint(1, 4)), rng.choice(["x", "y", None]), rng.choice(["p", "q", "", None]), rng.choice(["n", None]))
            for _ in range(40)
        ]
        # One key holds a third of all rows.
        data += [("hot", "1", "x", str(rng.randint(0, 9)), None) for _ in range(20)]
        extract = spark.createDataFrame(data, "FSOLDT string, FRCHDISP string, FDSCD string, FSHIPT string, NAME string")
        record = run_entity(store, MAP, extract, RunOptions(run_ts=start + timedelta(days=day)))
        compact(store)
        versions = {}
        for sold, disp, code, ship, name in data:
            if code is not None:
                versions.setdefault((sold, int(disp), code), []).append((ship, name))
        today = {k: greatest(v) for k, v in versions.items()}
        inserts = [k for k in today if k not in model]
        updates = [k for k in today if k in model and model[k] != today[k]]
        assert (record.csv_count, record.data_insert_count, record.data_update_count) == (60, len(inserts), len(updates))
        model |= today
        got = {(r.fsoldt, r.frchdisp, r.fdscd): (r.fshipt, r.name) for r in store.read("target").collect()}
        assert got == model and store.read("target").count() == len(model)
        assert sorted(r.id for r in store.read("target").collect()) == list(range(1, len(model) + 1))
        assert store.read("state").count() == len(model)


def test_legacy_fingerprint_is_the_plain_concatenation(spark, run_ts):
    df = spark.createDataFrame([("S", 5, "D", None)], "fsoldt string, frchdisp int, fdscd string, fshipt string")
    row = finish_rows(df, MAP, RunOptions(run_ts=run_ts, legacy_fingerprint=True)).first()
    text = "S" + "5" + "D" + "S5D" + "system" + "true" + "false" + "system" + " "
    assert row.hash_value == hashlib.sha1(text.encode()).hexdigest() and row.code == "S5D"


def test_reordered_columns_and_rows_give_the_same_target(spark, tmp_path, run_ts):
    data = [(c, str(n), "x", f"{c}{n % 3}") for n in range(5) for c in "ab"] * 2
    one = spark.createDataFrame(data, "fsoldt string, frchdisp string, fdscd string, fshipt string")
    two = one.orderBy("fshipt").select("fshipt", "fdscd", "fsoldt", "frchdisp").repartition(7)
    results = []
    for n, extract in enumerate((one, two)):
        store = open_store(spark, str(tmp_path / str(n)), MAP)
        run_entity(store, MAP, extract, RunOptions(run_ts=run_ts))
        results.append((rows(store.read("target").drop("id")), rows(store.read("state"))))
    assert results[0] == results[1]
