"""Runs of several files: their new rows and updates, stored by rewritten and by marked slices."""

from dataclasses import replace

import pytest

from mastermill import ENTITIES, RunOptions, open_store, run_day
from tests.conftest import rows
from tests.test_files_and_streams import DAY, put

SUPPLIER = replace(ENTITIES["supplier"], files={"AUS": "AUSSUPPLR"})


@pytest.mark.parametrize(("rewrite_rows", "legacy"), [(1024, False), (0, False), (0, True)])
def test_two_files_of_a_day_are_stored(spark, tmp_path, run_ts, rewrite_rows, legacy):
    """Before, every run of files failed: the new rows, stored without the name of their file, were asked for it."""
    store, folder = open_store(spark, str(tmp_path / "store"), SUPPLIER, unit_rows=20, rewrite_rows=rewrite_rows), tmp_path / "in" / "AUS"

    def load(numbered, *texts):
        for n, text in enumerate(texts):
            put(folder, f"AUSSUPPLR_{numbered}{n}_20240508.csv", text)
        return [(r.status, r.csv_count, r.data_insert_count, r.data_update_count) for r in run_day(store, SUPPLIER, str(tmp_path / "in"), DAY, options)]

    options = RunOptions(run_ts=run_ts, legacy_fingerprint=legacy)
    many = "".join(f"S{i},old\n" for i in range(10, 90))
    first = load("a", f"VACODE,VANAME\n{many}S1,one\n", "VACODE,VANAME\nS1,uno\nS2,two\n")
    assert first == [("Success", 81, 80, 0), ("Success", 2, 2, 0)]
    second = load("b", "VACODE,VANAME\nS10,new\n", "VACODE,VANAME\nS1,uno\nS3,three\n")
    assert second[2:] == [("Success", 1, 0, 1), ("Success", 2, 1, 0)]
    names = {f"S{i}": "old" for i in range(10, 90)} | {"S1": "uno", "S2": "two", "S3": "three", "S10": "new"}
    assert rows(store.read("target"), "vacode", "vaname") == sorted(names.items())
    assert rows(store.read("state"), "vacode") == sorted((n,) for n in names)
    assert "_origin" not in store.read("target").columns
    assert sorted(r.id for r in store.read("target").select("id").collect()) == list(range(1, len(names) + 1))
