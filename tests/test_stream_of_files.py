"""A micro-batch of several files that holds new rows and updates."""

from mastermill import ENTITIES, RunOptions, open_store
from mastermill.streaming import ingest_stream
from tests.conftest import rows
from tests.test_files_and_streams import put

FRANCHISE = ENTITIES["franchise"]


def test_batches_of_several_files_are_stored(spark, tmp_path, run_ts):
    """Before, every batch failed and the stream ended without a commit."""
    store, prefix = open_store(spark, str(tmp_path / "store"), FRANCHISE), next(iter(FRANCHISE.files.values()))
    region = next(iter(FRANCHISE.files))

    def load(names):
        for name, text in names.items():
            put(tmp_path / "in", f"{prefix}{name}.csv", text)
        args = (store, FRANCHISE, str(tmp_path / "in"), str(tmp_path / "checkpoint"), region, RunOptions(run_ts=run_ts))
        ingest_stream(*args).awaitTermination()
        return store.head().version

    assert load({"1": "FRANCDN,FRANDS\n1,a\n2,b\n", "2": "FRANDS,FRANCDN\nc,3\nd,1\n"}) == 1
    assert load({"3": "FRANCDN,FRANDS\n2,e\n", "4": "FRANCDN,FRANDS\n4,f\n"}) == 2
    assert rows(store.read("target"), "francdn", "frands") == [(1, "d"), (2, "e"), (3, "c"), (4, "f")]
    assert rows(store.read("state"), "francdn") == [(1,), (2,), (3,), (4,)]
