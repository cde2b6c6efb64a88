"""Tasks of op2 hold one bounded part of their rows at a time."""

import pyarrow as pa
import pytest

from mastermill.llm import substring_dedup
from mastermill.llm.substring_dedup import dedup_substrings

from .test_dedup import brute_substrings


class NoRows:
    def rows(self, part):
        return None


def test_a_part_is_sent_before_the_next_one_is_read():
    """Before, a task sent nothing until it had read all its rows, so its memory grew with them."""
    read = []

    def batches():
        for part in (3, 3, 4, 7):
            read.append(part)
            texts = [f"{part} {len(read)} ".encode() * 30, b"short"]
            yield pa.RecordBatch.from_arrays([pa.array([part] * 2, pa.int32()), pa.array([1, 2], pa.int64()), pa.array(texts)], ["part", "doc", "text"])

    sent = substring_dedup._sending(NoRows(), 50, 1)(batches())
    assert next(sent)["part"].to_pylist() == [3] and read == [3, 3, 4]
    assert [b["part"][0].as_py() for b in sent] == [4, 7]


@pytest.mark.parametrize("part_bytes", [300, 900, 1 << 30])
def test_parts_of_a_task_are_bounded_and_change_nothing(spark, docs, texts, monkeypatch, part_bytes):
    """Before, a task was one part however much it read."""
    kept, real = [], substring_dedup.stored
    monkeypatch.setattr(substring_dedup, "stored", lambda df, label: kept.append(real(df, label)) or kept[-1])
    got = {r.doc_id: (r.n_bytes, bytes(r.kept), len(r.spans)) for r in dedup_substrings(docs.coalesce(1), part_bytes=part_bytes).collect()}
    assert got == brute_substrings([(i, (t or "").encode()) for i, t in enumerate(texts)], 50)
    parts = kept[0].selectExpr("part", "octet_length(text) AS size").groupBy("part").agg({"size": "sum", "*": "count"}).collect()
    assert (len(parts) == 1) == (part_bytes == 1 << 30)
    assert all(r["sum(size)"] < part_bytes + 13_000 for r in parts)
