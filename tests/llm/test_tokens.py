import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from mastermill.llm.packing import nonnegative_least_squares, pack, plan_ranges, plan_sequences
from mastermill.llm.queries import token_batches
from mastermill.llm.token_counts import TokenTotals, count_tokens
from mastermill.llm.token_files import ShardReader, pack_bits, read_token_files, unpack_bits, write_token_files
from mastermill.llm.tokens import Encoder
from tests.llm.conftest import SCHEMA


def plain_ids(path, text, plain=False):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = plain
    return t.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_library(path, texts):
    e = Encoder(path)
    more = ["don't 't 's", " a", "a ", "a\nb c\n", "x\ty z", "end. Next, one!! two%%% 3.5", "a\u200bb c", "a\x1c b"]
    every = [t or "" for t in texts] + more
    every += ["a <|endoftext|> b", "a<|endoftext|>b c", "<|endoftext|>", "x <|endoftext|", "one two\n<|endoftext|>three"]
    for _ in range(2):
        assert [x.tolist() for x in e.encode(every)] == [plain_ids(path, t) for t in every]
    assert [x.tolist() for x in Encoder(path, plain=True).encode(every)] == [plain_ids(path, t, True) for t in every]
    assert len(plain_ids(path, "<|endoftext|>")) == 1 < len(plain_ids(path, "<|endoftext|>", True))


def test_encoder_forgets_without_changing_results(path, texts, monkeypatch):
    monkeypatch.setattr("mastermill.llm.tokens.CACHE_UNITS", 3)
    e = Encoder(path)
    for t in texts:
        assert e.encode([t or ""])[0].tolist() == plain_ids(path, t)


@pytest.mark.parametrize("bits", [1, 5, 8, 15, 16, 17, 24, 32])
def test_bits_round_trip(bits):
    for n in (0, 1, 7, 1000):
        ids = np.random.default_rng(n).integers(0, 1 << bits, n).astype(np.uint32)
        data = pack_bits(ids, bits)
        assert len(data) % 8 == 0 and len(data) <= n * bits // 8 + 8
        assert unpack_bits(data, bits, n).tolist() == ids.tolist()


def test_token_files(docs, texts, path, monkeypatch):
    monkeypatch.setattr("mastermill.llm.token_files.BLOCK_IDS", 100)
    manifest = write_token_files(docs, path).cache()
    start = 0
    got = {r.doc_id: (r.start, r.n_tokens, zlib.crc32(r.ids)) for r in read_token_files(manifest).collect()}
    for i, t in enumerate(texts):
        ids = np.array([*plain_ids(path, t), 2], "<u4")
        assert got[i] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    shard = ShardReader(manifest.orderBy("shard").first().file)
    every = shard.ids(0, shard.n_ids)
    assert shard.bits == 16 and all((shard.ids(a, b) == every[a:b]).all() for a, b in ((0, 1), (99, 101), (150, 420), (7, 7)))
    assert shard.document(3).tolist() == every[shard.starts[3] : shard.starts[4]].tolist()


def test_token_files_odd_rows(spark, empty, path):
    assert read_token_files(write_token_files(empty, path)).count() == 0
    df = spark.createDataFrame([(None, "b", 1), (None, "a", 2), (3, "c", 3), (3, "c", 4)], "doc_id long, text string, start long")
    got = sorted(read_token_files(write_token_files(df, path)).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.n_tokens) for r in got] == [(None, 0, 2), (None, 2, 2), (3, 4, 2), (3, 6, 2)]


def test_packing_holds_every_id_once(docs, texts, path):
    packed = pack(docs, path, window=256)
    rows = packed.pieces.join(packed.places, "piece").collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert r.length == len(r.ids) // 4
    for i, t in enumerate(texts):
        parts = sorted(by_doc[i])
        assert [x for _, ids in parts for x in ids] == [*plain_ids(path, t), 1]
        assert [s for s, _ in parts] == np.cumsum([0, *[len(ids) for _, ids in parts[:-1]]]).tolist()
    for parts in by_sequence.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *[n for _, n in parts[:-1]]]).tolist() and sum(n for _, n in parts) <= 256
    total = sum(r.length for r in rows)
    assert len(by_sequence) <= math.ceil(total / 256) + 3
    whole = {r.sequence_id: r.ids for r in packed.sequences().collect()}
    assert sum(len(x) for x in whole.values()) == 4 * total


def test_packing_odd_rows(spark, empty, path):
    packed = pack(empty, path)
    assert packed.pieces.count() == packed.places.count() == 0
    df = spark.createDataFrame([(None, None, 1), (1, "", 2), (1, "", 3)], "doc_id long, text string, piece int")
    packed = pack(df, path)
    assert packed.pieces.join(packed.places, "piece").filter("length = 1 and doc_tokens = 1").count() == 3


def test_plans_use_every_piece_once():
    r = np.random.default_rng(2)
    for counts in (r.integers(0, 50, 65), np.eye(65, dtype=int)[3] * 1000, np.zeros(65, int), r.integers(0, 3, 65) * 100_000):
        counts[0] = 0
        used = np.zeros(65, int)
        for combination, repeats in plan_sequences(counts):
            assert repeats > 0 and sum(b * t for b, t in combination.items()) <= 64
            for b, t in combination.items():
                used[b] += t * repeats
        assert used.tolist() == counts.tolist()
        ranges = plan_ranges(counts)
        assert sum(hi - lo for _, lo, hi, _, _ in ranges) == counts.sum()


def test_nonnegative_least_squares_finds_an_exact_mix():
    combinations = np.array([[4, 0], [3, 1], [2, 2]])
    assert np.allclose(nonnegative_least_squares(combinations, np.array([0.0, 5, 6, 5, 7])), [7, 5, 3], atol=1e-5)


CHANGES = "op string, source string, lang string, version string, n_tokens long, old_tokens long, doc_id long"


def test_totals_are_additive_and_batches_idempotent(spark, tmp_path):
    store = TokenTotals(spark, str(tmp_path / "totals"))
    assert store.totals().count() == 0
    first = spark.createDataFrame([("insert", "a", "en", "1", 10, None, 1), ("insert", "a", "en", "1", 5, None, 1), ("insert", None, None, "1", None, None, 2)], CHANGES)
    second = spark.createDataFrame([("delete", "a", "en", "1", 5, None, 1), ("revise", "a", "en", "1", 12, 10, 1), ("delete", None, None, "1", None, None, 2)], CHANGES)
    assert store.commit("b1", first) and not store.commit("b1", first)
    got = lambda: sorted(map(tuple, store.totals().collect()), key=str)
    assert got() == [("a", "en", "1", 2, 15), (None, None, "1", 1, 0)]
    assert store.commit("b2", second) and got() == [("a", "en", "1", 1, 12)]
    store.compact()
    assert got() == [("a", "en", "1", 1, 12)] and not store.commit("b1", first)
    assert store.commit("b3", first) and got() == [("a", "en", "1", 3, 27), (None, None, "1", 1, 0)]
    store.compact()
    assert not store.commit("b2", second) and got() == [("a", "en", "1", 3, 27), (None, None, "1", 1, 0)]
    assert store.commit("b4", first.limit(0)) and len(got()) == 2


def test_two_attempts_of_a_batch_count_once(spark, tmp_path):
    store = TokenTotals(spark, str(tmp_path / "totals"))
    rows = spark.createDataFrame([("insert", "a", "en", "1", 10, None, 1)], CHANGES)
    store.commit("b1", rows)
    spark.createDataFrame([("a", "en", "1", 1, 10)], "source string, lang string, version string, n_docs long, n_tokens long").write.parquet(f"{store.path}/batch=b1~00ff")
    (tmp_path / "totals" / "batch=b2~0000").mkdir()  # a half-written attempt
    assert [tuple(r) for r in store.totals().collect()] == [("a", "en", "1", 1, 10)]


def test_unknown_operations_fail(spark, tmp_path):
    store = TokenTotals(spark, str(tmp_path / "totals"))
    with pytest.raises(Exception, match="unknown operation"):
        store.commit("b1", spark.createDataFrame([("drop", "a", "en", "1", 10, None, 1)], CHANGES))
    assert store.totals().count() == 0


def test_a_batch_committed_while_others_are_folded_counts_once(spark, tmp_path, monkeypatch):
    store = TokenTotals(spark, str(tmp_path / "totals"))
    rows = spark.createDataFrame([("insert", "a", "en", "1", 10, None, 1)], CHANGES)
    more = spark.createDataFrame([("insert", "a", "en", "1", 1, None, 1)], CHANGES)
    store.commit("b1", rows)
    other, listed = TokenTotals(spark, store.path), store._state

    def meanwhile():
        found = listed()
        other.commit("b2", more)
        return found

    monkeypatch.setattr(store, "_state", meanwhile)
    store.compact()
    assert [tuple(r) for r in other.totals().collect()] == [("a", "en", "1", 2, 11)]
    with pytest.raises(ValueError, match="kept for folded"):
        other.commit("folded-5", rows)
    other.compact()
    assert [tuple(r) for r in other.totals().collect()] == [("a", "en", "1", 2, 11)]


def test_the_batches_of_the_query_against_a_scan(spark, docs, texts, path, tmp_path):
    counts, store = count_tokens(docs, path), TokenTotals(spark, str(tmp_path / "totals"))
    assert [store.commit(name, changes) for name, changes in token_batches(counts)] == [True, False, True, True, True]
    want, seen = {}, set()
    for d, lang, source in sorted((r.doc_id, r.lang, r.source) for r in docs.collect()):
        text = texts[d] or ""
        if text in seen:
            continue
        seen.add(text)
        n = len(plain_ids(path, text))
        for version, tokens in (("bpe-1", n + 1), ("bpe-1-bare", n)):
            docs_, total = want.get((source, lang, version), (0, 0))
            want[source, lang, version] = (docs_ + 1, total + tokens)
    assert {(r.source, r.lang, r.version): (r.n_docs, r.n_tokens) for r in store.totals().collect()} == want


@pytest.mark.parametrize("window", [1001, 7, 257, 2047])
def test_windows_that_the_bins_do_not_divide(spark, docs, texts, path, window):
    packed = pack(docs, path, window=window, end_id=1)
    rows = packed.pieces.join(packed.places, "piece").collect()
    assert sum(r.length for r in rows) == sum(len(plain_ids(path, t)) + 1 for t in texts)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window


def test_counts_equal_the_library(docs, texts, path, empty):
    got = {r.doc_id: r.n_tokens for r in count_tokens(docs, path).collect()}
    assert got == {i: len(plain_ids(path, t)) for i, t in enumerate(texts)}
    assert count_tokens(empty, path).count() == 0 and SCHEMA and pa
