import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mastermill.llm import induced_sorting, near_dedup, substring_dedup
from mastermill.llm.components import connected_components
from mastermill.llm.line_dedup import dedup_line_runs, dedup_lines, repeated_chunks
from mastermill.llm.near_dedup import near_duplicates, shingles
from mastermill.llm.substring_dedup import dedup_substrings


def shingle_set(text, n):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


def components(sets, percent):
    """Smallest reachable id by id, by comparing all pairs."""
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("words, percent", [(3, 85), (5, 80)])
def test_near_duplicates_against_all_pairs(docs, texts, words, percent):
    sets = {i: shingle_set(t, words) for i, t in enumerate(texts)}
    want = components(sets, percent)
    got = {r.doc_id: r for r in near_duplicates(docs, words, percent).collect()}
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {i: (len(sets[i]), want[i], want[i] == i) for i in sets}


def test_a_bucket_of_several_components_is_compared_in_full(spark, monkeypatch):
    """A chain in which only neighbours are linked, with the smallest id at one end, in many small blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 4000)
    r = random.Random(3)
    words = [f"w{r.randrange(10**6)}" for _ in range(260)]
    texts = [" ".join(words[4 * i : 4 * i + 100]) for i in range(40)]
    sets = {i: shingle_set(t, 3) for i, t in enumerate(texts)}
    got = near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 3, 85).collect()
    assert {x.doc_id: x.component_id for x in got} == components(sets, 85) == dict.fromkeys(range(40), 0)


def test_joining_links_finds_links_between_members(monkeypatch):
    import pandas as pd

    sets = [np.arange(0, 100), np.arange(5, 105), np.arange(10, 110), np.arange(1000, 1100)]
    sets = [near_dedup.mixed(s.astype(np.uint64)) for s in sets]
    sets = [np.sort(s) for s in sets]
    a, b = near_dedup.universal()
    rows = pd.DataFrame({"class": [1, 2, 3, 4], "root": [1, 1, 3, 4], "size": [100] * 4, "minima": [near_dedup.signature(s, a, b).tobytes() for s in sets], "full": [s.tobytes() for s in sets]})
    assert near_dedup.joining_links(rows, 85) == [(2, 3)]


def test_near_duplicates_odd_rows(spark, empty):
    assert near_duplicates(empty).count() == 0
    text = "one two three four five six seven"
    rows = [(None, text, "x"), (1, text, None), (1, text, "y"), (2, text.upper(), "z"), (3, None, "z"), (4, "", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, class string")
    got = sorted(near_duplicates(df).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert [(r.doc_id, r.component_id, r.kept) for r in got] == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True), (4, 4, True), (None, None, True)]


def test_components_of_a_long_path(spark):
    r = random.Random(1)
    names = r.sample(range(10_000), 300)
    links = spark.createDataFrame(list(zip(names[:200], names[1:201])) + [(7, 7)], "a long, b long")
    got = {x.node: x.root for x in connected_components(links).collect()}
    assert got == dict.fromkeys([n for n in names[:201] if n != min(names[:201])], min(names[:201]))


def shared_prefix(text, a, b, cap):
    k = 0
    while k < cap and max(a, b) + k < len(text) and text[a + k] == text[b + k]:
        k += 1
    return k


def test_suffix_array_and_prefixes_against_sorting(monkeypatch):
    r = np.random.default_rng(5)
    for bucket in (1, 3, 64):
        monkeypatch.setattr(induced_sorting, "BUCKET", bucket)
        for n in (0, 1, 2, 7, 50, 200):
            for letters in (1, 2, 5, 300):
                for cap in (2, 31, 255):
                    text = r.integers(0, letters, n)
                    want = sorted(range(n), key=lambda i: text[i:].tolist())
                    order, shared = induced_sorting.suffix_array(text, memory=int(r.choice([3, 20, 10**6])), cap=cap)
                    assert order.tolist() == want
                    assert shared[1:].tolist() == [shared_prefix(text, a, b, cap) for a, b in zip(want, want[1:])]


def test_a_shard_of_ten_times_the_queue_spills_and_gives_the_same(monkeypatch):
    r = np.random.default_rng(6)
    words = [r.integers(1, 9, int(r.integers(2, 40))) for _ in range(300)]
    text = np.concatenate([words[i] for i in r.integers(0, 300, 3000)])
    queues, real = [], induced_sorting.BucketQueue

    def kept(*args):
        queues.append(real(*args))
        return queues[-1]

    monkeypatch.setattr(induced_sorting, "BucketQueue", kept)
    whole = induced_sorting.suffix_array(text, cap=31)
    assert not any(q.spills for q in queues)
    queues.clear()
    small = induced_sorting.suffix_array(text, memory=len(text) // 10, cap=31)
    assert sum(q.spills for q in queues) >= 4 and all((a == b).all() for a, b in zip(whole, small))


def test_minima_of_ranges():
    r = np.random.default_rng(7)
    values = r.integers(0, 256, 300).astype(np.uint8)
    made, grown = induced_sorting.Minima(values), induced_sorting.Minima()
    for v in values.tolist():
        grown.append(v)
    a, b = r.integers(0, 300, 500), r.integers(0, 300, 500)
    want = [int(values[x : y + 1].min()) if y >= x else 99 for x, y in zip(a, b)]
    assert made.least(a, b, 99).tolist() == grown.least(a, b, 99).tolist() == want


def brute_substrings(rows, window):
    first = {}
    for d, t in rows:
        for i in range(len(t) - window + 1):
            first[t[i : i + window]] = min(d, first.get(t[i : i + window], d))
    out = {}
    for d, t in rows:
        gone = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if first[t[i : i + window]] < d:
                gone[i : i + window] = b"\1" * window
        out[d] = (len(t), bytes(c for c, g in zip(t, gone) if not g), len([x for x in bytes(gone).split(b"\0") if x]))
    return out


@pytest.mark.parametrize("buffer, shard", [(1 << 19, 4 << 20), (300, 500)])
def test_substrings_against_all_windows(docs, texts, monkeypatch, buffer, shard):
    monkeypatch.setattr(substring_dedup, "BUFFER", buffer)
    monkeypatch.setattr(substring_dedup, "SHARD_BYTES", shard)
    got = {r.doc_id: (r.n_bytes, bytes(r.kept), len(r.spans)) for r in dedup_substrings(docs).collect()}
    assert got == brute_substrings([(i, (t or "").encode()) for i, t in enumerate(texts)], 50)


@pytest.mark.parametrize("length", [24, 46])
def test_a_common_phrase_is_spread_over_shards(spark, monkeypatch, length):
    """A phrase in ever different surroundings shares its fingerprints but hardly a window."""
    limit = 4000
    monkeypatch.setattr(substring_dedup, "SHARD_BYTES", limit)
    r = random.Random(length)
    word = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    # Whose least hash is low enough to be the fingerprint of most windows around it.
    phrase = next(p for p in iter(lambda: word(length), None) if substring_dedup.gram_hashes(np.frombuffer(p.encode(), np.uint8)).min() < 2**57)
    passage = word(70)
    texts = [word(60) + phrase + (passage if i % 50 == 7 else word(60)) for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    seen, real = [], substring_dedup.sharded
    monkeypatch.setattr(substring_dedup, "sharded", lambda *a: seen.append(real(*a)) or seen[-1])
    got = {x.doc_id: (x.n_bytes, bytes(x.kept), len(x.spans)) for x in dedup_substrings(docs).collect()}
    assert got == brute_substrings([(i, t.encode()) for i, t in enumerate(texts)], 50)
    sizes = [x.size for x in seen[0][1].groupBy("shard").agg(F.sum(F.length("body")).alias("size")).collect()]
    assert sum(sizes) > 10 * limit and max(sizes) < 3 * limit


def test_substrings_odd_rows(spark, empty):
    assert dedup_substrings(empty).count() == 0
    text = "z" * 60
    rows = [(None, text, 1), (5, text, 2), (5, text, 3), (6, "z" * 49, 4)]
    got = dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string, part int")).collect()
    # Nothing is smaller than null; rows of one doc_id do not remove from each other, but the null row is before both.
    assert sorted(((r.doc_id, len(r.kept)) for r in got), key=str) == [(5, 0), (5, 0), (6, 49), (None, 60)]


def brute_lines(rows):
    def h(line):
        return int(hashlib.md5(line.encode()).hexdigest()[:12], 16)

    seen, out = {}, {}
    for d, t in rows:
        lines = (t or "").split("\n")
        chunks, now = [], []
        for i, line in enumerate(lines):
            now.append(line)
            alone = any(len(x.encode()) >= 50 for x in lines[i : i + 2])
            if alone or i and (h(lines[i - 1]) * 31 + h(line)) % 2 == 0:
                chunks.append(now)
                now = []
        chunks += [now] if now else []
        left = []
        for k, c in enumerate(chunks):
            if (len(c) > 1 or len(c[0].encode()) >= 50) and seen.setdefault("\n".join(c), (d, k)) != (d, k):
                continue
            left += c
        out[d] = (t if len(left) == len(lines) else "\n".join(left), len(lines), len(left))
    return out


def test_line_dedup_against_a_scan(docs, texts):
    got = {r.doc_id: (r.text, r.n_lines, r.n_kept_lines) for r in dedup_lines(docs).collect()}
    want = brute_lines(list(enumerate(texts)))
    assert got == want and any(n != k for _, n, k in want.values())


def test_line_dedup_finds_planted_passages(spark):
    """Passages of 3 to 8 lines in ever different surroundings: lines of a sentence go whole, of short lines a third goes."""
    r = random.Random(11)
    line = lambda n: " ".join(f"w{r.randrange(10**6)}" for _ in range(n))
    for words, least in ((12, 1.0), (3, 0.3)):
        passages = [[line(words) for _ in range(k)] for k in range(3, 9) for _ in range(10)]
        rows = []
        for p in passages:
            for _ in range(2):
                rows.append((len(rows), "\n".join([*[line(words) for _ in range(r.randint(1, 3))], *p, *[line(words) for _ in range(r.randint(1, 3))]])))
        got = {x.doc_id: x.text.split("\n") for x in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        lost = sum(sum(x not in got[2 * n + 1] for x in p) for n, p in enumerate(passages))
        assert lost >= least * sum(map(len, passages))
        assert all(set(got[2 * n]) == set(rows[2 * n][1].split("\n")) for n in range(len(passages)))


def test_line_dedup_odd_rows(spark, empty):
    assert dedup_lines(empty).columns[-2:] == ["n_lines", "n_kept_lines"] and dedup_lines(empty).count() == 0
    text = "\n".join("abcdefgh")
    df = spark.createDataFrame([(None, text, "a"), (1, text, "b"), (1, text, "c"), (2, None, "d")], "doc_id long, text string, N_Lines string")
    got = sorted(dedup_lines(df).collect(), key=str)
    assert dedup_lines(df).columns == ["doc_id", "text", "n_lines", "n_kept_lines"]
    assert [r.n_kept_lines for r in got if r.doc_id == 1] == [8, 8] and [r.text for r in got if r.doc_id == 2] == [None]
    assert [r.n_kept_lines < 8 for r in got if r.doc_id is None] == [repeated_chunks(df.select("doc_id", "text")).filter(F.lit(True)).count() > 0]


def brute_runs(rows, least):
    """Every line of every run of whole lines of ``least`` bytes that stands earlier too, by looking at all runs."""
    seen, out = set(), {}
    for d, t in rows:
        lines = (t or "").split("\n")
        gone = set()
        for i in range(len(lines)):
            for j in range(i, len(lines)):
                run = "\n".join(lines[i : j + 1])
                if len(run.encode()) + 1 >= least:
                    gone |= set(range(i, j + 1)) if run in seen else set()
                    seen.add(run)
        left = [x for i, x in enumerate(lines) if i not in gone]
        out[d] = ("\n".join(left) if gone else t, len(lines), len(left))
    return out


def test_line_runs_find_planted_passages(spark):
    r = random.Random(11)
    line = lambda n: " ".join(f"w{r.randrange(10**6)}" for _ in range(n))
    passages = [[line(r.choice((1, 2, 4, 15))) for _ in range(k)] + [line(9)] for k in range(2, 8) for _ in range(5)]
    around = [[[line(12) for _ in range(r.randint(0, 3))] for _ in range(4)] for _ in passages]
    rows = [(i, "\n".join(a[0] + p + a[1])) for i, (p, a) in enumerate(zip(passages, around))]
    rows += [(100 + i, "\n".join(a[2] + p + a[3])) for i, (p, a) in enumerate(zip(passages, around))]
    got = {x.doc_id: x.text for x in dedup_line_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: t for i, t in rows[:30]} | {100 + i: "\n".join(a[2] + a[3]) for i, a in enumerate(around)}


def test_line_runs_against_all_runs(docs, texts, spark, empty):
    r = random.Random(2)
    short = ["\n".join(r.choice(("", "a", "bcd", "x" * 20, "y" * 49, "é" * 25)) for _ in range(r.randint(1, 60))) for _ in range(60)]
    for df, rows in ((docs, texts), (spark.createDataFrame(list(enumerate(short)), "doc_id long, text string"), short)):
        got = {x.doc_id: (x.text, x.n_lines, x.n_kept_lines) for x in dedup_line_runs(df).collect()}
        assert got == brute_runs(list(enumerate(rows)), 50)
    assert dedup_line_runs(empty).count() == 0


def test_line_runs_odd_rows(spark):
    text = "\n".join("abcdefgh" * 10)
    rows = [(None, text, "a"), (1, text, "b"), (1, text, "c"), (2, None, "d"), (3, "", "e")]
    got = sorted(dedup_line_runs(spark.createDataFrame(rows, "doc_id long, text string, N_Lines string")).collect(), key=str)
    assert [(x.doc_id, x.n_kept_lines, x.text is None) for x in got if x.doc_id != 1] == [(2, 1, True), (3, 1, False), (None, 0, False)]
    assert len({x.text for x in got if x.doc_id == 1}) == 1 and min(x.n_kept_lines for x in got if x.doc_id == 1) > 0
