"""Nearest neighbours and hard negatives against brute force over all pairs."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from mastermill.llm import hard_negatives as H
from mastermill.llm import nearest as N

SCHEMA = "vec_id long, embedding array<float>, label int"


def unit_rows(n, width=16, seed=1, clusters=12):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, width)) * 0.7 + r.normal(size=(clusters, width))[r.integers(0, clusters, n)]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [(i, [float(v) for v in row.astype(np.float32)], int(r.integers(0, 4))) for i, row in enumerate(x)]


ODD = [
    (None, [1.0] * 16, 1), (90_000, None, 1), (90_100, [0.0] * 16, 1), (90_200, [], 1), (90_300, [None] + [1.0] * 15, 1), (90_400, [1.0, 2.0], 2),
    (90_500, [float("nan")] * 16, 0), (90_600, [float("inf")] + [0.0] * 15, 0), (90_700, [0.1] * 16, None),
]


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("name", "vector", "bucket", "cell", "anchor", "score", "rank"):
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3)


def complete(rows, width=16):
    good = [r for r in rows if r[0] is not None and r[1] and len(r[1]) == width and all(v is not None and np.isfinite(v) for v in r[1])]
    return {r[0]: r for r in good}.values()


def all_nearest(rows, every, count):
    kept = [r for r in complete(rows) if any(r[1])]
    ids = np.array([r[0] for r in kept])
    x = np.array([np.float32(r[1]) for r in kept]).astype(float)
    out = {}
    for q in np.nonzero(ids % every == 0)[0]:
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        order = [k for k in np.lexsort((ids, d)) if k != q][:count]
        out[int(ids[q])] = [(int(ids[k]), float(d[k])) for k in order]
    return out


def answers(df):
    out = {}
    for row in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(row.query_id, []).append((row.vec_id, row.score))
        assert row["rank"] == len(out[row.query_id])
    return out


def test_pseudo_rotations_keep_lengths_and_angles():
    x = np.random.default_rng(0).normal(size=(5, 12)) * 1e200
    scores = N.axis_scores(x, 0, 0)
    assert scores.shape == (5, 32) and np.allclose((scores[:, :16] ** 2).sum(1), 1)
    y = x / 1e200
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    assert np.allclose(scores[:, :16] @ scores[:, :16].T, y @ y.T)
    assert (N.probe_order(x, 1, 1, 1)[:, 0] == N.buckets_of(x, 1, 1)).all() and (N.probe_order(x, 1, 2, 1)[:, 0] == N.buckets_of(x, 1, 2)).all()


@pytest.mark.parametrize("cell_rows,hashes", [(8192, 1), (40, 1), (60, 2)])
def test_all_probes_give_all_neighbours(spark, monkeypatch, cell_rows, hashes):
    monkeypatch.setattr(N, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(N, "CELL_QUERIES", 7)
    rows = unit_rows(400)
    same = rows[33][1]
    rows += [(1000 + i, same, 0) for i in range(60)] + [rows[5], rows[5]] + [(2000, [v * 3 for v in rows[9][1]], 0)] + ODD
    found = answers(N.nearest(N.prepared(frame(spark, rows)), every=10, count=10, hashes=hashes, probes=32**hashes))
    assert found == all_nearest(rows, 10, 10)


def test_fitted_probes_reach_the_recall(spark, monkeypatch):
    monkeypatch.setattr(N, "CELL_ROWS", 300)
    rows = unit_rows(3000, seed=4)
    found, want = answers(N.nearest(N.prepared(frame(spark, rows)), every=20, count=10)), all_nearest(rows, 20, 10)
    hits = sum(len({a for a, _ in found[q]} & {a for a, _ in want[q]}) for q in want)
    assert hits >= 0.93 * 10 * len(want)
    x = np.array([r[1] for r in rows])
    assert N.fitted_probes(x, x[:50], 2, 1, 10, 0.97) < 32
    for q, got in found.items():
        assert all(s == dict(all_nearest([rows[q], rows[a]], q or 1, 1)[q])[a] for a, s in got[:2])


def test_few_and_no_vectors(spark):
    assert N.nearest(N.prepared(frame(spark, ODD))).count() == 0  # of two lengths that occur once each the lesser counts
    assert N.nearest(N.prepared(frame(spark, []))).count() == 0
    rows = [(0, [1e30, 0.0], 0), (1, [-1e30, 0.0], 0), (2, [0.5, 0.5], 1)]
    assert answers(N.nearest(N.prepared(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")))) == {
        0: [(2, pytest.approx(1e30)), (1, pytest.approx(2e30))]
    }


def all_negatives(rows, every):
    kept = [r for r in complete(rows) if r[2] is not None]
    v = {r[0]: np.floor(np.float32(r[1]).astype(float) * 256).astype(int) for r in kept}
    out = []
    for a, _, label in kept:
        if a % every:
            continue
        scored = [(-int(v[a] @ v[b]), b, other == label) for b, _, other in kept if b != a]
        for p, positive, _ in sorted(s for s in scored if s[2])[:5]:
            band = sorted(s for s in scored if not s[2] and 80 * -p <= 100 * -s[0] <= 100 * -p)[:5]
            out += [(a, positive, k + 1, b, -p, -s) for k, (s, b, _) in enumerate(band)]
    return sorted(out)


@pytest.mark.parametrize("block", [50, 16_384])
def test_hard_negatives(spark, monkeypatch, block):
    monkeypatch.setattr(H, "BLOCK_ROWS", block)
    monkeypatch.setattr(H, "BLOCK_ANCHORS", max(5, block // 10))
    rows = unit_rows(500, seed=2)
    rows += [(1000 + i, rows[20][1], i % 4) for i in range(60)] + [rows[5], rows[5]] + ODD
    found = H.hard_negatives(H.prepared(frame(spark, rows)), every=10, pilot=4)
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert sorted(tuple(r[c] for c in columns) for r in found.collect()) == all_negatives(rows, 10)


def test_bounds_hold_and_prune():
    r = np.random.default_rng(3)
    a, b = (pd.Series(list(np.floor(r.normal(size=(n, 24)) * s).astype(int).tolist())) for n, s in ((20, 90), (200, 300)))
    x, y = H.Block(a), H.Block(b)
    exact = (x.values @ y.values.T).astype(int)
    for (size, m, d), (_, n, e) in zip(x.levels, y.levels):
        assert (np.abs(exact - size * m @ n.T) <= size * d @ e.T + 1e-6).all()
    low, high = np.full(20, 20_000), np.full(20, 60_000)
    at, of, score = H.scores_within(x, y, low, high, np.ones((20, 200), bool))
    want = (exact >= 20_000) & (exact <= 60_000)
    assert set(zip(at.tolist(), of.tolist())) == set(zip(*[k.tolist() for k in np.nonzero(want)])) and (score == exact[at, of]).all()


def test_hard_negatives_without_rows(spark):
    assert H.hard_negatives(H.prepared(frame(spark, []))).count() == 0
    assert H.hard_negatives(H.prepared(frame(spark, ODD))).count() == 0
    with pytest.raises(Exception, match="2.20"):
        H.hard_negatives(H.prepared(spark.createDataFrame([(0, [1e9], 1), (1, [1e9], 1)], SCHEMA))).collect()
