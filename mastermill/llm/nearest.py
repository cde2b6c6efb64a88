"""Approximate nearest neighbours by cross-polytope hashing.

A table turns unit vectors by a pseudo-rotation, three rounds of random signs and a fast Hadamard transform, and puts each at the nearest of
the signed axes; with ``hashes`` above one it takes as many independent axes. A query looks into the ``probes`` buckets of each table whose
axes it is nearest to. Candidates of all tables are ranked by exact distance on the original vectors.

Buckets are put together, in order, to cells of about ``CELL_ROWS`` rows, and a bucket above that size is split over several by hash, so a
task holds one cell beside a block of the queries that look into it. A query comes to a cell once, however many of its buckets it probes.
Vectors move once for each table. Equal vectors are one class: one row is hashed and compared, and the smallest ids of the class, as many
as an answer can hold, stand for all.

The number of probes is fitted: on a sample of at most ``SAMPLE_ROWS`` rows, drawn by hash, it is the least that finds ``recall`` of the true
neighbours of ``SAMPLE_QUERIES`` of them. In the whole table neighbours are nearer than in a sample, so there the recall is higher.
Only the number of probes comes from the sample; every row is in every table.

Defined results: rows with a null id, and vectors that are null, empty, zero, hold null or non-finite components, or have another length than
the most frequent one, take no part. An id names one vector: of several, that with the least hash counts; rows that repeat count once. Equal distances
go to the smaller id. Only if a query's probed buckets hold fewer than ``count`` other rows may it have fewer answers than there are rows; tables of
fewer rows than ``CELL_ROWS`` are probed whole. Without rows the result is empty. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .hard_negatives import usable

CELL_ROWS, CELL_QUERIES = 8_192, 2_048
SAMPLE_ROWS, SAMPLE_QUERIES = 16_384, 256
TABLES, RECALL = 2, 0.97
SECOND_HASH_ROWS = 1 << 22  # two axes a table from this many rows: 128 buckets of 64 dimensions would hold 32,768 each
BROADCAST_ROWS = 1 << 20  # 24 bytes a row
SLOTS = 64
SEED = 20_240


def prepared(rows: DataFrame) -> DataFrame:
    """``vec_id, vector, name`` of the rows that take part; equal vectors have one name, of 128 bits."""
    rows = rows.select(F.col("vec_id").cast("long"), F.col("embedding").alias("vector")).filter("vec_id IS NOT NULL")
    rows = rows.filter(usable(rows, "vector")).filter(F.exists("vector", lambda x: x != 0))
    length = rows.agg(F.mode(F.size("vector"), deterministic=True)).scalar()
    name = F.struct(F.xxhash64("vector").alias("a"), F.xxhash64(F.lit("b"), "vector").alias("b")).alias("name")
    return rows.filter(F.size("vector") == length).select("vec_id", "vector", name)


def hadamard(x: np.ndarray) -> np.ndarray:
    """The rows' fast Hadamard transform, of a length that is a power of two, scaled to keep lengths."""
    n = x.shape[1]
    step = 1
    while step < n:
        pairs = x.reshape(len(x), n // (2 * step), 2, step)
        x = np.concatenate((pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]), axis=2).reshape(len(x), n)
        step *= 2
    return x / np.sqrt(n)


def axis_scores(vectors: np.ndarray, table: int, hash_: int) -> np.ndarray:
    """For each vector its nearness to the signed axes after the pseudo-rotation of a table's hash: coordinates, then their negatives."""
    width = 1 << max(0, vectors.shape[1] - 1).bit_length()
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    x = np.zeros((len(vectors), width))
    x[:, : vectors.shape[1]] = vectors / largest  # no overflow in the lengths
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    signs = np.random.default_rng([SEED, table, hash_, width]).integers(0, 2, (3, width)) * 2 - 1
    for row in signs:
        x = hadamard(x * row)
    return np.concatenate((x, -x), axis=1)


def buckets_of(vectors: np.ndarray, table: int, hashes: int) -> np.ndarray:
    bucket = np.zeros(len(vectors), np.int64)
    for h in range(hashes):
        scores = axis_scores(vectors, table, h)
        bucket = bucket * scores.shape[1] + scores.argmax(axis=1)
    return bucket


def probe_order(vectors: np.ndarray, table: int, hashes: int, probes: int) -> np.ndarray:
    """The first ``probes`` buckets of each vector: by the sum of its nearness to the bucket's axes."""
    total = None
    for h in range(hashes):
        scores = axis_scores(vectors, table, h)
        total = scores if total is None else (total[:, :, None] + scores[:, None, :]).reshape(len(vectors), -1)
    probes = min(probes, total.shape[1])
    best = np.argpartition(-total, probes - 1, axis=1)[:, :probes] if probes < total.shape[1] else np.broadcast_to(np.arange(probes), total.shape)
    return np.take_along_axis(best, np.argsort(-np.take_along_axis(total, best, 1), axis=1, kind="stable"), 1)


def as_matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1 if len(column) else 1)


def distances(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact distances of rows to their query, one pair a row."""
    return np.sqrt(((queries - rows) ** 2).sum(axis=1))


def fitted_probes(rows: np.ndarray, queries: np.ndarray, tables: int, hashes: int, count: int, recall: float) -> int:
    """The least number of probes a table that finds ``recall`` of the queries' true neighbours among the rows; equal rows are no neighbours."""
    squares = (queries**2).sum(1)[:, None] + (rows**2).sum(1)[None] - 2 * queries @ rows.T
    squares[squares < 1e-9 * (queries**2).sum(1)[:, None]] = np.inf
    found = min(count, rows.shape[0])
    near = np.argpartition(squares, found - 1, axis=1)[:, :found]
    real = np.isfinite(np.take_along_axis(squares, near, 1))
    place = np.full(near.shape, np.iinfo(np.int64).max)
    for t in range(tables):
        order = probe_order(queries, t, hashes, 1 << 62)
        ranks = np.empty_like(order)
        np.put_along_axis(ranks, order, np.broadcast_to(np.arange(order.shape[1]), order.shape), 1)
        place = np.minimum(place, np.take_along_axis(ranks, buckets_of(rows, t, hashes)[near], 1))
    places = np.sort(place[real])
    return int(places[int(np.ceil(recall * len(places))) - 1]) + 1 if len(places) else 1


def first_per_query(query: np.ndarray, score: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Places of the first ``count`` of each query, the nearest first, then smaller ids."""
    order = np.lexsort((ids, score, query))
    query, place = query[order], np.arange(len(order))
    begins = np.r_[True, query[1:] != query[:-1]][: len(order)]
    return order[place - np.maximum.accumulate(np.where(begins, place, 0)) < count]


class Plan:
    """Which cells hold a bucket of a table: arrays by bucket, of a size given by the dimensions alone."""

    def __init__(self, sizes: list[np.ndarray], looks: list[np.ndarray]):
        self.first, self.parts, self.blocks, cell = [], [], [], 0
        for rows, queries in zip(sizes, looks):
            first, parts, blocks = (np.ones(len(rows), np.int64) for _ in range(3))
            bucket = 0
            while bucket < len(rows):
                end, held = bucket + 1, rows[bucket]
                while end < len(rows) and held + rows[end] <= CELL_ROWS:
                    held += rows[end]
                    end += 1
                first[bucket:end], parts[bucket:end] = cell, max(1, -(-held // CELL_ROWS))
                blocks[bucket:end] = max(1, -(-queries[bucket:end].sum() // CELL_QUERIES))
                cell += parts[bucket]
                bucket = end
            self.first.append(first)
            self.parts.append(parts)
            self.blocks.append(blocks)


def _counted(df: DataFrame, tables: int, buckets: int) -> list[np.ndarray]:
    """Rows by bucket for each table, from a frame with the column ``buckets``, a list for each table."""
    out = [np.zeros(buckets, np.int64) for _ in range(tables)]
    one = df.select(F.posexplode("buckets").alias("table", "of")).select("table", F.explode("of").alias("bucket"))
    for row in one.groupBy("table", "bucket").count().collect():
        out[row["table"]][row["bucket"]] = row["count"]
    return out


def _hasher(tables: int, hashes: int, probes: int):
    """Adds to rows their bucket, or to queries the buckets they look into, as a list for each table."""

    def add(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                piece = batch.slice(at, 1024)
                x = as_matrix(piece.column("vector"))
                if probes:
                    lists = [list(row) for row in zip(*[probe_order(x, t, hashes, probes).tolist() for t in range(tables)])]
                else:
                    lists = [[[b] for b in row] for row in zip(*[buckets_of(x, t, hashes).tolist() for t in range(tables)])]
                yield piece.append_column("buckets", pa.array(lists, pa.list_(pa.list_(pa.int64()))))

    return add


def _dealer(plan: Plan, is_query: bool):
    """Deals rows and queries to cells: ``cell``, ``block`` and the ``buckets`` in question there."""

    def deal(batches):
        for batch in batches:
            ids = batch.column("vec_id").to_pylist()
            at, cells, blocks, held = [], [], [], []
            for k, (id_, lists) in enumerate(zip(ids, batch.column("buckets").to_pylist())):
                spread = (id_ * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 32
                for t, buckets in enumerate(lists):
                    found: dict[tuple[int, int], list[int]] = {}
                    for bucket in buckets:
                        first, parts, many = int(plan.first[t][bucket]), int(plan.parts[t][bucket]), int(plan.blocks[t][bucket])
                        if is_query:
                            targets = [(first + p, spread % many) for p in range(parts)]
                        else:
                            targets = [(first + spread % parts, b) for b in range(many)]
                        for target in targets:
                            found.setdefault(target, []).append(bucket)
                    for (cell, block), its in found.items():
                        at.append(k)
                        cells.append(cell)
                        blocks.append(block)
                        held.append(its)
            for lo in range(0, len(at), 4096):
                some = slice(lo, lo + 4096)
                taken = batch.select(["vec_id", "vector"]).take(pa.array(at[some], pa.int64()))
                columns = [*taken.columns, pa.array(cells[some], pa.int64()), pa.array(blocks[some], pa.int64()), pa.array(held[some], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "vector", "cell", "block", "buckets"])

    return deal


def _ranker(count: int):
    def rank(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        columns = ("query", "candidate", "score")
        out = [pd.DataFrame({"query": np.empty(0, np.int64), "candidate": np.empty(0, np.int64), "score": np.empty(0)})]
        if not len(queries) or not len(rows):
            return out[0]
        x, y = (np.array(side["vector"].tolist(), dtype=np.float64) for side in (queries, rows))
        names, ids = queries["vec_id"].to_numpy(), rows["vec_id"].to_numpy()
        bucket = np.array([b[0] for b in rows["buckets"]])
        asking = np.repeat(np.arange(len(queries)), [len(b) for b in queries["buckets"]])
        asked = np.concatenate(queries["buckets"].tolist())
        with np.errstate(over="ignore", invalid="ignore"):
            for b in np.unique(bucket):
                own, q = np.nonzero(bucket == b)[0], asking[asked == b]
                squares = (y[own] ** 2).sum(1)
                for lo in range(0, len(q), 256):
                    some = q[lo : lo + 256]
                    near = (x[some] ** 2).sum(1)[:, None] + squares - 2 * x[some] @ y[own].T
                    near = np.where(np.isnan(near), 0, near)
                    last = np.partition(near, min(count, len(own)) - 1, axis=1)[:, min(count, len(own)) - 1]
                    slack = 1e-9 * ((x[some] ** 2).sum(1) + squares.max())
                    i, j = np.nonzero(near <= (last + slack)[:, None])  # rounding decides nothing: what is close is measured exactly
                    i, j = some[i], own[j]
                    score = distances(x[i], y[j])
                    keep = first_per_query(i, score, ids[j], count)
                    out.append(pd.DataFrame(dict(zip(columns, (names[i[keep]], ids[j[keep]], score[keep])))))
        found = pd.concat(out)
        return found.iloc[first_per_query(found["query"].to_numpy(), found["score"].to_numpy(), found["candidate"].to_numpy(), count)]

    return rank


def nearest(
    rows: DataFrame, every: int = 100, count: int = 10, tables: int = TABLES, hashes: int = 0, probes: int = 0, recall: float = RECALL
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the :func:`prepared` rows whose id is divisible by ``every``: the nearest ``count`` other rows found.

    ``hashes`` and ``probes`` of 0 are chosen by the number of rows and by the sample.
    """
    ids = stored(rows.groupBy("vec_id").agg(F.min("name").alias("name")), "vector-names")
    n = ids.count()
    rank = F.row_number().over(Window.partitionBy("name").orderBy("vec_id"))
    shared = ids.select("name", "vec_id", rank.alias("place")).filter(F.col("place") <= count + 1)
    shared = shared.groupBy("name").agg(F.array_sort(F.collect_list("vec_id")).alias("members"))
    asked = ids.groupBy("name").agg(F.bool_or(F.col("vec_id") % every == 0).alias("is_query"))
    repeated = rows.groupBy("name").count().filter("count > 1").select("name")
    doubtful = rows.select("vec_id", "name").groupBy("vec_id").agg(F.min("name").alias("least"), F.max("name").alias("name"))
    odd = rows.select("vec_id", "name").join(doubtful.filter("least <> name").select("vec_id"), "vec_id", "left_semi").select("name")
    # Names that stand in several rows, or beside another name of their id: their rows are gathered, all others stay where they are.
    several = stored(repeated.unionByName(odd).distinct(), "repeated-vectors")
    n_several = several.count()
    small = F.broadcast if n_several <= BROADCAST_ROWS else lambda df: df
    gathered = rows.join(small(several), "name", "left_semi").groupBy("name").agg(F.first("vector").alias("vector"))
    members = stored(shared.join(asked, "name").join(several, "name", "left_semi"), "vector-members")
    gathered = gathered.join(members, "name").select(F.element_at("members", 1).alias("vec_id"), "vector", "is_query")
    single = rows.join(small(several), "name", "left_anti").select("vec_id", "vector", (F.col("vec_id") % every == 0).alias("is_query"))
    points = single.unionByName(gathered)

    width = rows.select(F.size("vector").alias("n")).first()
    width = width["n"] if width else 1
    axes = 2 << max(0, width - 1).bit_length()
    hashes = hashes or (1 if n < SECOND_HASH_ROWS else 2)
    if not probes:
        probes = axes**hashes if n < CELL_ROWS else _sampled_probes(points, n, tables, hashes, count, recall)
    kind = points.schema["vector"].dataType.simpleString()
    hashed = f"vec_id long, vector {kind}, is_query boolean, buckets array<array<long>>"
    entries = points.mapInArrow(_hasher(tables, hashes, 0), hashed)
    lookups = stored(points.filter("is_query").mapInArrow(_hasher(tables, hashes, probes), hashed), "vector-queries")
    plan = Plan(_counted(entries, tables, axes**hashes), _counted(lookups, tables, axes**hashes))

    dealt = f"vec_id long, vector {kind}, cell long, block long, buckets array<long>"
    cells = entries.mapInArrow(_dealer(plan, False), dealt).groupBy("cell", "block")
    looks = lookups.mapInArrow(_dealer(plan, True), dealt).groupBy("cell", "block")
    found = looks.cogroup(cells).applyInPandas(_ranker(count + 1), "query long, candidate long, score double")
    found = found.repartition("query").dropDuplicates(["query", "candidate"])  # a row may be a candidate of several tables
    place = F.row_number().over(Window.partitionBy("query").orderBy("score", "candidate"))
    found = found.withColumn("place", place).filter(F.col("place") <= count + 1).drop("place")

    class_of = members.select(F.element_at("members", 1).alias("candidate"), "members")
    each = found.join(small(class_of), "candidate", "left")
    each = each.select("query", "score", F.explode(F.coalesce("members", F.array("candidate"))).alias("vec_id"))
    answers = each.groupBy("query").agg(F.slice(F.array_sort(F.collect_list(F.struct("score", "vec_id"))), 1, count + 1).alias("answers"))
    slot = F.pmod(F.xxhash64("vec_id"), F.lit(SLOTS)).alias("slot")
    queries = ids.filter(F.col("vec_id") % every == 0).join(small(members.select("name", "members")), "name", "left")
    queries = queries.select(F.col("vec_id").alias("query_id"), F.coalesce(F.element_at("members", 1), "vec_id").alias("query"), slot)
    # Many queries may share one vector: their answers are repeated for the slots that occur.
    answers = answers.join(queries.select("query", "slot").distinct(), "query")
    each = queries.join(answers, ["query", "slot"]).select("query_id", F.filter("answers", lambda a: a["vec_id"] != F.col("query_id")).alias("answers"))
    each = each.select("query_id", F.posexplode(F.slice("answers", 1, count)).alias("rank", "a"))
    return each.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("a.vec_id").alias("vec_id"), F.col("a.score").alias("score"))


def _sampled_probes(points: DataFrame, n: int, tables: int, hashes: int, count: int, recall: float) -> int:
    drawn = points.select("vector", F.xxhash64(F.lit("sample"), "vec_id").alias("place"))
    if n > SAMPLE_ROWS:
        drawn = drawn.filter(F.pmod("place", F.lit(1 << 30)) < int((1 << 30) * 1.1 * SAMPLE_ROWS / n))
    table = drawn.orderBy("place").limit(SAMPLE_ROWS).select("vector").toArrow()
    if not table.num_rows:
        return 1
    x = as_matrix(table.column("vector").combine_chunks())
    return fitted_probes(x, x[:SAMPLE_QUERIES], tables, hashes, count, recall)
