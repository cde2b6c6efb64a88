"""Hard negatives: for an anchor and each of its nearest rows of the same label, the best rows of another label in a band below it.

Scores are integer inner products of quantised vectors. Every vector is cut into 1, 2, 4, ... segments of equal length, and each segment
stores its mean and deviation: two segments of length m have a product of m times the means' product, plus or minus m times the
deviations' product. The sum over the segments bounds the score, and a level of finer segments is only taken for the pairs that
the level before could not decide; what is left is scored exactly.

Anchors are a stated share of the rows and meet all rows in blocks of bounded size: a task holds one block of rows and one of anchors, whatever
is hot. A first pass over a share of the rows, drawn by hash, gives every anchor a bound that its answer reaches at least, so that a block hands on
few rows and decides most pairs by their bounds; the bound only saves work, for a row that beats it is never dropped.

Defined results: rows with a null id, label or vector, an empty vector, a null or non-finite component, or another length than the most
frequent one take no part. An id names one row: of several, that with the least label and vector counts. Components beyond 2^20 after quantisation are
an error (products are summed in floating-point numbers, exactly up to 2^53). Ties go to the smaller id. Without rows the result is empty. Other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

BLOCK_ROWS, BLOCK_ANCHORS = 16_384, 4_096
PILOT = 32  # the first pass takes one row in so many
FIRST = 5
UNKNOWN = -(1 << 62)
LARGEST = 1 << 20
DENSE = 16  # a level is one matrix product while more than one pair in so many is open


def usable(rows: DataFrame, vector: str) -> Column:
    """Whether a vector is complete and finite."""
    values = F.col(vector)
    return values.isNotNull() & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def quantised(vector: str, factor: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("long"))


def one_per_id(rows: DataFrame, *values: str) -> DataFrame:
    """The row with the least values for each ``vec_id``; the copies of an id meet in the map tasks first."""
    return rows.groupBy("vec_id").agg(F.min(F.struct(*values)).alias("least")).select("vec_id", "least.*")


def prepared(rows: DataFrame, factor: int = 256) -> DataFrame:
    """``vec_id, label, vector`` of the rows that take part; ``vector`` holds integers."""
    rows = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding").filter("vec_id IS NOT NULL AND label IS NOT NULL")
    rows = rows.filter(usable(rows, "embedding")).select("vec_id", "label", quantised("embedding", factor).alias("vector"))
    length = rows.agg(F.mode(F.size("vector"), deterministic=True)).scalar()
    return one_per_id(rows.filter((F.size("vector") == length) & (F.size("vector") > 0)), "label", "vector")


def summaries(x: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each level the segments' length, and their means and deviations as arrays of (rows, segments), down to segments of two."""
    levels, parts, width = [], 1, x.shape[1]
    while width % parts == 0 and (parts == 1 or width // parts > 1):
        cut = x.reshape(len(x), parts, width // parts)
        levels.append((width // parts, cut.mean(2), cut.std(2)))
        parts *= 2
    return levels


class Block:
    """Vectors with the summaries of their segments."""

    def __init__(self, vectors: pd.Series):
        self.values = np.array(vectors.tolist(), dtype=np.float64).reshape(len(vectors), -1)
        if np.abs(self.values).max(initial=0) > LARGEST:
            raise ValueError("components beyond 2^20 after quantisation")
        self.levels = summaries(self.values)

    def part(self, lo: int, hi: int) -> Block:
        out = object.__new__(Block)
        out.values, out.levels = self.values[lo:hi], [(n, m[lo:hi], d[lo:hi]) for n, m, d in self.levels]
        return out


def products(a: np.ndarray, b: np.ndarray, at: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Inner products of the given pairs of rows."""
    if len(at) * DENSE > len(a) * len(b):
        return (a @ b.T)[at, of]
    step = 1 << 17
    parts = [np.einsum("ij,ij->i", a[at[lo : lo + step]], b[of[lo : lo + step]]) for lo in range(0, len(at), step)]
    return np.concatenate(parts) if parts else np.empty(0)


def scores_within(a: Block, b: Block, low: np.ndarray, high: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``wanted`` pairs that score from ``low`` to ``high`` of their row of ``a``: both places, and the exact scores."""
    slack = 1 + 1e-12 * a.values.shape[1] * np.abs(a.values).max(initial=1) * np.abs(b.values).max(initial=1)  # rounding decides nothing
    at, of = np.nonzero(wanted)
    for (size, a_means, a_spreads), (_, b_means, b_spreads) in zip(a.levels, b.levels):
        middle, reach = size * products(a_means, b_means, at, of), size * products(a_spreads, b_spreads, at, of) + slack
        open_ = (middle + reach >= low[at]) & (middle - reach <= high[at])
        at, of = at[open_], of[open_]
    score = products(a.values, b.values, at, of).astype(np.int64)
    inside = (score >= low[at]) & (score <= high[at])
    return at[inside], of[inside], score[inside]


def first_of(groups: np.ndarray, score: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Places of the first ``count`` of each group, higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score, groups))
    groups = groups[order]
    place = np.arange(len(order))
    begins = np.r_[True, groups[1:] != groups[:-1]][: len(order)]
    return order[place - np.maximum.accumulate(np.where(begins, place, 0)) < count]


def _in_grid(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, find, schema: str) -> DataFrame:
    """``find(part of the anchors, its Block, rows, their Block)`` for each block of anchors beside each block of rows."""
    r, a = max(1, -(-n_rows // BLOCK_ROWS)), max(1, -(-n_anchors // BLOCK_ANCHORS))
    row_block, anchor_block = (F.pmod(F.xxhash64(c), F.lit(k)).cast("int") for c, k in (("vec_id", r), ("anchor", a)))
    rows = rows.select("*", row_block.alias("row_block"), F.explode(F.sequence(F.lit(0), F.lit(a - 1))).alias("anchor_block"))
    anchors = anchors.select("*", anchor_block.alias("anchor_block"), F.explode(F.sequence(F.lit(0), F.lit(r - 1))).alias("row_block"))
    names = [field.split()[0] for field in schema.split(", ")]

    def cell(some: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({c: np.empty(0, np.int64) for c in names})]
        if len(some) and len(rows):
            x, y = Block(some["vector"]), Block(rows["vector"])
            for lo in range(0, len(some), 128):
                out += [pd.DataFrame(dict(zip(names, c))) for c in find(some.iloc[lo : lo + 128], x.part(lo, lo + 128), rows, y)]
        return pd.concat(out)

    keys = ["row_block", "anchor_block"]
    return anchors.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(cell, schema)


def _positives(count: int):
    def find(some, x, rows, y):
        ids, labels = some["anchor"].to_numpy(), some["label"].to_numpy()
        wanted = (labels[:, None] == rows["label"].to_numpy()) & (ids[:, None] != rows["vec_id"].to_numpy())
        at, of, score = scores_within(x, y, some["low"].to_numpy(), np.full(len(some), -UNKNOWN), wanted)
        partner = rows["vec_id"].to_numpy()[of]
        keep = first_of(at, score, partner, count)
        yield ids[at[keep]], partner[keep], score[keep]

    return find


def _negatives(count: int, high_percent: int):
    def find(some, x, rows, y):
        ids, labels = some["anchor"].to_numpy(), some["label"].to_numpy()
        wanted = labels[:, None] != rows["label"].to_numpy()
        places, scores, lows = some["places"].tolist(), some["scores"].tolist(), some["lows"].tolist()
        bottom, top = np.array([min(v) for v in lows]), np.array([max(v) * high_percent // 100 for v in scores])
        at, of, score = scores_within(x, y, bottom, top, wanted)
        partner, edges = rows["vec_id"].to_numpy()[of], np.searchsorted(at, np.arange(len(some) + 1))
        for k in range(len(some)):
            mine = slice(edges[k], edges[k + 1])
            for place, positive, low in zip(places[k], scores[k], lows[k]):
                inside = np.nonzero((score[mine] >= low) & (100 * score[mine] <= high_percent * positive))[0]
                inside = inside[np.lexsort((partner[mine][inside], -score[mine][inside]))[:count]]
                yield np.full(len(inside), ids[k]), np.full(len(inside), place), partner[mine][inside], score[mine][inside]

    return find


def _first(found: DataFrame, groups: list[str], count: int) -> DataFrame:
    """The first ``count`` of each group, ranked; a block of rows hands on no more than that of a group."""
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy(F.desc("score"), "partner")).alias("rank")
    return found.select("*", rank).filter(F.col("rank") <= count)


def hard_negatives(
    rows: DataFrame, every: int = 100, positives: int = FIRST, negatives: int = FIRST, low_percent: int = 80, high_percent: int = 100, pilot: int = PILOT
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of the anchors, the :func:`prepared` rows whose id is
    divisible by ``every``: for each of an anchor's first ``positives`` rows of its label, the first ``negatives`` rows of other labels that
    score from ``low_percent`` to ``high_percent`` of it."""
    rows = stored(rows, "quantised")
    anchors = rows.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("anchor"), *[F.col(c).alias(c) for c in ("label", "vector")])
    n, n_anchors = rows.agg(F.count("*"), F.count_if(F.col("vec_id") % every == 0)).first()
    drawn, n_drawn = rows.filter(F.pmod(F.xxhash64(F.lit("pilot"), "vec_id"), F.lit(pilot)) == 0), n // pilot

    schema, find = "anchor long, partner long, score long", _positives(positives)
    found = _in_grid(drawn, anchors.withColumn("low", F.lit(UNKNOWN)), n_drawn, n_anchors, find, schema)
    lows = _first(found, ["anchor"], positives).filter(F.col("rank") == positives).select("anchor", F.col("score").alias("low"))
    sides = anchors.join(lows, "anchor", "left").withColumn("low", F.coalesce("low", F.lit(UNKNOWN)))
    chosen = stored(_first(_in_grid(rows, sides, n, n_anchors, find, schema), ["anchor"], positives), "positives")

    # The places 1, 2, ... of an anchor's positives, their scores, and for each the least score that can count.
    percents = F.col("score") * low_percent
    least = F.when(percents > 0, (percents + 99) / 100).otherwise(percents / 100).cast("long").alias("low")  # rounded up; casts cut off
    bands = chosen.select("anchor", F.col("rank").alias("place"), "score", least)
    schema, find = "anchor long, place int, partner long, score long", _negatives(negatives, high_percent)

    def beside(bands: DataFrame) -> DataFrame:
        ordered = F.array_sort(F.collect_list(F.struct("place", "score", "low"))).alias("bands")
        arrays = bands.groupBy("anchor").agg(ordered).select("anchor", *[F.col(f"bands.{c}").alias(f"{c}s") for c in ("place", "score", "low")])
        return anchors.join(arrays, "anchor")

    found = _in_grid(drawn, beside(bands), n_drawn, n_anchors, find, schema)
    lows = _first(found, ["anchor", "place"], negatives).filter(F.col("rank") == negatives).select("anchor", "place", F.col("score").alias("reached"))
    bands = bands.join(lows, ["anchor", "place"], "left").withColumn("low", F.greatest("low", "reached")).drop("reached")
    found = _first(_in_grid(rows, beside(bands), n, n_anchors, find, schema), ["anchor", "place"], negatives)
    pairs = chosen.select("anchor", F.col("rank").alias("place"), F.col("partner").alias("positive_id"), F.col("score").alias("positive_score"))
    found = found.withColumnsRenamed({"partner": "negative_id", "score": "negative_score"}).join(pairs, ["anchor", "place"])
    return found.select(F.col("anchor").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score")
