"""Packing of documents into sequences by non-negative least squares over the histogram of lengths.

A document's ids (an end id appended) are cut into pieces of the window's length and one shorter rest. Lengths are rounded up to
bins of ``window / 256`` for planning. Every combination of up to ``DEPTH`` bins that fills the window exactly is a column;
non-negative least squares finds how often to use each so that the histogram is used up. The counts are rounded and kept within the
supply, and the bins left over are packed greedily, largest first, each combination as often as the supply allows. The plan's
size depends on the number of bins only, so the driver holds a few thousand numbers at any input size.

Pieces then find their place without moving their ids: a piece's rank in its bin is its rank in its (bin, task) group plus the
sizes of the groups before it, and the plan maps ranges of ranks to sequences. A hot length is many such groups.

Defined results: a null or empty text is one piece with the end id alone. Repeated rows are packed each for itself. Columns other
than doc_id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .tokens import encoder

BINS = 256
DEPTH = 3


@dataclass(frozen=True)
class Packed:
    """``pieces``: piece, doc_id, start, length, doc_tokens, ids (little-endian 32-bit); ``places``: piece, sequence_id, offset."""

    pieces: DataFrame
    places: DataFrame

    def sequences(self) -> DataFrame:
        """``sequence_id`` and the ``ids`` of its pieces one after the other (binary)."""
        each = self.pieces.join(self.places, "piece").groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
        return each.select("sequence_id", F.expr("aggregate(parts, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids"))


def cut_pieces(docs: DataFrame, tokenizer: str, window: int, end_id: int) -> DataFrame:
    """The pieces of all documents with their ids."""

    def cut(batches):
        encode = encoder(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows = []
                for doc_id, ids in zip(part.column(0).to_pylist(), encode.encode([x or "" for x in part.column(1).to_pylist()])):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    rows += [(doc_id, s, min(window, len(ids) - s), len(ids), ids[s : s + window].tobytes()) for s in range(0, len(ids), window)]
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "doc_tokens", "ids"])

    schema = "doc_id long, start long, length long, doc_tokens long, ids binary"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


def pack(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1) -> Packed:
    """All documents packed into sequences of at most ``window`` ids."""
    pieces = cut_pieces(docs, tokenizer, window, end_id)
    pieces = stored(pieces.select(F.monotonically_increasing_id().alias("piece"), "*"), "pieces")
    step = -(-window // BINS)
    # What does not fit beside the smallest piece stands in the last bin, alone in its sequence.
    bin_ = F.least(F.ceil(F.col("length") / step).cast("int"), F.lit(window // step))
    binned = pieces.select("piece", "length", bin_.alias("bin"), F.shiftright("piece", 33).cast("int").alias("task"))

    groups = binned.groupBy("bin", "task").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("bin").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = stored(groups.withColumn("base", before), "groups")
    counts = np.zeros(window // step + 1, np.int64)
    for row in groups.groupBy("bin").agg(F.sum("n").alias("n")).collect():  # one row per bin
        counts[row.bin] = row.n

    # At most a few entries per bin: the plan has a proven size and is broadcast.
    schema = "bin int, low long, high long, times int, first_sequence long"
    plan = F.broadcast(docs.sparkSession.createDataFrame(plan_ranges(counts), schema))
    rank = F.row_number().over(Window.partitionBy("bin", "task").orderBy("piece")) - 1
    ranked = binned.withColumn("rank", rank).join(groups.drop("n"), ["bin", "task"]).withColumn("rank", F.col("rank") + F.col("base"))
    ranked = ranked.join(plan, (ranked["bin"] == plan["bin"]) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    sequence = F.col("first_sequence") + F.expr("(rank - low) div times")
    placed = ranked.select("piece", "length", sequence.alias("sequence_id"))
    in_order = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "piece")
    offset = F.coalesce(F.sum("length").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return Packed(pieces, placed.select("piece", "sequence_id", offset.alias("offset")))


def plan_ranges(counts: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(bin, from rank, to rank, uses per sequence, first sequence) of the whole plan; every rank of every bin is in one range."""
    used, sequence, out = np.zeros(len(counts), np.int64), 0, []
    for combination, repeats in plan_sequences(counts):
        for b, times in combination.items():
            out.append((int(b), int(used[b]), int(used[b] + times * repeats), int(times), int(sequence)))
            used[b] += times * repeats
        sequence += repeats
    return out


def plan_sequences(counts: np.ndarray) -> list[tuple[dict[int, int], int]]:
    """Combinations of bins with their repeats, which use up ``counts`` (by bin; the last bin is the whole window)."""
    left, full, out = counts.copy(), len(counts) - 1, []
    combinations = exact_combinations(full, DEPTH)
    amounts = nonnegative_least_squares(combinations, counts.astype(float))
    for k in np.argsort(-amounts, kind="stable"):
        if amounts[k] <= 0:
            break
        combination = tally(combinations[k])
        repeats = min(int(round(amounts[k])), *(left[b] // t for b, t in combination.items()))
        if repeats > 0:
            out.append((combination, int(repeats)))
            for b, t in combination.items():
                left[b] -= t * repeats
    while left.any():
        free, combination = full, {}
        for b in range(full, 0, -1):
            times = min(left[b], free // b)
            if times:
                combination[b] = int(times)
                free -= times * b
        repeats = min(int(left[b] // t) for b, t in combination.items())
        out.append((combination, repeats))
        for b, t in combination.items():
            left[b] -= t * repeats
    return out


def tally(bins: np.ndarray) -> dict[int, int]:
    return {int(b): int(n) for b, n in zip(*np.unique(bins[bins > 0], return_counts=True))}


def exact_combinations(full: int, depth: int) -> np.ndarray:
    """All multisets of at most ``depth`` bins that sum to ``full``, one per row, filled up with zeros."""
    out = []

    def grow(chosen: list[int], free: int, most: int) -> None:
        if free == 0:
            out.append(chosen + [0] * (depth - len(chosen)))
        elif len(chosen) < depth:
            for b in range(min(most, free), 0, -1):
                if b * (depth - len(chosen)) < free:
                    break
                grow([*chosen, b], free - b, b)

    grow([], full, full)
    return np.array(out)


def nonnegative_least_squares(combinations: np.ndarray, target: np.ndarray, tolerance: float = 1e-7) -> np.ndarray:
    """Repeats x >= 0 of the combinations with least squared difference to ``target``, by an active set (Lawson and Hanson)."""
    scale = max(1.0, target.max())
    wanted = target[1:] / scale
    matrix = np.zeros((len(wanted), len(combinations)))
    for slot in combinations.T:
        np.add.at(matrix, (np.maximum(slot, 1) - 1, np.arange(len(combinations))), (slot > 0).astype(float))
    x, active = np.zeros(len(combinations)), np.zeros(len(combinations), bool)
    for _ in range(3 * len(wanted)):
        gain = matrix.T @ (wanted - matrix @ x)
        gain[active] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= tolerance:
            break
        active[best] = True
        while True:
            where = np.flatnonzero(active)
            solved = np.linalg.lstsq(matrix[:, where], wanted, rcond=None)[0]
            if (solved > 0).all():
                x[where] = solved
                break
            negative = solved <= 0
            ratio = x[where][negative] / np.maximum(x[where][negative] - solved[negative], 1e-300)
            x[where] += ratio.min() * (solved - x[where])
            x[where[negative][ratio <= ratio.min()]] = 0
            active &= x > 0
    return x * scale
