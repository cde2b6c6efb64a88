"""Quality rules: base rules, and a log-likelihood ratio of hashed n-grams with a fitted threshold.

Tokens are runs of letters, digits and non-ASCII characters, and runs of other visible characters. Single tokens and
pairs of neighbours are hashed to two times 262,144 buckets. Two multinomials are counted over whole tables: all
documents (raw) and the documents labelled good and not toxic (trusted). A document's score is the mean over its
n-grams of ``log((trusted + m) / (expected + m))``, where ``expected`` is the trusted count the bucket would have if
trusted text were like raw text and ``m`` is a prior that keeps rare buckets near zero. Documents are dealt to two folds by doc_id,
and each is scored with the counts of the other fold: its own words would else speak for it, if it is
trusted, or against it.

A mean hides a few abusive words in a long text, so ``worst`` is the mean of the two lowest weights among the distinct
n-grams of a document. Its weights come from the same multinomials with each n-gram counted once per document (and segment, below),
which keeps one document's litany from speaking for the corpus, and are the greater of the ratio of trusted to raw and that of
trusted to labelled rejected text: many copies of an unlabelled document say nothing against its words. Weights above
``FAINT`` count as zero. Each score has the threshold that best separates the labelled documents; both are applied to every
document, and nothing is drawn at random.

Defined results: a null text has no words and fails; without trusted or without rejected labels the thresholds are minus
infinity, so that only the base rules decide; labels with null fields are not used, and of several labels of a document
the worst counts. A text of more than a million bytes is counted in segments cut at white space, and no n-gram spans a
cut. An input column named ``quality`` is replaced in the result; other columns pass through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SideTable, mixed, stored, word_ids
from .tokens import forget

BITS = 18
BUCKETS = 2 << BITS
FOLDS = 2
SEGMENT = 1_000_000
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
BASE = np.uint64(0x9E3779B97F4A7C15)
PAIR = np.uint64(0xD6E8FEB86659FD93)
BLOCK = 4096  # buckets in a row of counts
COUNTS = ("raw", "good", "raw_docs", "good_docs", "bad_docs")
SCORE_STEP = 0.0005
WORST_STEP = 0.002
SCORE_LIMIT = 4000  # bins on each side of zero
FAINT = -0.25

_KIND = np.full(256, 1, np.uint8)
_KIND[:128] = [1 if chr(c).isalnum() or c == 95 else 2 for c in range(128)]
_KIND[[*SPACES, *range(9), *range(14, 32), 127]] = 0

FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, worst double, kept boolean"


@dataclass(frozen=True)
class QualityModel:
    """Weights by fold and bucket, and the least scores of a kept document."""

    weights: np.ndarray = field(repr=False)
    worst_weights: np.ndarray = field(repr=False)
    threshold: float = -np.inf
    worst_threshold: float = -np.inf


def base_metrics(data: bytes) -> tuple[int, int, int, int, int]:
    """Words, characters in words, symbols, repeated lines, and words in repeated three-word windows."""
    words = data.split()
    inside = np.frombuffer(b"".join(words), np.uint8)
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [x for x in data.split(b"\n") if x.strip()]
    return len(words), int(np.count_nonzero((inside & 0xC0) != 0x80)), symbols, len(lines) - len(set(lines)), repeated_words(words)


def repeated_words(words: list) -> int:
    if len(words) < 4:
        return 0
    ids, seen = word_ids(words)
    # Number the pairs first where three numbers do not fit into one.
    if len(seen) < 1 << 21:
        key = (ids[:-2] * len(seen) + ids[1:-1]) * len(seen) + ids[2:]
    else:
        key = np.unique(ids[:-2] * len(seen) + ids[1:-1], return_inverse=True)[1] * len(seen) + ids[2:]
    _, where, count = np.unique(key, return_inverse=True, return_counts=True)
    again = count[where] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : len(words) - 2 + k] |= again
    return int(covered.sum())


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


class NGrams:
    """Bucket numbers of all n-grams of many texts at once."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def powers(self, n: int) -> None:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
            ones = np.ones(size, np.uint64)
            self.up, self.down = (np.multiply.accumulate(np.where(np.arange(size) > 0, x, ones)) for x in (BASE, inverse))

    def buckets(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(bucket, number of its text) of parts of ``texts``; a text may appear in several parts."""
        part, owner, size = [], [], 0
        for i, text in enumerate(texts):
            for piece in segments(text):
                if size and size + len(piece) > SEGMENT:
                    yield self._buckets(part, owner)
                    part, owner, size = [], [], 0
                part.append(piece)
                owner.append(i)
                size += len(piece) + 1
        if part:
            yield self._buckets(part, owner)

    def _buckets(self, part: list[bytes], owner: list[int]) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(b"\n".join(part) + b"\n", np.uint8)
        self.powers(len(data) + 1)
        kind = _KIND[data]
        before = np.concatenate([np.zeros(1, np.uint8), kind[:-1]])
        edge = kind != before
        start = np.flatnonzero(edge & (kind > 0))
        stop = np.flatnonzero(edge & (before > 0))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)])])
        h = mixed((sums[stop] - sums[start]) * self.down[start])
        ends = np.cumsum([len(x) + 1 for x in part])
        piece = np.searchsorted(ends, start, side="right")
        same = piece[1:] == piece[:-1]
        pairs = mixed(h[:-1] * PAIR + h[1:])[same]
        shift = np.uint64(64 - BITS)
        number = np.asarray(owner)[piece]
        return (
            np.concatenate([(h >> shift).astype(np.int64), (pairs >> shift).astype(np.int64) + (1 << BITS)]),
            np.concatenate([number, number[1:][same]]),
        )


def segments(text: bytes) -> Iterator[bytes]:
    start = 0
    while len(text) - start > SEGMENT:
        cut = min((p for p in (text.find(bytes([c]), start + SEGMENT) for c in SPACES) if p >= 0), default=len(text))
        yield text[start:cut]
        start = cut
    yield text[start:] if start else text


def as_bytes(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def fold() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int")


def counted(parts: DataFrame, labelled: SideTable, tasks: int = 32) -> np.ndarray:
    """Sums over all rows of ``part``, ``doc_id``, ``text`` and ``fold``: an array by ``COUNTS``, fold and bucket.

    Each task sends its own sums as packed blocks of buckets; the blocks of a number meet in one task, which adds them
    as they come. The driver gets the sums, whose number is fixed.
    """
    size = FOLDS * BUCKETS

    def count(batches):
        forget()
        grams, sums = NGrams(), np.zeros((len(COUNTS), size), np.int64)
        known: dict[int, dict] = {}
        for batch in batches:
            ids = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            for part in {p for p, _ in ids} - known.keys():
                rows = labelled.rows(part)
                known[part] = dict(zip(rows["doc_id"].to_pylist(), rows["trusted"].to_pylist())) if rows else {}
            marks = [known[p].get(d) for p, d in ids]
            good, bad = np.array([m is True for m in marks]), np.array([m is False for m in marks])
            base = np.array(batch.column(3).to_pylist(), np.int64) * BUCKETS
            for bucket, row in grams.buckets(as_bytes(batch.column(2))):
                bucket += base[row]
                sums[0] += np.bincount(bucket, minlength=size)
                sums[1] += np.bincount(bucket[good[row]], minlength=size)
                row, bucket = np.divmod(np.unique(row * size + bucket), size)
                for k, chosen in ((2, slice(None)), (3, good[row]), (4, bad[row])):
                    sums[k] += np.bincount(bucket[chosen], minlength=size)
        for k in range(size // BLOCK):
            block = sums[:, k * BLOCK : (k + 1) * BLOCK]
            if block.any():
                yield pa.RecordBatch.from_pylist([{"block": k, "sums": zlib.compress(block.tobytes(), 1)}], schema)

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[k] = sums.get(k, 0) + np.frombuffer(zlib.decompress(packed), np.int64)
        for k, total in sums.items():
            yield pa.RecordBatch.from_pylist([{"block": k, "sums": zlib.compress(total.tobytes(), 1)}], schema)

    schema = pa.schema([("block", pa.int32()), ("sums", pa.binary())])
    each = parts.select("part", "doc_id", "text", "fold").mapInArrow(count, "block int, sums binary")
    total = np.zeros((len(COUNTS), size))
    for k, packed in each.repartition(tasks, "block").mapInArrow(add, "block int, sums binary").collect():
        total[:, k * BLOCK : (k + 1) * BLOCK] = np.frombuffer(zlib.decompress(packed), np.int64).reshape(len(COUNTS), BLOCK)
    return total.reshape(len(COUNTS), FOLDS, BUCKETS)


def weights_of(raw: np.ndarray, good: np.ndarray, prior: float) -> np.ndarray:
    """Weights by fold and bucket, each fold's from the counts of the others."""
    return np.stack([log_ratio(raw.sum(axis=0) - raw[k], good.sum(axis=0) - good[k], prior) for k in range(FOLDS)]).astype(np.float32)


def log_ratio(raw: np.ndarray, good: np.ndarray, prior: float) -> np.ndarray:
    if not raw.sum() or not good.sum():
        return np.zeros(len(raw))
    expected = np.zeros(len(raw))
    for half in (slice(0, 1 << BITS), slice(1 << BITS, None)):
        expected[half] = raw[half] * (good[half].sum() / max(1, raw[half].sum()))
    return np.log((good + prior) / (expected + prior))


def best_threshold(bad: np.ndarray, clean: np.ndarray, clean_cost: float, step: float) -> float:
    """Lowest score of a kept document, from the labelled counts by bin; ``clean_cost`` weighs lost clean documents."""
    if not bad.sum() or not clean.sum():
        return -np.inf
    gain = np.concatenate([[0.0], np.cumsum(bad) / bad.sum() - clean_cost * np.cumsum(clean) / clean.sum()])
    cut = int(np.argmax(gain))
    return (cut - SCORE_LIMIT) * step if cut else -np.inf


def judged(labels: DataFrame) -> DataFrame:
    """One row per labelled document: whether it is trusted."""
    known = labels.filter("doc_id is not null and quality is not null and toxic is not null")
    return known.groupBy("doc_id").agg((F.min((F.col("quality") == 1).cast("int") - F.col("toxic")) == 1).alias("trusted"))


def fit_quality(docs: DataFrame, labels: DataFrame, prior: float = 20.0, worst_prior: float = 5.0, clean_cost: float = 10.0) -> QualityModel:
    """Count the multinomials over all documents, then fit the thresholds on all labelled documents.

    The driver gets sums by bucket and by bin of the scores, whose number is fixed, never rows of documents.
    """
    marks = judged(labels)
    parts = stored(docs.select(F.spark_partition_id().alias("part"), "doc_id", "text", fold().alias("fold")), "parts")
    # The labelled doc_ids go to the parts that hold them; texts are not shuffled, however many labels there are.
    labelled = SideTable(parts.select("part", "doc_id").join(marks, "doc_id"), "labelled")
    raw, good, raw_docs, good_docs, bad_docs = counted(parts, labelled)
    weights = weights_of(raw, good, prior)
    worst = np.maximum(weights_of(raw_docs, good_docs, worst_prior), weights_of(bad_docs, good_docs, worst_prior))
    worst = np.where(worst > FAINT, np.float32(0), worst)
    if not good.sum():
        return QualityModel(weights, worst)

    def score(batches):
        forget()
        grams = NGrams()
        for batch in batches:
            scores = scored(grams, as_bytes(batch.column(1)), batch.column(2), weights, worst)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, scores)], ["doc_id", "score", "worst"])

    def bins(name: str, step: float) -> Column:
        return F.least(F.greatest(F.floor(F.col(name) / step), F.lit(-SCORE_LIMIT)), F.lit(SCORE_LIMIT - 1)) + SCORE_LIMIT

    fields = [parts.schema["doc_id"], T.StructField("score", T.DoubleType()), T.StructField("worst", T.DoubleType())]
    scores = parts.select("doc_id", "text", "fold").mapInArrow(score, T.StructType(fields)).join(marks, "doc_id")
    both = F.array(*[F.struct(F.lit(k).alias("kind"), bins(n, x).alias("bin")) for k, (n, x) in enumerate((("score", SCORE_STEP), ("worst", WORST_STEP)))])
    found = scores.select("trusted", F.inline(both)).groupBy("kind", "bin", "trusted").count().toPandas()
    by_kind = np.zeros((2, 2, 2 * SCORE_LIMIT), np.int64)
    by_kind[found.kind.astype(int), found.trusted.astype(int), found.bin.astype(int)] = found["count"]
    cuts = [best_threshold(bad, clean, clean_cost, step) for (bad, clean), step in zip(by_kind, (SCORE_STEP, WORST_STEP))]
    return QualityModel(weights, worst, *cuts)


def scored(grams: NGrams, texts: list[bytes], folds: pa.Array, weights: np.ndarray, worst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text, the mean weight of its n-grams, and the mean of the two lowest worst weights of distinct ones."""
    total, number, own = np.zeros(len(texts)), np.zeros(len(texts)), np.array(folds.to_pylist(), np.int64)
    low: list[np.ndarray] = []
    for bucket, row in grams.buckets(texts):
        total += np.bincount(row, weights[own[row], bucket], minlength=len(texts))
        number += np.bincount(row, minlength=len(texts))
        found = worst[own[row], bucket] < 0
        low.append(np.unique(row[found] * BUCKETS + bucket[found]))
    row, bucket = np.divmod(np.unique(np.concatenate(low)) if low else np.zeros(0, np.int64), BUCKETS)
    weight = worst[own[row], bucket]
    order = np.lexsort((weight, row))
    row, weight = row[order], weight[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    lowest = np.bincount(row[rank < 2], weight[rank < 2], minlength=len(texts)) / 2
    return total / np.maximum(number, 1), lowest


def rate_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``docs`` with a struct ``quality``: the base metrics, the score and the verdict ``kept``."""
    docs = docs.select(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns if c.lower() not in ("quality", "_fold")])
    at = [c.lower() for c in docs.columns].index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField("quality", T._parse_datatype_string(FIELDS))])
    names = [x.split()[0] for x in FIELDS.split(", ")]

    def rate(batches):
        forget()
        grams = NGrams()
        for batch in batches:
            texts = as_bytes(batch.column(at))
            metrics = [base_metrics(x) for x in texts]
            score, worst = scored(grams, texts, batch.column(batch.num_columns - 1), model.weights, model.worst_weights)
            failed = [base_failed(m[0], m[4]) for m in metrics]
            kept = ~np.array(failed, bool) & (score >= model.threshold) & (worst >= model.worst_threshold)
            columns = [pa.array([m[i] for m in metrics], pa.int64()) for i in range(5)]
            columns += [pa.array(failed, pa.bool_()), pa.array(score), pa.array(worst), pa.array(kept)]
            batch = batch.select(range(batch.num_columns - 1))
            yield batch.append_column("quality", pa.StructArray.from_arrays(columns, names))

    return docs.withColumn("_fold", fold()).mapInArrow(rate, schema)
