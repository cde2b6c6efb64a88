"""Removal of byte strings that an earlier document holds too, by suffix sorting of shards.

A byte goes if a string of ``window`` bytes around it also starts in a document with a smaller doc_id. All documents are treated:

1. The documents are written once with the number of their part, some neighbouring rows of a task with about ``PART_BYTES`` of text; tasks hold one part at a
   time, so their memory does not grow with what a task reads. Whole copies of an earlier document go at once.
2. Each window has a fingerprint: the least hash of its ``GRAM``-byte strings. Neighbouring windows mostly share it, and
   equal windows always do. Each part sends its distinct fingerprints and about how often it has them in a few blocks, and learns which
   of them other documents have, and which are heavy: their segments could exceed ``SHARD_BYTES``.
3. Runs of windows with one such fingerprint become segments. Equal segments of a part are sent once, with the smallest doc_id, to the
   shard of their key, so all places of a window that repeats meet in one shard. The key is the fingerprint, for heavy ones
   the fingerprint with the next least hash of the window. Those keys are weighed in a pass of their own, which only runs if a fingerprint is heavy,
   and windows of a key that is still too heavy go by the hash of the whole window. All three are functions of the window alone.
4. A shard's segments, but for those whose ``GRAM`` bytes no other segment has, are joined and their suffixes sorted by external induced sorting (:mod:`induced_sorting`), which carries the common prefixes along.
   Neighbouring suffixes with a common prefix of a window's length are one string. The smallest doc_id of each string goes back to the parts, which cut their documents.

What a task needs of another step it reads from the shared folder by the number of its part, so texts are never shuffled. A passage in a
third of all documents is one segment per part. Shards are made as many as keep each near ``SHARD_BYTES``, by the weights of the keys.

Defined results: a null text is empty; nothing is removed from texts shorter than the window. A null doc_id is smaller
than all others and loses nothing. Rows that share a doc_id remove nothing from each other. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import SideTable, mixed, stored
from .induced_sorting import suffix_array
from .quality import BASE, as_bytes

GRAM = 20
SHARD_BYTES = 4 << 20
PART_BYTES = 32 << 20  # of texts
PARTS = 10  # bits of a part's number for the parts of a task
BUCKET_BYTES = 32 << 20  # of texts; the fingerprints of a bucket are about half as large
BUFFER = 1 << 16  # bytes hashed at once, whose arrays stay near the processor
NONE = -(1 << 63)
LOW = np.uint64(6)  # bits of a sent fingerprint that hold, from the least, whether several documents have it and the logarithm of its number
SPANS = "array<struct<start:bigint,end:bigint>>"


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """The hash of each string of ``GRAM`` bytes of ``data``, which is not shorter than that."""
    n = len(data)
    up, down = powers(n)
    terms, sums = data.astype(np.uint64), np.zeros(n + 1, np.uint64)
    terms += np.uint64(1)
    terms *= up[:n]
    np.cumsum(terms, out=sums[1:])
    hashes = sums[GRAM:] - sums[:-GRAM]
    hashes *= down[: n - GRAM + 1]
    return mixed(hashes)


def least_of(hashes: np.ndarray, span: int) -> np.ndarray:
    """The least of each ``span`` neighbouring hashes: the fingerprints of the windows."""
    least, size = hashes, 1
    while size < span:
        step = min(size, span - size)
        least = np.minimum(least[:-step], least[step:])
        size += step
    return least


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, x in enumerate((BASE, np.uint64(pow(int(BASE), -1, 1 << 64)))):
            _POWERS[i] = np.multiply.accumulate(np.where(np.arange(size) > 0, x, np.uint64(1)))
    return _POWERS


def runs(texts: list[bytes], window: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of neighbouring windows with one fingerprint, some texts at a time: fingerprint, text number, place in the text, number
    of windows, and where the run starts in the bytes that come last."""
    part, owner, shift, size = [], [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - window + 1), BUFFER):
            piece = text[at : at + BUFFER + window - 1]
            if size and size + len(piece) > BUFFER + window:
                yield _runs(part, owner, shift, window)
                part, owner, shift, size = [], [], [], 0
            if len(piece) >= window:
                part.append(piece)
                owner.append(i)
                shift.append(at)
                size += len(piece)
    if part:
        yield _runs(part, owner, shift, window)


def _runs(part: list[bytes], owner: list[int], shift: list[int], window: int) -> tuple:
    data = b"".join(part)
    hashes = np.maximum(gram_hashes(np.frombuffer(data, np.uint8)), np.uint64(2))
    fps = least_of(hashes, window - GRAM + 1)
    ends = np.cumsum([len(x) for x in part])
    fps = fps.copy() if fps is hashes else fps
    for end in ends[:-1].tolist():
        fps[end - window + 1 : end] = 0  # windows that cross into the next text
    new = np.concatenate([[True], fps[1:] != fps[:-1]])
    new[ends[:-1][ends[:-1] < len(new)]] = True
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(fps)))
    inside = fps[first] > 0
    first, count = first[inside], count[inside]
    piece = np.searchsorted(ends, first, side="right")
    place = first - (ends[piece] - np.array([len(x) for x in part])[piece]) + np.array(shift)[piece]
    return fps[first], np.array(owner)[piece], place, count, first, hashes, data


def anchored(fps: np.ndarray, count: np.ndarray, start: np.ndarray, hashes: np.ndarray, span: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The runs cut so that all windows of one have the same first place of the string their fingerprint is of: number of the run, windows
    before the part, windows in it, and the offset of that place from the part's start. Nearly all runs are whole parts."""
    number, skipped = np.arange(len(fps)), np.zeros(len(fps), np.int64)
    while len(number):
        of_window = np.lib.stride_tricks.sliding_window_view(hashes, span)[start[number] + skipped]
        offset = (of_window == fps[number][:, None]).argmax(axis=1)
        inside = np.minimum(count[number] - skipped, offset + 1)
        yield number, skipped, inside, offset
        more = skipped + inside < count[number]
        number, skipped = number[more], (skipped + inside)[more]


def dedup_substrings(docs: DataFrame, window: int = 50, part_bytes: int = PART_BYTES) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``spans`` (removed runs of bytes) and ``kept`` (the remaining bytes) of each row.

    A part holds the rows of a task that begin within the next ``part_bytes`` of its texts.
    """
    if window <= GRAM:
        raise ValueError(f"a window holds more than {GRAM} bytes")
    text, sizes = F.coalesce("text", F.lit("")).cast("binary").alias("text"), Observation("sizes")
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NONE)).alias("doc"), text)
    docs = docs.observe(sizes, F.sum(F.octet_length("text").cast("long")).alias("bytes"))
    parts = stored(docs.mapInArrow(_numbering(part_bytes), "part int, doc long, text binary"), "parts")

    digests = parts.select("part", "doc", F.md5("text").alias("digest"))
    first = digests.groupBy("digest").agg(F.min("doc").alias("first"))
    copies = SideTable(digests.join(first, "digest").filter("doc > first").select("part", "doc", "digest"), "copies")

    wanted, segments = sharded(parts, copies, window, sizes.get.get("bytes") or 0)
    answers = segments.groupBy("shard").applyInPandas(_shard(window), "part int, keys binary, counts binary, lengths binary, docs binary")
    owners = SideTable(stored(answers, "answers"), "owners")

    schema = f"doc_id long, n_bytes long, spans {SPANS}, kept binary"
    return parts.mapInArrow(_cutting(copies, wanted, owners, window), schema)


def _numbering(part_bytes: int):
    """Put the number of its part before each row."""

    def number(batches):
        first, held = TaskContext.get().partitionId() << PARTS, 0
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64)
            before = held + np.cumsum(sizes) - sizes
            held += int(sizes.sum())
            part = first + np.minimum(before // part_bytes, (1 << PARTS) - 1)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), *batch.columns], ["part", *batch.schema.names])

    return number


def sharded(parts: DataFrame, copies: SideTable, window: int, size: int) -> tuple[_Wanted, DataFrame]:
    """Which fingerprints and keys of each part are to be looked up and split, and the segments by shard; the texts have ``size`` bytes."""
    buckets = max(int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    most = 2 * window - GRAM  # bytes of a segment
    blocks = parts.mapInArrow(_sending(copies, window, buckets), "bucket int, part int, fps binary")
    found = blocks.groupBy("bucket").applyInPandas(_repeated(SHARD_BYTES // most), "part int, fps binary, heavy binary, n long, n_heavy long")
    repeated = stored(found, "repeated")
    wanted = _Wanted(SideTable(repeated.select("part", "fps", "heavy"), "wanted"))
    n, n_heavy = repeated.agg(F.sum("n"), F.sum("n_heavy")).first()
    size = (n or 0) * most
    if n_heavy:
        blocks = parts.mapInArrow(_weighing(copies, wanted, window, buckets), "bucket int, part int, keys binary, sizes binary, windows binary")
        weighed = stored(blocks.groupBy("bucket").applyInPandas(_too_heavy(SHARD_BYTES, window), "part int, keys binary, size long"), "weighed")
        wanted = _Wanted(wanted.table, SideTable(weighed.select("part", "keys"), "split"))
        size += weighed.agg(F.sum("size")).first()[0] or 0
    shards = max(1, int(size // SHARD_BYTES) + 1)
    return wanted, parts.mapInArrow(_segments(copies, wanted, window, shards), "shard int, part int, body binary, sizes binary, grams binary, docs binary")


def _by_part(batches: Iterator[pa.RecordBatch], copies: SideTable) -> Iterator[tuple[int, Iterator[tuple[list[int], list[bytes], list[bool]]]]]:
    """Each part with its rows, some at a time: doc, text and whether it is a copy. The rows of a part follow each other; should they be dealt to several tasks or
    come in several pieces, each piece counts as other documents of that part."""
    for part, rows in itertools.groupby(_rows(batches, copies), operator.itemgetter(0)):
        yield part, (row[1:] for row in rows)


def _rows(batches: Iterator[pa.RecordBatch], copies: SideTable) -> Iterator[tuple[int, list[int], list[bytes], list[bool]]]:
    last, known, ids = None, set(), set()
    for batch in batches:
        part = batch.column(0).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            p, rows = int(part[a]), batch.slice(a, b - a)
            if p != last:
                table = copies.rows(p)
                known = set(zip(table["doc"].to_pylist(), table["digest"].to_pylist())) if table else set()
                last, ids = p, {d for d, _ in known}
            docs, texts = rows.column(1).to_pylist(), as_bytes(rows.column(2))
            yield p, docs, texts, [d in ids and (d, hashlib.md5(t).hexdigest()) in known for d, t in zip(docs, texts)]


def _sending(copies: SideTable, window: int, buckets: int):
    def send(batches):
        for part, rows in _by_part(batches, copies):
            arrays = []
            for _, texts, copied in rows:
                for fps, owner, _, count, *_ in runs([b"" if c else t for t, c in zip(texts, copied)], window):
                    order = np.argsort(fps, kind="stable")  # texts are in order already
                    fps, owner = fps[order] >> LOW, owner[order]
                    # A long run has its string in several places.
                    places = 1 + count[order] // (window - GRAM + 1)
                    first = np.flatnonzero(np.concatenate([[True], (fps[1:] != fps[:-1]) | (owner[1:] != owner[:-1])]))
                    arrays.append(_several(packed(fps[first], False, np.add.reduceat(places, first))))
            fps = _several(np.sort(np.concatenate(arrays))) if arrays else np.zeros(0, np.uint64)
            for bucket, (mine,) in by_bucket(fps >> np.uint64(32), buckets, fps):
                yield pa.RecordBatch.from_pydict({"bucket": pa.array([bucket], pa.int32()), "part": pa.array([part], pa.int32()), "fps": pa.array([mine], pa.binary())})

    return send


def by_bucket(keys: np.ndarray, buckets: int, *values: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
    bucket = keys % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for rows in np.split(order, cuts) if len(order) else []:
        yield int(bucket[rows[0]]), [v[rows].tobytes() for v in values]


def packed(plain: np.ndarray, several, total: np.ndarray) -> np.ndarray:
    """Fingerprints as sent. The number is rounded up to a power of two."""
    power = np.minimum(np.frexp((total - 1).astype(float))[1], 31).astype(np.uint64)
    return (plain << LOW) | (power << np.uint64(1)) | np.asarray(several, np.uint64)


def totals(sent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The fingerprints in sorted ``sent``, each once, whether several documents have them, and their number."""
    plain = sent >> LOW
    first = np.flatnonzero(np.concatenate([[True], plain[1:] != plain[:-1]])) if len(sent) else np.zeros(0, np.int64)
    if not len(first):
        return plain, np.zeros(0, bool), np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(sent)))
    marked = np.maximum.reduceat(sent & np.uint64(1), first)
    return plain[first], (count > 1) | (marked > 0), np.add.reduceat(numbers(sent), first)


def numbers(sent: np.ndarray) -> np.ndarray:
    return np.int64(1) << ((sent >> np.uint64(1)) & np.uint64(31)).astype(np.int64)


def _several(sent: np.ndarray) -> np.ndarray:
    """Sorted fingerprints as sent, each once."""
    plain, several, total = totals(sent)
    return packed(plain, several, total)


def _repeated(most: int):
    """A fingerprint is heavy that stands in more than ``most`` places."""

    def find(pdf):
        import pandas as pd

        arrays = [np.frombuffer(x, np.uint64) for x in pdf.fps]
        plain, several, total = totals(np.sort(np.concatenate(arrays)))
        heavy = plain[several & (total > most)]
        several = plain[several]
        out = []
        for part, sent in zip(pdf.part, arrays):
            hit = member(sent >> LOW, several)
            mine, n = sent[hit] >> LOW, numbers(sent[hit])
            if len(mine):
                split = member(mine, heavy)
                out.append((part, mine.tobytes(), mine[split].tobytes(), int(n[~split].sum()), int(n[split].sum())))
        return pd.DataFrame(out, columns=["part", "fps", "heavy", "n", "n_heavy"])

    return find


def _weighing(copies: SideTable, wanted: _Wanted, window: int, buckets: int):
    """Bytes and windows of the segments of heavy fingerprints, by key; equal ones of a part once, as they will be sent."""

    def weigh(batches):
        for part, rows in _by_part(batches, copies):
            mine = {}
            for _, texts, copied in rows:
                for _, _, _, body, gram, key in _candidate_segments(texts, copied, wanted.of(part), window, heavy_only=True):
                    mine[body, gram] = key
            keys, at = np.unique(np.fromiter(mine.values(), np.uint64, len(mine)), return_inverse=True)
            sizes = np.fromiter((len(body) for body, _ in mine), np.int64, len(mine))
            size, windows = (np.bincount(at, x, len(keys)).astype(np.int64) for x in (sizes, sizes - window + 1))
            for bucket, values in by_bucket(keys, buckets, keys, size, windows):
                columns = {"bucket": pa.array([bucket], pa.int32()), "part": pa.array([part], pa.int32())}
                columns |= {name: pa.array([v], pa.binary()) for name, v in zip(("keys", "sizes", "windows"), values)}
                yield pa.RecordBatch.from_pydict(columns)

    return weigh


def _too_heavy(limit: int, window: int):
    """The keys of each part with more than ``limit`` bytes in all parts, and the part's bytes once their windows are sent one by one."""

    def find(pdf):
        import pandas as pd

        keys, sizes, windows = ([np.frombuffer(x, t) for x in pdf[c]] for c, t in (("keys", np.uint64), ("sizes", np.int64), ("windows", np.int64)))
        every, at = np.unique(np.concatenate(keys), return_inverse=True)
        heavy = every[np.bincount(at, np.concatenate(sizes), len(every)) > limit]
        out = []
        for part, k, size, n in zip(pdf.part, keys, sizes, windows):
            split = member(k, heavy)
            out.append((part, k[split].tobytes(), int(size[~split].sum() + n[split].sum() * window)))
        return pd.DataFrame(out, columns=["part", "keys", "size"])

    return find


def member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which of ``values`` are in the sorted array ``among``."""
    if not len(among):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return among[at] == values


def _candidate_segments(texts: list[bytes], copied: list[bool], wanted: _Part, window: int, heavy_only: bool = False):
    """(text number, start in the text, number of windows, bytes, offset of the fingerprint's string, key) of each segment."""
    among, heavy = wanted.heavy_fps if heavy_only else wanted.fps, wanted.heavy
    for fps, owner, place, count, start, hashes, data in runs([b"" if c else t for t, c in zip(texts, copied)], window):
        hit = np.flatnonzero(member(fps >> LOW, among))
        for number, skipped, inside, offset in anchored(fps[hit], count[hit], start[hit], hashes, window - GRAM + 1):
            rows = (owner[hit][number], place[hit][number] + skipped, inside, start[hit][number] + skipped, offset, fps[hit][number] >> LOW)
            for text, at, n, a, gram, fp in zip(*(x.tolist() for x in rows)):
                if not heavy or fp not in heavy:
                    yield text, at, n, data[a : a + n + window - 1], gram, fp
                    continue
                for skip, m, key in split_windows(hashes[a : a + n + window - GRAM], n, gram, fp, window):
                    if key not in wanted.split:
                        yield text, at + skip, m, data[a + skip : a + skip + m + window - 1], gram - skip, key
                        continue
                    for i in range(skip, skip + m):
                        body = data[a + i : a + i + window]
                        yield text, at + i, 1, body, gram - i, int.from_bytes(hashlib.blake2b(body, digest_size=8).digest(), "little")


def split_windows(hashes: np.ndarray, n: int, gram: int, fp: int, window: int) -> Iterator[tuple[int, int, int]]:
    """Runs of the ``n`` windows of a segment with the same next least hash: windows before, windows in it, key."""
    other = hashes.copy()
    other[gram] = ~np.uint64(0)
    least = least_of(other, window - GRAM + 1)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    keys = mixed(least[first] ^ mixed(np.array([fp], np.uint64)))
    return zip(first.tolist(), np.diff(np.append(first, n)).tolist(), keys.tolist())


class _Part:
    def __init__(self, rows: pa.Table | None, split: pa.Table | None):
        self.fps, self.heavy_fps, keys = joined_arrays(rows, "fps"), joined_arrays(rows, "heavy"), joined_arrays(split, "keys")
        self.heavy, self.split = set(self.heavy_fps.tolist()), set(keys.tolist())


def joined_arrays(rows: pa.Table | None, column: str) -> np.ndarray:
    arrays = [np.frombuffer(x, np.uint64) for x in rows[column].to_pylist()] if rows else []
    return np.sort(np.concatenate(arrays)) if arrays else np.zeros(0, np.uint64)


class _Wanted:
    def __init__(self, table: SideTable, split: SideTable | None = None):
        self.table, self.split, self.known = table, split, (None, None)

    def of(self, part: int) -> _Part:
        """What is known of a part; of the one asked for last, as tasks hold one at a time."""
        if part != self.known[0]:
            self.known = (None, None)
            self.known = (part, _Part(self.table.rows(part), self.split.rows(part) if self.split else None))
        return self.known[1]


def _segments(copies: SideTable, wanted: _Wanted, window: int, shards: int):
    def make(batches):
        for part, rows in _by_part(batches, copies):
            mine = {}
            for docs, texts, copied in rows:
                for number, _, _, body, gram, key in _candidate_segments(texts, copied, wanted.of(part), window):
                    old = mine.get((body, gram))
                    if old is None or docs[number] < old[0]:
                        mine[body, gram] = (docs[number], key % shards)
            by_shard: dict[int, list] = {}
            for (body, gram), (doc, shard) in mine.items():
                by_shard.setdefault(shard, []).append((body, gram, doc))
            rows = []
            del mine
            for shard, found_here in by_shard.items():
                bodies, grams, docs = zip(*found_here)
                sizes = np.array([len(b) for b in bodies], "<i4").tobytes()
                rows.append((shard, part, b"".join(bodies), sizes, np.array(grams, "<i4").tobytes(), np.array(docs, "<i8").tobytes()))
            types = (pa.int32(), pa.int32(), *[pa.binary()] * 4)
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, types)]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "part", "body", "sizes", "grams", "docs"])

    return make


def segment_key(body: bytes, gram: int) -> bytes:
    return hashlib.blake2b(body, digest_size=16, salt=gram.to_bytes(8, "little")).digest()


def _shard(window: int):
    def answer(pdf):
        import pandas as pd

        number: dict[tuple[bytes, int], int] = {}
        parts, docs = [], []
        for part, body, sizes, grams, sent in zip(pdf.part, pdf.body, pdf.sizes, pdf.grams, pdf.docs):
            ends = np.cumsum(np.frombuffer(sizes, "<i4").astype(np.int64)).tolist()
            bodies = ((body[a:b], g) for a, b, g in zip([0, *ends], ends, np.frombuffer(grams, "<i4").tolist()))
            parts.append((part, np.fromiter((number.setdefault(x, len(number)) for x in bodies), np.int64, len(ends))))
            docs.append(np.frombuffer(sent, "<i8"))
        least = np.full(len(number), np.iinfo(np.int64).max)
        np.minimum.at(least, np.concatenate([mine for _, mine in parts]), np.concatenate(docs))
        segments = list(number)
        runs_of, lengths, owner = smallest_owners(segments, least, window)
        keys = [segment_key(*x) for x in segments]
        out = []
        for part, mine in parts:
            # Runs of windows with one owner; a part needs no more than that.
            count = runs_of[mine + 1] - runs_of[mine]
            at = np.repeat(runs_of[mine] - np.cumsum(count) + count, count) + np.arange(count.sum())
            row = (part, b"".join([keys[i] for i in mine.tolist()]), count.astype("<i4"), lengths[at].astype("<i4"), owner[at].astype("<i8"))
            out.append((*row[:2], *(x.tobytes() for x in row[2:])))
        return pd.DataFrame(out, columns=["part", "keys", "counts", "lengths", "docs"])

    return answer


def smallest_owners(segments: list[tuple[bytes, int]], docs: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The smallest doc of each window's string over all segments, by runs of windows: where each segment's runs begin, the runs'
    lengths, and their docs.

    All windows of a segment hold its gram, so it is one character of the text that is sorted; equal grams are equal characters. A segment that
    has its gram to itself shares no window with another and is left out of that text.
    """
    known: dict[bytes, int] = {}
    symbols = np.fromiter((known.setdefault(body[g : g + GRAM], len(known)) for body, g in segments), np.int64, len(segments))
    alone = np.bincount(symbols, minlength=1)[symbols] == 1
    met = np.flatnonzero(~alone)
    count = np.ones(len(segments), np.int64)
    begins, its_lengths, its_owners = sorted_owners([segments[i] for i in met.tolist()], symbols[met], docs[met], window) if len(met) else ([0], [], [])
    count[met] = np.diff(begins)
    inside = np.repeat(~alone, count)
    lengths, owner = np.empty(len(inside), np.int64), np.empty(len(inside), np.int64)
    lengths[inside], owner[inside] = its_lengths, its_owners
    lengths[~inside] = np.fromiter((len(body) - window + 1 for body, _ in segments), np.int64, len(segments))[alone]
    owner[~inside] = docs[alone]
    return np.append(0, np.cumsum(count)), lengths, owner


def sorted_owners(segments: list[tuple[bytes, int]], symbols: np.ndarray, docs: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same by suffix sorting; ``symbols`` are the numbers of the segments' grams."""
    sizes = np.fromiter((len(body) - GRAM + 1 for body, _ in segments), np.int64, len(segments))
    # A character 0 between segments, bytes from 1 and grams from 257: no string crosses into the next segment.
    data = np.zeros(int((sizes + 1).sum()), np.int32)
    begins = np.cumsum(sizes + 1) - sizes - 1
    plain = np.ones(len(data), bool)
    plain[begins + sizes] = False
    grams = begins + np.fromiter((g for _, g in segments), np.int64, len(segments))
    plain[grams] = False
    data[plain] = np.frombuffer(b"".join([body[:g] + body[g + GRAM :] for body, g in segments]), np.uint8).astype(np.int32) + 1
    data[grams] = symbols + 257
    number = np.repeat(np.arange(len(segments)), sizes + 1)
    size = window - GRAM + 1
    starts = np.arange(len(data)) + size <= (begins + sizes)[number]
    order, shared = suffix_array(data, cap=size)
    string = np.cumsum(shared < size)[starts[order]]
    order = order[starts[order]]
    same = string[1:] == string[:-1]
    string = np.cumsum(np.concatenate([[True], ~same])) - 1
    least = np.minimum.reduceat(docs[number[order]], np.flatnonzero(np.concatenate([[True], ~same])))
    owner = np.zeros(len(data), np.int64)
    owner[order] = least[string]
    place = np.flatnonzero(starts)
    owner, number = owner[place], number[place]
    first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (number[1:] != number[:-1])]))
    runs_of = np.searchsorted(number[first], np.arange(len(segments) + 1))
    return runs_of, np.diff(np.append(first, len(place))), owner[first]


def _cutting(copies: SideTable, wanted: _Wanted, owners: SideTable, window: int):
    def cut(batches):
        for part, found in _by_part(batches, copies):
            answers = _Answers(owners.rows(part))
            for docs, texts, copied in found:
                gone: list[list] = [[] for _ in texts]
                for number, place, _, body, gram, _ in _candidate_segments(texts, copied, wanted.of(part), window):
                    at = place
                    for length, owner in answers.of(segment_key(body, gram)):
                        if owner < docs[number]:
                            gone[number].append((at, at + length + window - 1))
                        at += length
                rows = []
                for doc, text, copy, spans in zip(docs, texts, copied, gone):
                    if copy:
                        spans = [(0, len(text))] if len(text) >= window else []
                    spans = joined(spans)
                    kept = b"".join(text[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(text)]))
                    rows.append({"doc_id": None if doc == NONE else doc, "n_bytes": len(text), "spans": [{"start": a, "end": b} for a, b in spans], "kept": kept})
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", kind), ("kept", pa.binary())]))

    return cut


class _Answers:
    """Lengths and docs of the runs by the key of their segment."""

    def __init__(self, rows: pa.Table | None):
        self.place: dict[bytes, int] = {}
        self.ends, self.lengths, self.docs = [0], [], []
        for row in rows.to_pylist() if rows else []:
            keys, before = row["keys"], self.ends[-1]
            self.place.update(zip((keys[k : k + 16] for k in range(0, len(keys), 16)), range(len(self.ends) - 1, len(self.ends) - 1 + len(keys) // 16)))
            self.ends.extend((np.cumsum(np.frombuffer(row["counts"], "<i4").astype(np.int64)) + before).tolist())
            self.lengths.extend(np.frombuffer(row["lengths"], "<i4").tolist())
            self.docs.extend(np.frombuffer(row["docs"], "<i8").tolist())

    def of(self, key: bytes) -> Iterator[tuple[int, int]]:
        at = self.place[key]
        a, b = self.ends[at], self.ends[at + 1]
        return zip(self.lengths[a:b], self.docs[a:b])


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out
