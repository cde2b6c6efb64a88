"""Near-duplicates by MinHash: universal hash minima, banding, signature and full-set verification, components.

A document's set holds its distinct ``words``-word shingles (ASCII lower case, words divided by ASCII white space); with fewer words
the whole sequence is the one shingle. Documents are linked where ``100 * |intersection| >= percent * |union|``.

1. Documents with equal sets form a class, named by its smallest doc_id; only classes go on. A group of copies is
   one row per task in that aggregate.
2. Each class has ``BANDS * ROWS`` minima. Classes that agree in a whole band share a bucket; each is
   paired with the bucket's smallest class, which makes as many pairs as rows.
3. Pairs pass by their sizes, then by their signatures, then by the full sets. Links give components.
4. Buckets of more than two classes that still hold several components are compared in full, once for all buckets of the same
   classes: in blocks of bounded bytes, for pairs of different components only, by signatures and then by full sets within the
   task, which hands on no more links than join its components. So every pair that shares a bucket is either within a component
   or was compared; none is capped or dropped.

At 85 percent a linked pair shares no band with probability 2e-6, and the signature test loses one with less than 1e-6.

Defined results: a document without words has an empty set, is linked with nothing and kept. Rows without doc_id are linked with
nothing, have no component and are kept. Rows with one doc_id are one node. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MIX_A, MIX_B, mixed, stored, word_ids
from .components import connected_components
from .quality import as_bytes
from .tokens import forget

BANDS, ROWS = 28, 6
MINIMA = BANDS * ROWS
BLOCK_BYTES = 8 << 20
CHUNK = 256


def shingles(text: bytes, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles."""
    parts = text.lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    if len(parts) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(parts), seed=len(parts))], np.uint64)
    ids, seen = word_ids(parts)
    each = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in seen), np.uint64, len(seen))[ids]
    h = each[: len(parts) - words + 1]
    for k in range(1, words):
        h = mixed(h * MIX_A + np.uint64(k)) + each[k : len(parts) - words + 1 + k]
    return np.unique(mixed(h * MIX_B))


def universal() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20240508)
    a = random.integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, random.integers(0, 1 << 63, MINIMA, dtype=np.uint64)


def signature(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least value of each hash function ``(a x + b mod 2^64) >> 32`` over the set."""
    x = hashes >> np.uint64(32)
    least = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(x), CHUNK):
        np.minimum(least, (a[:, None] * x[at : at + CHUNK] + b[:, None]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def band_keys(minima: np.ndarray) -> np.ndarray:
    rows = minima.astype(np.uint64).reshape(BANDS, ROWS)
    h = np.arange(1, BANDS + 1, dtype=np.uint64) * MIX_B
    for k in range(ROWS):
        h = mixed(h * MIX_A + rows[:, k] + np.uint64(1))
    return h.view(np.int64)


def digest(hashes: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def sets_of(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id``, ``size``, digest (``d1``, ``d2``), ``minima`` and ``bands`` of each row with a doc_id."""

    def build(batches):
        forget()
        a, b = universal()
        for batch in batches:
            found = []
            for text in as_bytes(batch.column(1)):
                s = shingles(text, words)
                sig = signature(s, a, b) if len(s) else None
                found.append((len(s), *digest(s), sig.tobytes() if len(s) else None, band_keys(sig) if len(s) else None))
            columns = list(zip(*found)) if found else [[]] * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))], ["doc_id", "size", "d1", "d2", "minima", "bands"])

    schema = "doc_id long, size long, d1 long, d2 long, minima binary, bands array<long>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(build, schema)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row of ``docs``."""
    rows = stored(sets_of(docs, words).withColumn("row", F.monotonically_increasing_id()), "sets")
    named = rows.filter("size > 0 and doc_id is not null")
    classes = named.groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "row")).alias("least"))
    classes = classes.select("d1", "d2", F.col("least.doc_id").alias("class"), F.col("least.row").alias("row"))
    classes = stored(classes, "classes")
    nodes = stored(named.join(classes.select("row", "class"), "row").select("class", "size", "d1", "d2", "minima", "bands"), "nodes")

    member = nodes.select("class", "size", F.explode("bands").alias("bucket"))
    shared = member.groupBy("bucket").agg(F.min("class").alias("leader"), F.max("class").alias("other")).filter("leader <> other")
    member = stored(member.join(shared.select("bucket", "leader"), "bucket"), "buckets")
    pairs = member.filter("class <> leader").select(F.col("leader").alias("a"), F.col("class").alias("b")).distinct()
    sets = stored(full_sets(docs, nodes, member, words), "full")
    # Different sets under one doc_id are one node without any link.
    links = stored(verified(signed(pairs, nodes, percent), sets, percent), "links")
    roots = connected_components(links)

    more = stored(contested(member, roots, nodes, sets, percent), "more")
    if not more.isEmpty():
        roots = connected_components(links.union(more))

    by_class = roots.select(F.col("node").alias("class"), F.col("root"))
    group = classes.join(by_class, "class", "left").select("d1", "d2", "class", F.coalesce("root", "class").alias("root"))
    found = rows.select("doc_id", "size", "d1", "d2").join(group.select("d1", "d2", "root"), ["d1", "d2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.when(F.col("size") > 0, F.col("root")).otherwise(F.col("doc_id")))
    found = found.select("doc_id", F.col("size").alias("n_shingles"), component.alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def signed(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sizes allow a link and whose signatures do not speak against it."""
    side = nodes.select("class", "size", "minima").join(pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct(), "class", "left_semi")
    side = stored(side, "signatures")
    both = pairs.join(side.select(F.col("class").alias("a"), F.col("size").alias("size_a"), F.col("minima").alias("minima_a")), "a")
    both = both.join(side.select(F.col("class").alias("b"), F.col("size").alias("size_b"), F.col("minima").alias("minima_b")), "b")
    both = both.filter(100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b"))
    least = least_equal(percent)

    def compare(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(-1, MINIMA) for i in (2, 3))
            yield batch.select([0, 1]).filter(pa.array((a == b).sum(axis=1) >= least))

    return both.select("a", "b", "minima_a", "minima_b").mapInArrow(compare, "a long, b long")


def least_equal(percent: int) -> int:
    """Equal minima that a linked pair has at least, but for five standard deviations."""
    p = percent / 100
    return int(MINIMA * (p - 5 * (p * (1 - p) / MINIMA) ** 0.5))


def full_sets(docs: DataFrame, nodes: DataFrame, member: DataFrame, words: int) -> DataFrame:
    """The sorted shingle hashes of the classes that share a bucket, made again from their texts."""
    wanted = nodes.select("class", "d1", "d2").join(member.select("class").distinct(), "class", "left_semi")
    texts = docs.select(F.col("doc_id").cast("long").alias("class"), "text").join(wanted, "class")

    def build(batches):
        for batch in batches:
            all_sets = [shingles(x, words) for x in as_bytes(batch.column(1))]
            same = [digest(s) == d for s, d in zip(all_sets, zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()))]
            made = pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in all_sets], pa.binary())], ["class", "full"])
            yield made.filter(pa.array(same, pa.bool_()))

    return texts.select("class", "text", "d1", "d2").mapInArrow(build, "class long, full binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) that are linked by their full sets."""
    both = pairs.join(sets.select(F.col("class").alias("b"), F.col("full").alias("full_b")), "b")
    both = both.join(sets.select(F.col("class").alias("a"), F.col("full").alias("full_a")), "a")

    def compare(batches):
        for batch in batches:
            full = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            keep = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in full]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "full_a", "full_b").mapInArrow(compare, "a long, b long").distinct()


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def contested(member: DataFrame, roots: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components that share a bucket, no more than join them.

    A bucket is dealt in blocks of about ``BLOCK_BYTES``, so a task holds two blocks whatever the bucket's size.
    """
    rooted = member.join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
    rooted = rooted.select("bucket", "class", "size", F.coalesce("root", "class").alias("root"))
    several = rooted.groupBy("bucket").agg(
        F.min("root").alias("lo"),
        F.max("root").alias("hi"),
        F.count("*").alias("n"),
        F.sum(F.col("size") * 8 + 4 * MINIMA).alias("bytes"),
        F.sum(F.xxhash64("class").cast("decimal(38,0)")).alias("content"),
    )
    # Two classes were compared already, as each was with its bucket's smallest; the same classes often meet in many buckets.
    several = several.filter("lo <> hi and n > 2").groupBy("lo", "hi", "n", "bytes", "content").agg(F.min("bucket").alias("bucket"))
    several = several.select("bucket", F.ceil(F.col("bytes") / BLOCK_BYTES).cast("int").alias("blocks"))
    dealt = rooted.join(several, "bucket").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "class", "root", "size")
    dealt = dealt.join(nodes.select("class", "minima"), "class").join(sets, "class")

    def compare(pdf):
        import pandas as pd

        return pd.DataFrame(joining_links(pdf, percent), columns=["a", "b"], dtype="int64")

    return dealt.groupBy("bucket", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def joining_links(rows, percent: int) -> list[tuple[int, int]]:
    """Verified links between the rows' components, by union-find; ``rows`` as dealt in :func:`contested`."""
    sig = np.frombuffer(b"".join(rows.minima), np.uint32).reshape(-1, MINIMA)
    full = [np.frombuffer(x, np.uint64) for x in rows.full]
    node, size, least = rows["class"].to_numpy(), rows["size"].to_numpy(), least_equal(percent)
    names, group, counts = np.unique(rows.root.to_numpy(), return_inverse=True, return_counts=True)
    parent, out, refuted = list(range(len(names))), [], set()

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    # Rows of the largest component meet the others from their side.
    for k in np.flatnonzero(group != counts.argmax()):
        near = np.flatnonzero((group != group[k]) & (100 * np.minimum(size, size[k]) >= percent * np.maximum(size, size[k])))
        equal = (sig[near] == sig[k]).sum(axis=1)
        for c in near[np.argsort(-equal, kind="stable")][: int((equal >= least).sum())]:
            if find(group[c]) == find(group[k]) or (c, k) in refuted:
                continue
            if linked(full[k], full[c], percent):
                parent[find(group[c])] = find(group[k])
                out.append((min(node[k], node[c]), max(node[k], node[c])))
            else:
                refuted.add((k, c))
    return out
