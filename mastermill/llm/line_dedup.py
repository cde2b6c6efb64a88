"""Line dedup by content-defined chunks, with DataFrame functions only.

The lines of a text (split at ``\\n``) are hashed. A rolling hash over two neighbouring line hashes ends a chunk
where it is divisible by ``DIVISOR``, and a line of ``LEAST_BYTES`` bytes or more is a chunk of its own, so that chunk limits depend on nearby
lines only and shift along with them. Chunks of two lines or more, or of ``LEAST_BYTES``,
that occur several times anywhere are removed but for their first occurrence (smallest doc_id, null last, then
earliest in the text), after their text was found equal byte by byte to that of the first. Only digests are shuffled for the search, and the texts of
a digest that many documents hold are dealt over ``SLOTS`` tasks.

Defined results: a null or empty text stays as it is with no lines removed. Rows that agree in doc_id and text are one
document and come out alike. A text of which nothing is left becomes empty, and ``n_kept_lines`` is 0. Columns that
clash with the result's own (``n_lines``, ``n_kept_lines``) are replaced; other columns pass through.

Of passages of short lines the chunks at either end run on into other lines and stay. :func:`dedup_line_runs` is
the whole rule: a line goes if it lies in a run of whole lines of ``LEAST_BYTES`` or more (line ends counted) that stands earlier too.
It looks up the shortest such runs from and up to each line, of which every longer run is made, by their SHA-256, so that no text is
shuffled for the search. Each line that goes still stands in an earlier place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted, stored

DIVISOR = 2
SLOTS = 64  # bits of a long
FACTOR = 31
LEAST_LINES = 2
LEAST_BYTES = 50


def line_hash(line: Column) -> Column:
    """48 bits of the line's MD5."""
    return F.conv(F.substring(F.md5(line), 1, 12), 16, 10).cast("long")


def let(value: Column, use) -> Column:
    """``use(value)`` with the value evaluated once, however often it is used and even within functions of array elements."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def chunk_ends(facts: Column, count: Column) -> Column:
    """Positions (from 0) of the last line of each chunk, from the hash of each line and whether it is long."""

    def end(x, i):
        # A long line ends its own chunk and the one before it.
        rolled = (i > 0) & ((F.get(facts, i - 1)["h"] * FACTOR + x["h"]) % DIVISOR == 0)
        return F.when((i == count - 1) | x["long"] | F.get(facts, i + 1)["long"] | rolled, i)

    return F.filter(F.transform(facts, end), lambda e: e.isNotNull())


def chunks_of(lines: Column) -> Column:
    """``chunk``, ``start`` (line, from 0), ``n_lines``, ``size`` (bytes) and ``digest`` of each chunk."""
    facts = F.transform(lines, lambda x: F.struct(line_hash(x).alias("h"), (F.octet_length(x) >= LEAST_BYTES).alias("long")))

    def chunk(ends, e, i):
        start = F.when(i == 0, F.lit(0)).otherwise(F.get(ends, i - 1) + 1)
        place = (i.alias("chunk"), start.alias("start"), (e - start + 1).alias("n_lines"))
        return let(body(lines, start, e - start + 1), lambda x: F.struct(*place, F.octet_length(x).alias("size"), F.unhex(F.md5(x)).alias("digest")))

    return let(facts, lambda f: let(chunk_ends(f, F.size(lines)), lambda ends: F.transform(ends, lambda e, i: chunk(ends, e, i))))


def body(lines: Column, start: Column, n_lines: Column) -> Column:
    return F.array_join(F.slice(lines, start + 1, n_lines), "\n")


def chunked(docs: DataFrame) -> DataFrame:
    """One row per document and chunk: ``key``, ``doc_id`` and the columns of :func:`chunks_of`; no text is repeated."""
    rows = docs.select("doc_id", row_key().alias("key"), F.explode(let(text_lines(), chunks_of)).alias("c"))
    return rows.select("key", "doc_id", "c.*")


def text_lines() -> Column:
    return F.split(F.coalesce("text", F.lit("")), "\n", -1)


def row_key() -> Column:
    return F.unhex(F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.md5(F.coalesce("text", F.lit(""))))))


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """``key``, ``chunk``, ``start`` and ``n_lines`` of each chunk to remove."""
    several = chunked(docs).filter((F.col("n_lines") >= LEAST_LINES) | (F.col("size") >= LEAST_BYTES))
    slot = F.pmod(F.xxhash64("key", "chunk"), F.lit(SLOTS)).cast("int").alias("slot")
    at = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key", "chunk").alias("at")
    refs = stored(several.select("digest", slot, at, "start", "n_lines"), "chunks")
    # Digests alone, counted in the map tasks first; a chunk in a third of all texts is one row per task.
    slots = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), "slot")).alias("slots")
    found = refs.groupBy("digest").agg(F.min("at").alias("first"), F.max("at").alias("greatest"), slots).filter("first != greatest")
    used = F.filter(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda k: F.call_function("shiftright", "slots", k).bitwiseAND(F.lit(1)) == 1)
    pairs = stored(found.select("digest", "first", F.explode(used).alias("slot")), "repeated-digests")
    again = refs.join(pairs, ["digest", "slot"]).withColumn("is_first", F.col("at") == F.col("first"))
    # The texts of these chunks alone, gathered by document, are compared byte by byte.
    wanted = F.struct("digest", "slot", "is_first", F.col("at.chunk").alias("chunk"), "start", "n_lines")
    needed = stored(again.groupBy(F.col("at.key").alias("key")).agg(F.collect_set(wanted).alias("needed")), "repeated-chunks")
    texts = docs.select(row_key().alias("key"), "text").join(needed, "key").dropDuplicates(["key"])

    def bodies(lines):
        kept = ("digest", "slot", "is_first", "chunk", "start", "n_lines")
        return F.transform("needed", lambda c: F.struct(*[c[k].alias(k) for k in kept], body(lines, c["start"], c["n_lines"]).alias("body")))

    each = texts.select("key", F.explode(let(text_lines(), bodies)).alias("c")).select("key", "c.*")
    firsts = each.filter("is_first").select("digest", F.col("body").alias("first_body"))
    firsts = firsts.join(pairs.select("digest", "slot"), "digest")
    later = each.filter("not is_first").join(firsts, ["digest", "slot"]).filter("body = first_body")
    return later.select("key", "chunk", "start", "n_lines")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated chunks cut out of ``text``, and the counts ``n_lines`` and ``n_kept_lines``."""
    own = ("n_lines", "n_kept_lines", "_key", "_gone")
    docs = docs.select(*[F.col(quoted(c)) for c in docs.columns if c.lower() not in own])
    gone = repeated_chunks(docs.select("doc_id", "text")).groupBy(F.col("key").alias("_key"))
    gone = gone.agg(F.collect_set(F.struct("start", "n_lines")).alias("_runs"))
    return cut_runs(docs, gone)


def cut_runs(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the lines in the runs (``start``, ``n_lines``) that ``gone`` has in ``_runs`` for their ``_key``."""
    places = F.flatten(F.transform("_runs", lambda r: F.sequence(r["start"], r["start"] + r["n_lines"] - 1)))
    joined = docs.withColumn("_key", row_key()).join(gone.select("_key", F.array_distinct(places).alias("_gone")), "_key", "left")
    out = joined.withColumn("_lines", F.split(F.coalesce("text", F.lit("")), "\n", -1))
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    out = out.withColumn("_left", F.when(F.col("_gone").isNotNull(), F.transform(left, lambda i: F.col("_lines")[i])))
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join("_left", "\n"))
    kept = [text.alias(c) if c.lower() == "text" else F.col(quoted(c)) for c in docs.columns]
    n_kept = F.when(F.col("_gone").isNull(), F.size("_lines")).otherwise(F.size("_left"))
    return out.select(*kept, F.size("_lines").cast("long").alias("n_lines"), n_kept.cast("long").alias("n_kept_lines"))


def line_runs(docs: DataFrame) -> DataFrame:
    """The shortest runs of ``LEAST_BYTES`` from and up to each line: ``key``, ``doc_id``, ``first`` (line, from 0), ``n_lines``, ``digest``."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    rows = docs.select("doc_id", row_key().alias("key"), lines.alias("lines"))
    rows = rows.withColumn("sizes", F.transform("lines", lambda x: F.octet_length(x) + 1))
    limits = F.flatten(F.transform("sizes", lambda size, i: F.when(size >= LEAST_BYTES, F.array(limit(i, F.lit(1)))).otherwise(short_runs(i))))
    rows = rows.withColumn("limits", F.array_distinct(F.filter(limits, lambda r: r["n_lines"] > 0)))
    body = lambda r: F.array_join(F.slice("lines", r["first"] + 1, r["n_lines"]), "\n")
    runs = F.transform("limits", lambda r: F.struct(r["first"].alias("first"), r["n_lines"].alias("n_lines"), F.unhex(F.sha2(body(r), 256)).alias("digest")))
    return rows.select("key", "doc_id", F.explode(runs).alias("run")).select("key", "doc_id", "run.*")


def repeated_runs(docs: DataFrame) -> DataFrame:
    """``key``, ``first`` and ``n_lines`` of each run that stands earlier too."""
    refs = line_runs(docs).select("digest", F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key", "first", "n_lines").alias("at"))
    found = refs.groupBy("digest").agg(F.min("at").alias("earliest"), F.max("at").alias("greatest"))
    found = found.filter("earliest != greatest").select("digest", "earliest")
    return refs.join(found, "digest").filter("at != earliest").select("at.key", "at.first", "at.n_lines")


def limit(first: Column, count: Column) -> Column:
    return F.struct(first.cast("int").alias("first"), count.cast("int").alias("n_lines"))


def short_runs(i: Column) -> Column:
    """From line ``i`` on and up to it; 0 lines where the text ends before. Each line has a byte at least, its end."""
    before = F.greatest(i - (LEAST_BYTES - 1), F.lit(0))
    ahead = lines_needed(F.slice("sizes", i + 1, LEAST_BYTES))
    back = lines_needed(F.reverse(F.slice("sizes", before + 1, i - before + 1)))
    return F.array(limit(i, ahead), limit(i - back + 1, back))


def lines_needed(sizes: Column) -> Column:
    start = F.struct(F.lit(0).alias("bytes"), F.lit(0).alias("n"))

    def step(a, size):
        more = a["bytes"] < LEAST_BYTES
        return F.struct(F.when(more, a["bytes"] + size).otherwise(a["bytes"]).alias("bytes"), F.when(more, a["n"] + 1).otherwise(a["n"]).alias("n"))

    return F.aggregate(sizes, start, step, lambda a: F.when(a["bytes"] >= LEAST_BYTES, a["n"]).otherwise(0))


def dedup_line_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines of repeated runs cut out of ``text``, and the counts ``n_lines`` and ``n_kept_lines``."""
    own = ("n_lines", "n_kept_lines", "_key", "_gone")
    docs = docs.select(*[F.col(quoted(c)) for c in docs.columns if c.lower() not in own])
    gone = repeated_runs(docs.select("doc_id", "text")).groupBy(F.col("key").alias("_key"))
    gone = gone.agg(F.collect_set(F.struct(F.col("first").alias("start"), "n_lines")).alias("_runs"))
    return cut_runs(docs, gone)
