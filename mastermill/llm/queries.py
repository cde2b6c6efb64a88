"""Registered queries of this package, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mastermill.session import new_work_path

from . import conversation_repair, hard_negatives, nearest
from .common import read_table, ship_package, stored
from .decontaminate import benchmark_matches
from .line_dedup import dedup_line_runs, dedup_lines
from .near_dedup import near_duplicates
from .packing import pack
from .personal_data import BASE_KINDS, KINDS, personal_data
from .quality import fit_quality, rate_quality
from .substring_dedup import dedup_substrings
from .token_counts import TokenTotals, count_tokens
from .token_files import read_token_files, write_token_files
from .url_rules import judge_urls, mine_rules

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
CRC = F.crc32


def query(sql: str | None = None):
    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return f(spark, sf_dir)

        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def tokenizer_path() -> str:
    """The public tokenizer file of this machine; executors must find it at the same place."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), each AS (
  SELECT doc_id, text, unnest(l) AS line, unnest(range(len(l))) AS i, len(l) AS n FROM lines
), hashed AS (
  SELECT *, ('0x' || substr(md5(line), 1, 12))::BIGINT AS h FROM each
), ended AS (
  SELECT *, CASE WHEN i > 0 AND (lag(h) OVER w * 31 + h) % 2 = 0 OR strlen(line) >= 50 OR lead(strlen(line)) OVER w >= 50 THEN 1 ELSE 0 END AS ends FROM hashed
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), numbered AS (
  SELECT *, coalesce(sum(ends) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM ended
), chunks AS (
  SELECT doc_id, chunk, count(*) AS n_lines, string_agg(line, chr(10) ORDER BY i) AS body FROM numbered GROUP BY ALL
), gone AS (
  SELECT doc_id, chunk, counts AND row_number() OVER (PARTITION BY body, counts ORDER BY doc_id, chunk) > 1 AS gone
  FROM (SELECT *, n_lines > 1 OR strlen(body) >= 50 AS counts FROM chunks)
)
SELECT n.doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text,
       count(*)::BIGINT AS n_lines, (count(*) FILTER (NOT gone))::BIGINT AS n_kept_lines
FROM numbered n JOIN gone g ON g.doc_id = n.doc_id AND g.chunk = n.chunk GROUP BY n.doc_id
"""

RUNS_SQL = r"""
WITH lines AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), each AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i FROM lines
), sized AS (
  SELECT *, strlen(line) + 1 AS size, sum(strlen(line) + 1) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM each
), runs AS (
  SELECT a.doc_id, a.i AS first, min(b.i) AS last FROM sized a JOIN sized b ON b.doc_id = a.doc_id AND b.i >= a.i
  WHERE b.upto - a.upto + a.size >= 50 GROUP BY a.doc_id, a.i
  UNION
  SELECT a.doc_id, max(b.i), a.i FROM sized a JOIN sized b ON b.doc_id = a.doc_id AND b.i <= a.i
  WHERE a.upto - b.upto + b.size >= 50 GROUP BY a.doc_id, a.i
), bodies AS (
  SELECT r.doc_id, first, last, string_agg(line, chr(10) ORDER BY i) AS body
  FROM runs r JOIN sized s ON s.doc_id = r.doc_id AND s.i BETWEEN first AND last GROUP BY ALL
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, first) AS copy FROM bodies
), gone AS (
  SELECT DISTINCT s.doc_id, i FROM numbered r JOIN sized s ON s.doc_id = r.doc_id AND i BETWEEN first AND last WHERE copy > 1
)
SELECT s.doc_id, coalesce(string_agg(line, chr(10) ORDER BY s.i) FILTER (g.i IS NULL), '') AS text,
       count(*)::BIGINT AS n_lines, (count(*) FILTER (g.i IS NULL))::BIGINT AS n_kept_lines
FROM sized s LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.i = s.i GROUP BY s.doc_id
"""


@query()
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_token_files(read_table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2)
    return read_token_files(manifest).select("doc_id", "start", "n_tokens", CRC("ids").alias("ids_crc32"))


@query()
def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_substrings(read_table(spark, sf_dir, "documents"), window=50)
    removed = (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed")
    return found.select("doc_id", "n_bytes", removed, F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return judge_urls(pages, mine_rules(pages, read_table(spark, sf_dir, "labels")))


@query(LINES_SQL)
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query(RUNS_SQL)
def op4_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_line_runs(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digest(read_table(spark, sf_dir, "documents"))


def packed_digest(docs: DataFrame) -> DataFrame:
    packed = pack(docs, tokenizer_path(), window=2048, end_id=1)
    pieces = packed.pieces.select("piece", "doc_id", "start", "length", CRC("ids").alias("ids_crc32"), "doc_tokens")
    return pieces.join(packed.places, "piece").drop("piece")


@query()
def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), words=3, percent=85)


@query()
def op7_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query()
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    rated = rate_quality(docs, fit_quality(docs, read_table(spark, sf_dir, "labels")))
    return rated.select("doc_id", "quality.*")


@query()
def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{kind}')) as bigint)").alias(f"n_{kind}") for kind in KINDS]
    base = joined_spans(F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS)))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), joined_spans(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def joined_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query()
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert all documents, replay that batch, delete repeats of a text, revise the rest to counts with an end id, and insert the rest under a
    second version that counts none. A document's repeats have the same text and a greater doc_id."""
    counts = stored(count_tokens(read_table(spark, sf_dir, "documents"), tokenizer_path()), "counts")
    totals = TokenTotals(spark, new_work_path(spark, "token-totals"))
    for name, changes in token_batches(counts):
        totals.commit(name, changes)
    return totals.totals()


def token_batches(counts: DataFrame) -> list[tuple[str, DataFrame]]:
    first = counts.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    # Joined by text and document, so a text that many documents have is many keys.
    marked = stored(counts.join(first, ["digest", "doc_id"], "left"), "marked").filter("doc_id is not null")
    kept, repeats = marked.filter("is_first"), marked.filter("is_first is null")

    def changes(rows: DataFrame, op: str, version: str, count: Column, old: Column) -> DataFrame:
        return rows.select(F.lit(op).alias("op"), "source", "lang", F.lit(version).alias("version"), count.alias("n_tokens"), old.alias("old_tokens"))

    n, none = F.col("n_tokens"), F.lit(None).cast("long")
    inserted = changes(counts, "insert", "bpe-1", n, none)
    return [
        ("insert", inserted),
        ("insert", inserted),
        ("delete", changes(repeats, "delete", "bpe-1", n, none)),
        ("revise", changes(kept, "revise", "bpe-1", n + 1, n)),
        ("bare", changes(kept, "insert", "bpe-1-bare", n, none)),
    ]


@query()
def op11_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(nearest.prepared(read_table(spark, sf_dir, "embeddings")), every=100, count=10)


@query()
def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_repair.damaged(read_table(spark, sf_dir, "conversations"))
    return conversation_repair.repair(rows, keep_text=False).drop("repaired")


NEGATIVES_SQL = """
WITH numbers AS (
  SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM numbers a JOIN numbers b ON b.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
), negatives AS (
  SELECT p.anchor_id, positive_id, (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.other))::INTEGER AS rank,
         n.other AS negative_id, positive_score, n.score AS negative_score
  FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
  WHERE 80 * positive_score <= 100 * n.score AND n.score <= positive_score
)
SELECT * FROM negatives WHERE rank <= 5
"""


@query(NEGATIVES_SQL)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(hard_negatives.prepared(rows.withColumn("label", moved)))


@query()
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
