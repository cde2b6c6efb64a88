"""Training-text pipeline over ``documents``: quality, line dedup, near-dedup, decontamination, packing.

Each stage works on all rows its predecessor kept, which were written as Parquet and read again. All but the last
return the columns of ``documents``. ``ORACLE_SQL`` is None: SQL can express neither the fitted quality threshold nor the packing;
``tests/llm/test_pipeline.py`` holds the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mastermill.llm.common import quoted, read_table, ship_package, stored
from mastermill.llm.decontaminate import decontaminate
from mastermill.llm.line_dedup import dedup_lines
from mastermill.llm.near_dedup import near_duplicates
from mastermill.llm.quality import fit_quality, rate_quality

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    ship_package(spark)
    model = fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return rate_quality(docs, model).filter("quality.kept").select(*[quoted(c) for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go from the texts; a text that consisted of them alone goes whole. n_chars follows the text."""
    cut = dedup_lines(docs).filter("n_kept_lines > 0")
    n_chars = F.when(F.col("n_lines") != F.col("n_kept_lines"), F.length("text")).otherwise(F.col("n_chars")).alias("n_chars")
    return cut.select(*[n_chars if c == "n_chars" else F.col(quoted(c)) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest doc_id."""
    gone = near_duplicates(docs).filter("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents with their places in sequences of at most 2048 ids."""
    from mastermill.llm.queries import packed_digest

    return packed_digest(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
