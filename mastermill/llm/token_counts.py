"""Token counts by source, language and tokenizer version, kept up to date by signed changes.

A change inserts or deletes a document with its count, or revises a count. A batch of changes is summed to one signed row per
group before it is stored, so a commit's size depends on the number of groups. Totals are the sums over all committed batches.

A batch is committed once: its folder carries the batch's name and the attempt's own. Only folders with Spark's success mark count, and of
several attempts of one batch (a retry after a lost driver, two writers at once) every reader takes the first by name, so repeating a batch changes nothing.
``compact`` folds the committed batches into one row set that remembers their names; it is a call of its own.

Defined results: null sources, languages and versions are groups of their own. A null count counts as zero; a null or unknown operation
raises an error, for it can be neither counted nor left out. An empty batch is committed and changes nothing. Groups whose totals are zero are
not listed. Other columns are not read.
"""

from __future__ import annotations

import json
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tokens import encoder

GROUP = ("source", "lang", "version")
SCHEMA = "source string, lang string, version string, n_docs long, n_tokens long"
FOLDED = "folded-"
_NAME = re.compile(r"batch=([0-9a-z-]+)~([0-9a-f]+)$")


def count_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id``, ``source``, ``lang``, the MD5 ``digest`` of the text, and ``n_tokens``; null texts have no tokens."""

    def count(batches):
        encode = encoder(tokenizer)
        for batch in batches:
            sizes = []
            for at in range(0, batch.num_rows, 500):
                sizes += [len(x) for x in encode.encode([x or "" for x in batch.slice(at, 500).column(0).to_pylist()])]
            yield batch.select(range(1, batch.num_columns)).append_column("n_tokens", pa.array(sizes, pa.int64()))

    rows = docs.select("text", "doc_id", "source", "lang", F.md5(F.coalesce("text", F.lit(""))).alias("digest"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(count, ", ".join(f"{c} {kinds[c]}" for c in ("doc_id", "source", "lang", "digest")) + ", n_tokens long")


class TokenTotals:
    """The store at ``path``, a folder that Spark reads and writes."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Commit ``changes`` (``op`` insert, delete or revise; the group; ``n_tokens``; ``old_tokens`` of revisions) under the
        name ``batch``; False if that batch is committed already."""
        if not re.fullmatch("[0-9a-z-]+", batch):
            raise ValueError("a batch is named with digits, lower-case letters and hyphens")
        if batch.startswith(FOLDED):
            raise ValueError(f"names that begin with {FOLDED} are kept for folded batches")
        live, folded = self._state()
        if batch in folded or any(name == batch for name, _ in live):
            return False
        count, old = (F.coalesce(F.col(c).cast("long"), F.lit(0)) for c in ("n_tokens", "old_tokens"))
        wrong = F.raise_error(F.concat(F.lit("unknown operation "), F.coalesce("op", F.lit("null"))))
        docs = F.when(F.col("op") == "insert", 1).when(F.col("op") == "delete", -1).when(F.col("op") == "revise", 0).otherwise(wrong)
        tokens = F.when(F.col("op") == "insert", count).when(F.col("op") == "delete", -count).when(F.col("op") == "revise", count - old)
        sums = changes.groupBy(*GROUP).agg(F.sum(docs).alias("n_docs"), F.sum(tokens).alias("n_tokens"))
        sums.write.parquet(f"{self.path}/batch={batch}~{uuid.uuid4().hex}")
        return True

    def totals(self) -> DataFrame:
        """The groups with their documents and tokens."""
        return self._sums(self._state()[0])

    def _sums(self, live: list[tuple[str, str]]) -> DataFrame:
        if not live:
            return self.spark.createDataFrame([], SCHEMA)
        rows = self.spark.read.schema(SCHEMA).option("basePath", self.path).parquet(*[f"{self.path}/batch={a}~{b}" for a, b in live])
        sums = rows.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.filter("n_docs <> 0 or n_tokens <> 0")

    def compact(self) -> None:
        """Fold all committed batches into one; what was folded stays known and counts no longer by itself.

        The names and the sums are those of one listing, so a batch committed meanwhile counts by itself.
        """
        live, folded = self._state()
        names = sorted(folded | {a for a, _ in live if not a.startswith(FOLDED)})
        target = f"{self.path}/batch={FOLDED}{len(names):012d}~{uuid.uuid4().hex}"
        self.spark.createDataFrame([(json.dumps(names),)], "names string").coalesce(1).write.json(f"{target}-names".replace("batch=", "names="))
        self._sums(live).write.parquet(target)

    def _state(self) -> tuple[list[tuple[str, str]], set[str]]:
        """The folders (batch, attempt) that count now, and the names that the greatest fold holds."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        system = root.getFileSystem(conf)
        if not system.exists(root):
            return [], set()
        first: dict[str, str] = {}
        for status in system.listStatus(root):
            found = _NAME.search(status.getPath().getName())
            if found and system.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                first[found[1]] = min(found[2], first.get(found[1], found[2]))
        folds = [n for n in first if n.startswith(FOLDED)]
        if not folds:
            return sorted(first.items()), set()
        fold = max(folds)
        names = self.spark.read.schema("names string").json(f"{self.path}/names={fold}~{first[fold]}-names").first().names
        known = set(json.loads(names))
        return sorted((n, a) for n, a in first.items() if n == fold or not n.startswith(FOLDED) and n not in known), known
