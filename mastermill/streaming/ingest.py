"""Incremental ingest: each file of a directory is loaded once, as it appears."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.keys import file_date
from ..plans.daily import ExtractFile, run_files
from ..plans.entity import RunOptions
from ..sources.files import is_accepted
from ..sources.tables import SnapshotStore
from ..spec import EntitySpec


def stream_rows(spark: SparkSession, directory: str, columns: Sequence[str], pattern: str = "*.csv") -> DataFrame:
    """Rows of new CSV files whose header is exactly ``columns``; every column is a string.

    A file with another header fails the batch instead of shifting values into the wrong columns.
    """
    schema = ", ".join(f"`{c}` string" for c in columns)
    reader = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
    return reader.option("pathGlobFilter", pattern).csv(directory)


def stream_files(spark: SparkSession, directory: str, prefix: str = "", max_files: int = 16) -> DataFrame:
    """Names of new files; the column pruning keeps their contents unread."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", f"{prefix}*")
        .option("maxFilesPerTrigger", max_files)
    )
    return reader.load(directory).select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"))


def ingest_stream(
    store: SnapshotStore,
    spec: EntitySpec,
    directory: str,
    checkpoint: str,
    region: str,
    options: RunOptions | None = None,
    dimensions: Mapping[str, DataFrame] | None = None,
    max_files: int = 256,
    trigger: Mapping[str, object] | None = None,
    fail_fast: bool = False,
) -> StreamingQuery:
    """Load every new extract of a region directory, the files of a micro-batch as one extract and one commit (:func:`run_files`).

    The stream carries file names, at most ``max_files`` per batch, because headers differ from file to file;
    the rows are read by the batch. Files of another type, unreadable ones and those whose header lacks a key are audited as failed and
    the others are loaded; with ``fail_fast`` that ends the stream. A batch may be delivered twice after a failure: files are skipped by name
    once they are published.
    """
    options = options or RunOptions()

    def load(batch: DataFrame, batch_id: int) -> None:
        name = F.col("file_name")
        chosen = batch.withColumns({"file_date": file_date(name), "accepted": is_accepted(name)})
        found = [ExtractFile(f["path"], f["file_name"], f["file_date"], f["accepted"]) for f in chosen.orderBy("file_name").collect()]
        run_files(store, spec, found, region, options, dimensions, fail_fast)

    files = stream_files(store.spark, directory, spec.files.get(region, ""), max_files)
    writer = files.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
