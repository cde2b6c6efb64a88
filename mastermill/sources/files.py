"""Extracts: selecting the day's files and reading them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import file_code, file_date

# The accepted file endings.
ACCEPTED_ENDINGS = (".csv", ".csv.gz")


def is_accepted(name: Column) -> Column:
    """Whether Spark can read the file as an extract: plain or gzip CSV."""
    accepted = F.lit(False)
    for ending in ACCEPTED_ENDINGS:
        accepted = accepted | name.endswith(ending)
    return accepted


def select_files(names: DataFrame, prefix: Column | str, day: date, name: str = "file_name") -> DataFrame:
    """File names that start with the entity prefix and contain the day as ``yyyymmdd``.

    Adds ``file_code``, ``file_date`` and ``accepted``.
    """
    column = F.col(name)
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    chosen = names.filter(column.startswith(prefix) & column.contains(day.strftime("%Y%m%d")))
    return chosen.withColumns(
        {"file_code": file_code(column), "file_date": file_date(column), "accepted": is_accepted(column)}
    )


def list_files(spark: SparkSession, directory: str, prefix: str = "") -> DataFrame:
    """``path`` and ``file_name`` of the files in a directory; file contents are never read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"{prefix}*").load(directory)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"))


def discover_files(spark: SparkSession, root: str, prefixes: Mapping[str, str], day: date) -> DataFrame:
    """The day's files of an entity in ``<root>/<region>``: region, path, name, code, date, accepted."""
    found = None
    for region, prefix in prefixes.items():
        listed = list_files(spark, f"{root.rstrip('/')}/{region}", prefix)
        part = select_files(listed, prefix, day).withColumn("region", F.lit(region))
        found = part if found is None else found.unionByName(part)
    return found


def require_accepted(files: DataFrame) -> DataFrame:
    """Raise when a selected file has an ending that is not an extract; encrypted archives are among these."""
    refused = [r["file_name"] for r in files.filter(~F.col("accepted")).select("file_name").orderBy("file_name").collect()]
    if refused:
        raise ValueError(f"unsupported file type ({len(refused)}): {', '.join(refused)}")
    return files


def read_extract(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """A headered comma-separated extract with every column as string."""
    return spark.read.csv(path if isinstance(path, str) else list(path), header=True, sep=",", inferSchema=False)


def is_empty(df: DataFrame) -> bool:
    """Whether there is no row; reads until the first one."""
    return not df.columns or df.isEmpty()
