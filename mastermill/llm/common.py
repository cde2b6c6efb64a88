"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import shutil
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from mastermill.session import new_work_path

MIX_A, MIX_B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
SHIFT = np.uint64(32)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared work folder and read back: no lineage, nothing kept on executors only."""
    path = new_work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Give the workers this package, once per Spark context, as ``--py-files`` would."""
    sc = spark.sparkContext
    if getattr(sc, "_mastermill_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="mastermill-package-")  # on the driver, which serves the file
    root, name = os.path.split(package)
    sc.addPyFile(shutil.make_archive(os.path.join(folder, name), "zip", root, name))
    sc._mastermill_shipped = True


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns that would clash with ``names``, whatever their case."""
    taken = {n.lower() for n in names}
    return df.select(*[quoted(c) for c in df.columns if c.lower() not in taken])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI as Python opens it, and the path there."""
    return fs.FileSystem.from_uri("s3://" + path.removeprefix("s3a://") if path.startswith("s3a://") else path)


class SideTable:
    """Rows of a table that Spark wrote by part, read by the task that holds the part."""

    def __init__(self, df: DataFrame, label: str):
        self.path = new_work_path(df.sparkSession, label)
        df.repartition("part").write.partitionBy("part").parquet(self.path)

    def rows(self, part: int) -> pa.Table | None:
        system, name = opened(f"{self.path}/part={part}")
        if system.get_file_info(name).type != fs.FileType.Directory:
            return None
        return pq.ParquetDataset(name, filesystem=system, partitioning=None).read()


def mixed(h: np.ndarray) -> np.ndarray:
    """Finish 64-bit hashes so that all bits depend on all bits."""
    h = (h ^ (h >> SHIFT)) * MIX_A
    h = (h ^ (h >> SHIFT)) * MIX_B
    return h ^ (h >> SHIFT)


def word_ids(words: list) -> tuple[np.ndarray, dict]:
    """The words as numbers of their first appearance, and the numbers by word."""
    seen: dict = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words)), seen
