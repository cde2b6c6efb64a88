"""Small text files of the driver on any file system that Spark reaches."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, location: str):
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(sc._jsc.hadoopConfiguration()), path


def _is(error: Py4JJavaError, *kinds: str) -> bool:
    return error.java_exception.getClass().getSimpleName() in kinds


def exists(spark: SparkSession, location: str) -> bool:
    system, path = _open(spark, location)
    return system.exists(path)


def names(spark: SparkSession, location: str) -> list[str]:
    """The names in a folder; none when it does not exist."""
    system, path = _open(spark, location)
    return sorted(s.getPath().getName() for s in system.listStatus(path)) if system.exists(path) else []


def delete(spark: SparkSession, location: str) -> None:
    system, path = _open(spark, location)
    system.delete(path, True)


def move(spark: SparkSession, location: str, target: str) -> None:
    """Give a file or folder another name, where none may be yet."""
    system, path = _open(spark, location)
    goal = _open(spark, target)[1]
    system.mkdirs(goal.getParent())
    if not system.rename(path, goal):
        raise OSError(f"cannot move {location} to {target}")


def read_text(spark: SparkSession, location: str) -> str | None:
    """The text of a file; ``None`` when there is none."""
    system, path = _open(spark, location)
    try:
        stream = system.open(path)
    except Py4JJavaError as error:
        if _is(error, "FileNotFoundException"):
            return None
        raise
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, location: str, text: str) -> None:
    """Write a file, replacing one of that name."""
    system, path = _open(spark, location)
    stream = system.create(path, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def write_new(spark: SparkSession, location: str, text: str) -> bool:
    """Create a file that did not exist, whole or not at all; False if another writer was first.

    The text is written under a name of its own and then takes its place in one step that fails when the place is taken: a hard link on a
    local file system, a rename without overwriting elsewhere. The file system must do that atomically, as HDFS does; so must
    the connector of an object store.
    """
    own = f"{location.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    write_text(spark, own, text)
    try:
        return _linked(spark, own, location) if _open(spark, own)[0].getScheme() == "file" else _renamed(spark, own, location)
    finally:
        delete(spark, own)


def _linked(spark: SparkSession, own: str, location: str) -> bool:
    jvm = spark.sparkContext._jvm
    source, target = (jvm.java.io.File(_open(spark, p)[1].toUri().getPath()).toPath() for p in (own, location))
    try:
        jvm.java.nio.file.Files.createLink(target, source)
        return True
    except Py4JJavaError as error:
        if _is(error, "FileAlreadyExistsException"):
            return False
        raise


def _renamed(spark: SparkSession, own: str, location: str) -> bool:
    sc = spark.sparkContext
    source, target = (_open(spark, p)[1] for p in (own, location))
    kind = getattr(sc._jvm.org.apache.hadoop.fs, "Options$Rename")
    plain = sc._gateway.new_array(kind, 1)
    plain[0] = kind.NONE
    try:
        sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), sc._jsc.hadoopConfiguration()).rename(source, target, plain)
        return True
    except Py4JJavaError as error:
        if _is(error, "FileAlreadyExistsException"):
            return False
        raise
