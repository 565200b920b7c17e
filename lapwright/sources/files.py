"""A few file-system questions, asked through Hadoop so that any store answers."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, location: str):
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(context._jsc.hadoopConfiguration())


def exists(spark: SparkSession, location: str) -> bool:
    path, system = _path(spark, location)
    return system.exists(path)


def child_names(spark: SparkSession, location: str) -> list[str]:
    """Names directly under a folder; none if there is no such folder."""
    path, system = _path(spark, location)
    if not system.exists(path):
        return []
    return [status.getPath().getName() for status in system.listStatus(path)]


def read_text(spark: SparkSession, location: str) -> str:
    """A small text file."""
    path, system = _path(spark, location)
    stream = system.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, location: str, text: str) -> None:
    """Write a small text file under a name that is not taken; it appears as a whole or not at all."""
    path, system = _path(spark, location)
    hidden = path.getParent().suffix(f"/_{path.getName()}-{uuid.uuid4().hex}")
    stream = system.create(hidden, False)
    try:
        stream.write(text.encode("utf-8"))
    finally:
        stream.close()
    if not system.rename(hidden, path):
        system.delete(hidden, False)
        raise FileExistsError(location)


def usage(spark: SparkSession, location: str) -> tuple[int, int]:
    """Bytes and number of the files under a folder."""
    path, system = _path(spark, location)
    summary = system.getContentSummary(path)
    return summary.getLength(), summary.getFileCount()


def newest(spark: SparkSession, location: str) -> int:
    """Latest modification time of what lies directly under a folder, in milliseconds; 0 if nothing does."""
    path, system = _path(spark, location)
    if not system.exists(path):
        return 0
    return max((status.getModificationTime() for status in system.listStatus(path)), default=0)


def has_visible_files(spark: SparkSession, location: str) -> bool:
    """Whether a folder holds anything that Spark would read."""
    return any(not n.startswith(("_", ".")) for n in child_names(spark, location))


def delete(spark: SparkSession, location: str) -> None:
    path, system = _path(spark, location)
    system.delete(path, True)
