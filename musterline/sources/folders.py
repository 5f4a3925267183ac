"""Names and small marks in folders, on any file system that Spark reaches."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def children(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder, hidden ones left out; none if it is missing. No file is opened."""
    system, place = _located(spark, path)
    if not system.exists(place):
        return []
    names = [status.getPath().getName() for status in system.listStatus(place)]
    return sorted(name for name in names if not name.startswith(("_", ".")))


def marks(spark: SparkSession, path: str) -> list[str]:
    """The hidden names below a folder, such as the mark of a finished write."""
    system, place = _located(spark, path)
    names = [status.getPath().getName() for status in system.listStatus(place)] if system.exists(place) else []
    return sorted(name for name in names if name.startswith(("_", ".")))


def remove(spark: SparkSession, path: str) -> None:
    system, place = _located(spark, path)
    system.delete(place, True)


def read_mark(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None if there is none."""
    system, place = _located(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def age_of(spark: SparkSession, path: str) -> float:
    """Seconds since a file was changed, by the clocks of its file system and of this machine."""
    system, place = _located(spark, path)
    now = spark._jvm.java.lang.System.currentTimeMillis()
    return max(0.0, (now - system.getFileStatus(place).getModificationTime()) / 1000)


def claim(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file unless it exists; False if it does.

    Of several callers exactly one gets True wherever creating without overwriting is atomic: on
    HDFS and local disks, and on object stores that support conditional writes.
    """
    system, place = _located(spark, path)
    system.mkdirs(place.getParent())
    jvm, data = spark._jvm, bytearray(text.encode())
    try:
        if system.getUri().getScheme() == "file":  # Hadoop's own check there is not atomic
            nio = jvm.java.nio.file
            options = spark.sparkContext._gateway.new_array(nio.OpenOption, 2)
            options[0], options[1] = nio.StandardOpenOption.CREATE_NEW, nio.StandardOpenOption.WRITE
            nio.Files.write(jvm.java.io.File(place.toUri().getPath()).toPath(), data, options)
        else:
            stream = system.create(place, False)
            stream.write(data)
            stream.close()
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True
