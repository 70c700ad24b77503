"""Numbered folders on whatever file system a path names."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, path: str) -> list[str]:
    """Entries of a folder; none if there is no such folder."""
    files, place = _at(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def names_below(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Names of the entries below a folder that a pattern fits."""
    files, place = _at(spark, f"{path}/{pattern}")
    return [s.getPath().getName() for s in files.globStatus(place) or ()]


def numbers(spark: SparkSession, path: str, key: str) -> list[int]:
    """The N of all entries ``key=N``, in order."""
    found = (name.partition("=") for name in names(spark, path))
    return sorted(int(n) for k, _, n in found if k == key and n.isdigit())


def make(spark: SparkSession, path: str) -> None:
    files, place = _at(spark, path)
    files.mkdirs(place)


def remove(spark: SparkSession, path: str) -> None:
    files, place = _at(spark, path)
    files.delete(place, True)


def moved(spark: SparkSession, source: str, target: str) -> bool:
    """Move a folder to a name that must be free; False if it was taken."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    old, new = hadoop.Path(source), hadoop.Path(target)
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    place = hadoop.FileContext.getFileContext(_at(spark, source)[0].getUri(), spark._jsc.hadoopConfiguration())
    try:
        place.rename(old, new, options)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True
