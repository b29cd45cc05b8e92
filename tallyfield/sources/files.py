"""Folders and small files of the tables' file system, through Spark's own handle: no local path is opened."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _at(spark, path)
    return system.exists(place)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    system, place = _at(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; an error if ``target`` exists or ``source`` does not."""
    system, place = _at(spark, target)
    system.mkdirs(place.getParent())
    if system.exists(place) or not system.rename(_at(spark, source)[1], place):
        raise FileExistsError(f"could not move {source} to {target}")


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole: written aside, then renamed; an error if it is there already."""
    system, place = _at(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f"_{place.getName()}.{spark._jvm.java.util.UUID.randomUUID()}")
    out = system.create(aside, False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    kind = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark._sc._gateway.new_array(kind, 1)
    options[0] = kind.NONE  # renaming onto a file that exists is refused: of two writers one learns that it lost
    context.rename(aside, place, options)


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]
