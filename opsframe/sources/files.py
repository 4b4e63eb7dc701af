"""Files as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_files_binary(
    spark: SparkSession,
    path: str | list[str],
    glob: str | None = None,
    recursive: bool = True,
) -> DataFrame:
    """One row ``path, modificationTime, length, content`` per file. A path
    that does not exist is an error."""
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def list_files(
    spark: SparkSession,
    path: str | list[str],
    glob: str | None = None,
    recursive: bool = True,
) -> DataFrame:
    """Path, size and time of the files under a path, without directory
    placeholders. File contents are not read."""
    files = read_files_binary(spark, path, glob, recursive)
    return files.select("path", "length", "modificationTime")
