"""Listing input files, choosing among them, reading their contents."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemill.functions import base_name, content_hash


_SCHEME = "^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?"


def _index(spark: SparkSession, folder: str) -> DataFrame:
    # Recursive lookup keeps Spark from taking subfolders for partitions; the files in them are left out below.
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)


def lies_in(path: Column, folder: str) -> Column:
    """Whether the file at ``path`` lies directly in ``folder``; scheme and host may be missing from either."""
    place = re.sub(_SCHEME, "", folder).rstrip("/")
    if not place.startswith("/"):
        place = os.path.abspath(place)
    return F.regexp_replace(path, f"{_SCHEME}|/[^/]*$", "") == place


def _is_in(url: Column, folder: str) -> Column:
    return lies_in(F.url_decode(F.replace(url, F.lit("+"), F.lit("%2B"))), folder)


def is_hidden(file_name: Column) -> Column:
    """Whether Spark's scans pass over a file for its name."""
    return file_name.rlike("^[_.]")


def with_hidden_files(files: DataFrame, folder: str) -> DataFrame:
    """Adds the files whose names begin with _ or a dot, without their contents; tasks open them by path.

    Only names of that kind are asked for, so what comes to the driver does not grow with the other files.
    """
    spark = files.sparkSession
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(glob_literal(folder.rstrip("/")) + "/[_.]*")
    found = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place) or []
    rows = [(s.getPath().toString(), s.getPath().getName(), s.getLen(), b"" if s.getLen() == 0 else None) for s in found if s.isFile()]
    if not rows:
        return files
    hidden = spark.createDataFrame(rows, "path string, file_name string, length long, content binary")
    return files.unionByName(hidden, allowMissingColumns=True)


def glob_literal(path: str) -> str:
    """``path`` for readers that take patterns."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files directly in ``folder``. Contents are only read by queries that use ``content``.

    The condition on the metadata prunes the files of subfolders when they are listed, before anything is read.
    """
    return (
        _index(spark, folder)
        .filter(_is_in(F.col("_metadata.file_path"), folder))
        .select("path", base_name("path").alias("file_name"), "modificationTime", "length", "content")
    )


def with_empty_files(files: DataFrame, folder: str) -> DataFrame:
    """Adds the files of zero bytes, which Spark's scans leave out but its file index knows."""
    spark = files.sparkSession
    urls = spark.createDataFrame([(p,) for p in _index(spark, folder).inputFiles()], "url string")
    names = urls.filter(_is_in(F.col("url"), folder)).select(
        F.url_decode(F.replace("url", F.lit("+"), F.lit("%2B"))).alias("path")
    )
    empty = names.withColumn("file_name", base_name("path")).join(files.select("file_name"), "file_name", "left_anti")
    return files.unionByName(
        empty.select("path", "file_name", F.lit(0).cast("bigint").alias("length"), F.lit(b"").alias("content")),
        allowMissingColumns=True,
    )


def parse_targets(targets: str | None) -> list[str]:
    """Names in a comma-separated list, trimmed, without empty ones."""
    return [name.strip() for name in (targets or "").split(",") if name.strip()]


def only_targets(files: DataFrame, targets: str | None, name_column: str = "file_name") -> DataFrame:
    """Files whose name is in the list; all of them when the list is empty."""
    names = parse_targets(targets)
    return files.filter(F.col(name_column).isin(*names)) if names else files


def hash_files(files: DataFrame) -> DataFrame:
    """Path, name, length and SHA-256 of each file."""
    return files.select("path", "file_name", "length", content_hash("content").alias("content_hash"))
