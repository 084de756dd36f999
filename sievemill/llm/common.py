"""What the operators share: tables, words, ASCII lower-casing, written intermediate tables."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemill.session import shared_folder

#: Fixed value: what separates words, space and the controls from tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """``names``, with so many underscores in front that no column of ``docs`` is called so, in whatever case."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def columns_but(docs: DataFrame, *names: str) -> list[str]:
    """The columns of ``docs``, quoted, but for those called one of ``names`` in whatever case."""
    left_out = {n.lower() for n in names}
    return ["`" + c.replace("`", "``") + "`" for c in docs.columns if c.lower() not in left_out]


def scratch_path(spark: SparkSession) -> str:
    """A new path in the folder that all executors share, by application; the folder may go when the application has ended."""
    home = shared_folder(spark, spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch")
    return f"{home}/llm-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The same rows, read from a table in the shared folder: lineage ends there, and lost executors cost no recomputation."""
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else. Texts of ASCII alone, told by their length in bytes, take the faster function."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, tid): null texts are empty; ``tid`` tells apart rows that share an id but not their text.

    Only these columns are taken along, so other columns of ``docs`` cannot clash with an operator's own.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tid"))


def once(make: Callable, *args):
    """``make(*args)``, worked out once in a process. Functions travel by value, so a task finds no module that could keep it."""
    known = vars(sys).setdefault("_sievemill_once", {})
    key = (make.__module__, make.__qualname__, args)
    if key not in known:
        known[key] = make(*args)
    return known[key]


def word_list(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8: runs of anything but SPACES, which is how bytes are split."""
    return (text or "").encode("utf-8", "surrogatepass").split()
