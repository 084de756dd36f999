import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests"), os.path.dirname(os.path.abspath(__file__))]

from llm_rows import CLASHING, ROWS  # noqa: E402


@pytest.fixture(scope="session")
def edges(spark, tmp_path_factory):
    """A Parquet table of awkward rows: nulls, empty and long texts, repeated rows, ties, columns of clashing names."""
    schema = "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in CLASHING)
    path = str(tmp_path_factory.mktemp("edges") / "documents.parquet")
    spark.createDataFrame([(*r, *["other"] * len(CLASHING)) for r in ROWS], schema).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def nothing(spark, edges, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("nothing") / "documents.parquet")
    edges.limit(0).write.parquet(path)
    return spark.read.schema(edges.schema).parquet(path)
