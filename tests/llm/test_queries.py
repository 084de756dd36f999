"""Registered queries: against SQL where there is some, and the contract of their columns."""

import os

import pytest

from oracle import connect, differences
from sievemill.llm import catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
COLUMNS = {
    1: {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    2: {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    3: {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    4: {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    5: {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    6: {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    7: {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    8: {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    9: {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    10: {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"},
    11: {"lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint", "r": "bigint", "n": "bigint", "score": "bigint"},
    12: {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"},
    13: {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
}


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in catalog.QUERIES) == [*range(1, 14)]


@pytest.mark.parametrize("name", sorted(name for name, (_, sql) in catalog.QUERIES.items() if sql))
def test_query_equals_sql(spark, name):
    query, sql = catalog.QUERIES[name]
    assert differences(spark, connect(SF_DIR), SF_DIR, query, sql) is None


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_columns_and_rows(spark, name):
    df = catalog.QUERIES[name][0](spark, SF_DIR)
    want = COLUMNS[int(name[2:].split("_")[0])]
    assert {c: t for c, t in df.dtypes if c in want} == want
    if "doc_id" not in want:
        return
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert sorted(r.doc_id for r in df.select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())
