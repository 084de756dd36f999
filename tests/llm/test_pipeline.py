"""The pipeline's stages, each on what the stage before it returned."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sievemill.llm.common import written
from test_dedup import components_expected, lines_expected

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The input of each stage and the last result."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF_DIR)))
    return out


def rows(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def test_columns(stages):
    assert all(df.columns == DOCUMENTS for df in stages[:-1])
    assert stages[-1].columns == ["doc_id", "lang", "source", "n_tokens", "ids", "decoded"]


def test_toxic_documents_go(spark, stages):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    left = stages[1].join(labels, "doc_id").groupBy("toxic").count().collect()
    before = {r.toxic: r["count"] for r in stages[0].join(labels, "doc_id").groupBy("toxic").count().collect()}
    after = {r.toxic: r["count"] for r in left}
    assert after.get(1, 0) <= 0.4 * before[1] and after[0] >= 0.97 * before[0]  # a few hundred labels teach this much


def test_shared_lines_go(stages):
    want = Counter((d, t) for d, _, _, t in lines_expected(rows(stages[1])))
    assert Counter((r.doc_id, r.text) for r in stages[2].collect()) == want
    assert all(r.n_chars == len(r.text) for r in stages[2].collect())


def test_one_of_each_group_stays(stages):
    want = {c for _, _, c in components_expected(rows(stages[2]))}
    assert Counter(d for d, _, _ in rows(stages[3])) == Counter(want)


def test_the_mix(stages):
    copies = Counter(rows(stages[4]))
    assert set(copies) <= set(rows(stages[3])) and max(copies.values()) <= 3


def test_ids(stages):
    library = Tokenizer.from_file(corpus_pipeline.VOCABULARY)
    want = Counter()
    for doc_id, text, _ in rows(stages[4]):
        ids = library.encode(text or "", add_special_tokens=False).ids
        want[doc_id, tuple(ids), library.decode(ids, skip_special_tokens=False)] += 1
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in stages[5].collect()) == want


def test_run_is_its_stages(spark, stages):
    key = lambda df: Counter((r.doc_id, tuple(r.ids)) for r in df.collect())
    assert key(corpus_pipeline.run(spark, SF_DIR)) == key(stages[-1])
