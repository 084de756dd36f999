"""Tables whose columns are called as the operators call theirs inside; and the whole pipeline over awkward rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_rows import CLASHING, LONG, ROWS
from sievemill.llm import line_dedup, mixing, quality_rules, simhash, substring_dedup

#: Every name that operators and stages give to columns of their own, and one with a dot.
INNER = "_bitmap_of _bitmap _lines _intervals_of _intervals _kept _order _pattern _plan _mix _copy _own _stay _toxicity _both _id _tid _host _h a.b".split()


@pytest.fixture(scope="module")
def clashing(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clashing") / "documents.parquet")
    schema = "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in INNER)
    spark.createDataFrame([(*r, *[f"own {c}" for c in INNER]) for r in ROWS], schema).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def rows(df, *columns):
    return Counter(tuple(map(str, r)) for r in df.select(*columns).collect())


OPERATORS = {
    "_lines": line_dedup.drop_repeated_lines,
    "_kept": lambda d: substring_dedup.remove_repeats(d, window=5),
    "_mix": lambda d: mixing.mix(d, F.array("source"))[0],
}


@pytest.mark.parametrize("out", OPERATORS)
def test_results_take_the_place_of_their_name_and_no_other(out, clashing):
    plain, found = OPERATORS[out](clashing.select("doc_id", "text", "source")), OPERATORS[out](clashing)
    assert found.columns == [c for c in clashing.columns if c != out] + [out]
    assert rows(found, "doc_id", "text", out) == rows(plain, "doc_id", "text", out)
    left = [c for c in INNER if c != out]
    assert {tuple(r) for r in found.select(*[f"`{c}`" for c in left]).collect()} == {tuple(f"own {c}" for c in left)}


def test_one_row_of_each_group_keeps_its_columns(clashing):
    found, plain = simhash.one_of_each_group(clashing), simhash.one_of_each_group(clashing.select("doc_id", "text", "source"))
    assert found.columns == clashing.columns
    assert rows(found, "doc_id", "text") == rows(plain, "doc_id", "text")
    assert {r._own for r in found.collect()} == {"own _own"}


def test_rules_of_clashing_names(clashing):
    plain = quality_rules.judged(clashing.select("doc_id", "text", "source"))
    assert rows(quality_rules.judged(clashing), *plain.columns) == rows(plain, *plain.columns)


def test_names_in_upper_case(spark, clashing):
    docs = clashing.select("doc_id", "text", "source", F.col("_own").alias("_OWN"), F.col("_mix").alias("_MIX"), F.col("_plan").alias("_Plan"))
    assert mixing.mix(docs, F.array("source"))[0].columns == ["doc_id", "text", "source", "_OWN", "_Plan", "_mix"]
    assert simhash.one_of_each_group(docs).columns == docs.columns


def folder(spark, path, rows_):
    """The tables that the pipeline reads: documents of awkward rows and clashing names, and no labels."""
    extra = [*dict.fromkeys([*INNER, *CLASHING])]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in extra)
    data = [(i, t, None, s, None if t is None else len(t), *["own"] * len(extra)) for i, t, s in rows_]
    spark.createDataFrame(data, schema).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_the_pipeline_over_awkward_rows(spark, tmp_path):
    sf = folder(spark, tmp_path, ROWS)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.written(stage(spark, docs, sf))
        assert after.columns == docs.columns, name
        if name != "mixing sources to target weights":  # where the target of its source decides
            assert after.where(F.col("text") == LONG).count() > 0
        docs = after
    found = corpus_pipeline.run(spark, sf).collect()
    assert Counter(r.doc_id for r in found) == Counter(r.doc_id for r in docs.collect())
    assert all(r.n_tokens == len(r.ids) for r in found)


def test_the_pipeline_over_nothing(spark, tmp_path):
    assert corpus_pipeline.run(spark, folder(spark, tmp_path, [])).collect() == []
