import pytest
from pyspark.sql import functions as F

from sievemill import functions as fn
from sievemill.operators import load, normalize, outcomes, quality
from sievemill.registry import ColumnSpec, SchemaSpec, build_registry


def values(spark, texts, make):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", make("t").alias("v")).orderBy("i").collect()]


def test_numbers(spark):
    texts = [" 15 ", "1e3", "+5", "5.", ".5", "-0.5", "1_000", "0x10", "1.5d", "1,500", "nan", "inf", "Infinity", "", None, "1 5", "٣"]
    assert values(spark, texts, fn.coerce_numeric) == [15.0, 1000.0, 5.0, 5.0, 0.5, -0.5] + [None] * 11


def test_integers(spark):
    texts = ["100", "100.0", "1e2", "1.5", "9007199254740993", "9223372036854775807", "9223372036854775808", "1e30", " 7 ", "x"]
    assert values(spark, texts, fn.coerce_integer) == [
        100, 100, 100, None, 9007199254740993, 9223372036854775807, None, None, 7, None,
    ]


def test_dates(spark):
    got = values(spark, ["2023/12/1", "2023/12/01", "2023-1-2", "2023/13/1", "x", None, " 2023/1/2 "], fn.parse_date)
    assert [str(d) if d else None for d in got] == ["2023-12-01", "2023-12-01", "2023-01-02", None, None, None, "2023-01-02"]


def test_volume_cleaning(spark):
    clean = lambda c: fn.clean_value(c, ["null_tokens", "thousands", "numeric"])
    assert values(spark, ["1,234", " -- ", "　", "nan", "abc", "-5", " 12 "], clean) == ["1234", None, None, None, None, "-5", "12"]
    with pytest.raises(ValueError, match="unknown cleaning step"):
        fn.clean_value("t", ["round"])


def test_csv_fields(spark):
    long = '"' + 'x""y' * 50_000 + '",z'
    texts = ["a,b,c,", ",x,", '"a,b","c""d",e', '"multi\nline",2', '"ab"cd,1', '5"x,1', "", '""', '"",""', long]
    got = values(spark, texts, fn.csv_fields)
    assert got[:-1] == [
        ["a", "b", "c", ""], ["", "x", ""], ["a,b", 'c"d', "e"], ["multi\nline", "2"], ["abcd", "1"], ['5"x', "1"], [""], [""], ["", ""],
    ]
    assert got[-1] == ['x"y' * 50_000, "z"]


def test_local_iso_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 18:30:00.5' AS a, timestamp_ntz'2024-01-01 00:00:00' AS b")
        row = df.select(fn.local_iso("a").alias("a"), fn.local_iso("b", "America/St_Johns").alias("b")).first()
        assert tuple(row) == ("2024-03-11T02:30:00.500000+08:00", "2023-12-31T20:30:00-03:30")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


RULES = {"a": {"non_null": True}, "b": {"min_value": 0, "max_value": 10.5}, "missing": {"non_null": True}, "c": {"non_null": False}}


def test_rules_on_typed_and_text_columns(spark):
    rows = [(None, -1.0, None), ("x", float("nan"), ""), ("x", 0.0, "y"), ("", 11.0, "y")]
    df = spark.createDataFrame(rows, "a string, b double, c string")
    reasons = [r[quality.REASON] for r in quality.with_reasons(df, RULES).collect()]
    assert reasons == [
        "Column 'a': is null; Column 'b': is less than 0", None, None, "Column 'b': is greater than 10.5",
    ]
    text = spark.createDataFrame([("10",), ("abc",), ("-5",), ("20",), ("xyz",), ("0",), (None,)], "v string")
    valid, bad = quality.split_rows(text, {"v": {"min_value": 0}}, "f.csv")
    assert sorted(r.v or "" for r in valid.collect()) == ["", "0", "10", "20"]
    assert {(r.v, r.quarantine_reason, r.source_file) for r in bad.collect()} == {
        ("abc", "Column 'v': failed numeric conversion for range check", "f.csv"),
        ("xyz", "Column 'v': failed numeric conversion for range check", "f.csv"),
        ("-5", "Column 'v': is less than 0", "f.csv"),
    }


def test_no_rules_and_empty_input(spark):
    df = spark.createDataFrame([], "a string")
    valid, bad = quality.split_rows(df, {}, "f")
    assert valid.columns == ["a"] and bad.columns == ["a", "quarantine_reason", "source_file"] and bad.count() == 0


def test_last_alias_wins_and_canonical_names_pass(spark):
    spec = SchemaSpec("s", "s", (ColumnSpec("a", aliases=("X", "y")), ColumnSpec("b", aliases=("x",))))
    assert spec.header_names() == {"a": ["a", "y"], "b": ["b", "x"]}
    df = spark.createDataFrame([("1", "2", "3", "4")], ["A ", " X", "Y", "rest"])
    assert normalize.rename_by_alias(df, spec).collect()[0].asDict() == {"a": "1", "b": "2", "rest": "4"}


def test_two_headers_for_one_column_take_the_first_usable_value(spark):
    spec = SchemaSpec("s", "s", (ColumnSpec("a", aliases=("x", "y")), ColumnSpec("b")))
    df = spark.createDataFrame([(["y", "x", "b"], ["2", "NA", "3"]), (["y", "x", "b"], ["2", "1", ""]), (["b"], ["5"])], "h array<string>, f array<string>")
    placed = df.select("f", normalize.header_positions("h", spec).alias("p"))
    assert [tuple(r) for r in normalize.canonical_columns(placed, "f", "p", spec).collect()] == [("2", "3"), ("1", None), (None, "5")]


def test_schema_order_decides(spark):
    registry = build_registry()
    texts = ["商品名稱 2023", "x DAILY x", "nothing here"]
    assert values(spark, texts, lambda c: normalize.match_schema(c, registry)) == ["weekly_report", "default_daily", "default_daily"]
    none = build_registry(fallback=None)
    assert values(spark, texts, lambda c: normalize.match_schema(c, none))[-1] is None


KEYED = "k1 string, k2 double, v int"


def test_insert_if_absent_matches_brute_force(spark):
    target = [("a", 1.0, 0), (None, 2.0, 1), ("b", None, 2), ("c", 0.0, 3)]
    batch = [("a", 1.0, 10), ("a", None, 11), ("a", None, 12), (None, 2.0, 13), (None, None, 14), ("", 0.0, 15), ("c", -0.0, 16), ("b", 0.0, 17)]
    got = load.insert_if_absent(spark.createDataFrame(target, KEYED), spark.createDataFrame(batch, KEYED), ["k1", "k2"], ["v"])
    table = {(k1, k2): v for k1, k2, v in target}
    for k1, k2, v in batch:
        table.setdefault((k1, k2), v)
    assert sorted(r.v for r in got.collect()) == sorted(table.values())
    got = load.insert_or_replace(spark.createDataFrame(target, KEYED), spark.createDataFrame(batch, KEYED), ["k1", "k2"], ["v"])
    table = {(k1, k2): v for k1, k2, v in [*target, *batch]}
    assert sorted(r.v for r in got.collect()) == sorted(table.values())


def test_one_key_with_most_rows(spark):
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("v")
    )
    got = load.first_per_key(rows, ["k"], ["v"])
    assert got.count() == 1 + 200_000 - len(range(0, 200_000, 3))
    assert got.filter("k = 'hot'").first().v == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan  # pruned before the shuffle


def test_statistics_and_allowed_tables(spark):
    batch = spark.createDataFrame([("a", 1.0, 1), ("a", 1.0, 2), ("b", 1.0, 3)], KEYED)
    new = load.rows_to_insert(batch.limit(0), batch, ["k1", "k2"], ["v"])
    assert load.load_statistics(batch, new).first().asDict() == {"rows_in_source": 3, "rows_inserted": 2, "rows_skipped": 1}
    assert load.load_statistics(batch.limit(0), new.limit(0)).first().asDict() == {"rows_in_source": 0, "rows_inserted": 0, "rows_skipped": 0}
    assert build_registry().table_names == ["fact_weekly_report", "fact_daily_ohlc", "quarantine_data"]


@pytest.mark.parametrize(
    "states, expected",
    [
        ([], "SUCCESS"),
        ([("success", 0)], "SUCCESS"),
        ([("success", 2)], "PARTIAL_SUCCESS"),
        ([("success", 0), ("error", 0)], "PARTIAL_SUCCESS"),
        ([("error", 0)], "FAILURE"),
        ([("skipped", 0)], "UNKNOWN"),
    ],
)
def test_run_status(spark, states, expected):
    rows = [(s, 1, 1, q, 0) for s, q in states]
    files = spark.createDataFrame(rows, "status string, rows_source long, rows_inserted long, rows_quarantined long, rows_skipped long")
    assert outcomes.run_counters(files).select(outcomes.run_status().alias("s")).first().s == expected
