import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sievemill import Warehouse, build_registry, load_registry
from sievemill.operators import outcomes
from sievemill.operators.amounts import amount_features, derive_table, preview
from sievemill.operators.versions import VersionLog
from sievemill.plans import catalog_sources
from sievemill.sources.files import list_files, only_targets, parse_targets, with_empty_files


def test_tables_are_created_from_the_declared_schema(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path), build_registry())
    assert not house.exists("fact_daily_ohlc")
    house.create("fact_daily_ohlc")
    assert house.exists("fact_daily_ohlc")
    assert dict(house.read("fact_daily_ohlc").dtypes)["volume"] == "bigint" and house.read("fact_daily_ohlc").count() == 0
    with pytest.raises(ValueError, match="not in the schema configuration"):
        house.read("somewhere_else")


def test_load_reads_only_the_periods_it_brings(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path), build_registry())
    rows = spark.sql(
        "SELECT make_date(2023, m, 1) trading_date, 'T' product_id, '' expiry_month, 1D strike_price, 'C' option_type, m row_no "
        "FROM (SELECT explode(sequence(1, 12)) m)"
    )
    house.append("fact_daily_ohlc", rows, "first")
    batch = rows.filter("row_no IN (3, 4)")
    plan = house.load_slice("fact_daily_ohlc", house.with_period(batch, "fact_daily_ohlc"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    scan = plan._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "isnotnull(load_period" in scan.split("PartitionFilters: [")[1].split("], ")[0] and "2023-03" in scan and "2023-04" in scan
    assert house.rows_to_insert("fact_daily_ohlc", batch, ["row_no"]).count() == 0
    # A stray date adds its own month to what is read, not all months between.
    stray = batch.filter("row_no = 3").unionByName(batch.filter("row_no = 4").withColumn("trading_date", F.lit("1900-01-01").cast("date")))
    part = house.load_slice("fact_daily_ohlc", house.with_period(stray, "fact_daily_ohlc"))
    assert {r.trading_date.month for r in part.collect()} == {3}
    house.replace("fact_daily_ohlc", batch, ["row_no"])
    assert house.read("fact_daily_ohlc").count() == 12
    with pytest.raises(ValueError, match="no key"):
        house.replace("fact_weekly_report", batch, ["row_no"])


def daily(spark, days, price=1.0, month=1):
    return spark.sql(
        f"SELECT make_date(2023, {month}, d) trading_date, 'T' product_id, '' expiry_month, 1D strike_price, 'C' option_type, "
        f"{price}D open_price, d row_no FROM (SELECT explode(sequence({days[0]}, {days[1]})) d)"
    )


def prices(house):
    column = "open_price" if "open_price" in house.read("fact_daily_ohlc").columns else house.read("fact_daily_ohlc").columns[5]
    return {(r.trading_date.month, r.trading_date.day): r[column] for r in house.read("fact_daily_ohlc").collect()}


def test_replace_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    house = Warehouse(spark, str(tmp_path), build_registry())
    price = house.schemas["fact_daily_ohlc"].names[5]
    name = lambda df: df.withColumnRenamed("open_price", price)
    house.append("fact_daily_ohlc", name(daily(spark, (1, 5))), "a")
    house.append("fact_daily_ohlc", name(daily(spark, (1, 3), month=2)), "b")
    before, reader = prices(house), house.read("fact_daily_ohlc")
    # A run that is killed between its write and its version changes nothing, and can be run again.
    with monkeypatch.context() as m:
        m.setattr(VersionLog, "commit", lambda self, version: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            house.replace("fact_daily_ohlc", name(daily(spark, (4, 7), 2.0)), ["row_no"])
    assert prices(house) == before
    house.replace("fact_daily_ohlc", name(daily(spark, (4, 7), 2.0)), ["row_no"])
    want = before | {(1, d): 2.0 for d in range(4, 8)}
    assert prices(house) == want
    assert {(r.trading_date.month, r.trading_date.day): r[price] for r in reader.collect()} == before  # one version from begin to end
    house.replace("fact_daily_ohlc", name(daily(spark, (4, 4), 3.0)), ["row_no"])
    house.append("fact_daily_ohlc", name(daily(spark, (9, 9), 5.0)), "c")
    assert prices(house) == want | {(1, 4): 3.0, (1, 9): 5.0}


def test_the_later_of_two_writers_takes_account_of_the_earlier(spark, tmp_path):
    table = "fact_daily_ohlc"
    one, two, three = (Warehouse(spark, str(tmp_path), build_registry()) for _ in range(3))
    price = one.schemas[table].names[5]
    name = lambda df: df.withColumnRenamed("open_price", price)
    # Both compare their batch with the empty table; days 3 to 5 are in both.
    first = one.rows_to_insert(table, name(daily(spark, (1, 5), 1.0)), ["row_no"])
    second = two.rows_to_insert(table, name(daily(spark, (3, 8), 2.0)), ["row_no"])
    one.append(table, first, "one")
    two.append(table, second, "two")
    assert one.read(table).count() == 8 and prices(one)[(1, 4)] == 1.0
    # Another commits between the look at the version and one's own commit.
    real, calls = VersionLog.commit, []

    def raced(self, version):
        if not calls:
            calls.append(1)
            three.append(table, three.rows_to_insert(table, name(daily(spark, (9, 10), 3.0)), ["row_no"]), "three")
        return real(self, version)

    late = one.rows_to_insert(table, name(daily(spark, (10, 11), 4.0)), ["row_no"])
    VersionLog.commit = raced
    try:
        one.append(table, late, "late")
    finally:
        VersionLog.commit = real
    assert one.read(table).count() == 11 and prices(one)[(1, 10)] == 3.0
    log = VersionLog(spark, one.path(table))
    assert not log.commit(log.latest())  # a number is given once


def test_a_load_that_is_run_again_replaces_its_own_rows(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path), build_registry())
    rows = spark.sql("SELECT date'2023-01-01' trading_date, 'p' product_name FROM range(3)")
    for load_id in ("x", "y", "x"):
        house.append("fact_weekly_report", rows, load_id)
    assert house.read("fact_weekly_report").count() == 6


def test_unique_key_is_an_option(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path), build_registry(), unique_key_tables=("fact_weekly_report",))
    rows = spark.sql("SELECT date'2023-01-01' trading_date, 'p' product_name, 'i' investor_type, id row_no FROM range(3)")
    for _ in range(2):
        house.append("fact_weekly_report", house.rows_to_insert("fact_weekly_report", rows, ["row_no"]), "x")
    assert house.read("fact_weekly_report").count() == 1


def test_listing(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "k=v").mkdir()
    for name in ("a.csv", "b 1.csv", "sub/c.csv", "k=v/d.csv"):
        (tmp_path / name).write_text("x")
    (tmp_path / "empty.csv").write_text("")
    files = with_empty_files(list_files(spark, str(tmp_path)), str(tmp_path))
    assert {(r.file_name, r.length) for r in files.collect()} == {("a.csv", 1), ("b 1.csv", 1), ("empty.csv", 0)}
    assert parse_targets(" a.csv, ,b 1.csv,") == ["a.csv", "b 1.csv"] and parse_targets(None) == []
    assert [r.file_name for r in only_targets(files, "a.csv,nope").select("file_name").collect()] == ["a.csv"]
    assert only_targets(files, " , ").count() == 3


def test_amounts(spark, tmp_path):
    df = spark.createDataFrame([(1, 100), (2, -200), (3, 300), (4, -400), (5, 0)], "id int, amount int")
    got = [(r.absolute_amount, r.transaction_type) for r in amount_features(df).orderBy("id").collect()]
    assert got == [(100, "credit"), (200, "debit"), (300, "credit"), (400, "debit"), (0, "credit")]
    assert [r.id for r in preview(df, ["amount"], 2).collect()] == [4, 2]
    with pytest.raises(AnalysisException):
        derive_table(spark, "no_such_table")
    names = ("valid_data_of_a_test", "transformed_data_of_a_test")
    try:
        for rows in (df, df.limit(2)):  # written anew each time
            rows.write.mode("overwrite").saveAsTable(names[0])
            derive_table(spark, *names)
            assert spark.table(names[1]).exceptAll(amount_features(rows)).count() == 0
        assert spark.table(names[1]).count() == 2
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_duration_is_rounded(spark):
    report = outcomes.with_clock(spark.range(1).selectExpr("'SUCCESS' AS status"), "x", F.lit("a"), F.lit("b"), 1.23456)
    assert report.first()["total_duration_seconds"] == 1.23


def test_registry_from_files(tmp_path):
    (tmp_path / "s.json").write_text(
        '{"default_daily": {"keywords": ["x"], "db_table_name": "t", "primary_key": ["volume"], '
        '"columns_map": {"volume": {"db_type": "BIGINT", "aliases": ["V"]}, "source": {}}}}'
    )
    (tmp_path / "r.json").write_text('{"validation_rules": {"default_daily": {"volume": {"min_value": 1}}}}')
    registry = load_registry(str(tmp_path / "s.json"), str(tmp_path / "r.json"))
    spec = registry.schemas["default_daily"]
    assert spec.columns[0].clean == ("null_tokens", "thousands", "numeric") and spec.primary_key == ("volume",)
    assert spec.source_tag == build_registry().schemas["default_daily"].source_tag
    assert registry.rules == {"default_daily": {"volume": {"min_value": 1}}} and registry.quarantine not in registry.schemas
    with pytest.raises(ValueError, match="unknown type"):
        build_registry({"a": {"columns_map": {"c": {"db_type": "MONEY"}}}})


def test_rows_of_one_file_are_not_dealt_to_one_task(spark, tmp_path):
    """Line items of few return flags meet the header positions where they lie."""
    lines = spark.range(30_000).selectExpr(
        "id l_orderkey", "1 l_linenumber", "if(id % 10 = 0, if(id % 20 = 0, null, 'A'), 'N') l_returnflag", "date'2024-02-01' l_shipdate",
        "id l_partkey", "double(id) l_extendedprice", "double(1) l_quantity", "'O' l_linestatus",
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "32k", "spark.sql.adaptive.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        named = catalog_sources.rename_aliases(spark, str(tmp_path))
        plan = named._jdf.queryExecution().executedPlan().toString()
        got = named.selectExpr("count(*)", "sum(l_orderkey)", "sum(bigint(product_id))", "min(trading_date)", "max(volume)").first()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "hashpartitioning(l_returnflag" not in plan and "BroadcastHashJoin" in plan
    total = sum(i for i in range(30_000) if i % 20)
    assert tuple(got) == (28_500, total, total, "2024/02/01", "1000")
