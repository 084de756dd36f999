"""End to end on small files written by the tests."""

import io
import zipfile

import pytest

from sievemill import Warehouse, build_registry, ingest_folder
from sievemill.operators.tables import LEDGER_TABLE

# The shapes and header names are fixed, as the counts that are expected hang on them; the rows are made up.
DAILY = "交易日期,契約代號,到期月份(週別),履約價,買賣權,開盤價,最高價,最低價,收盤價,成交量"
GOOD = f"""{DAILY}
2021/05/03,KLM,202106,0.0,FUT,310,325.5,301,318,100
2021/05/04,KLM,202106,0.0,FUT,318,330,309.5,322,200
"""
MIXED = f"""{DAILY},未沖銷契約量
2021/06/01,KLM,202107,0.0,FUT,322,340,315,333,-50,7
,KLM,202107,0.0,FUT,322,340,315,333,90,7
2021/06/03,KLM,202107,0.0,FUT,333,341,330,338,"1,300",7
"""
WEEKLY = """日期,商品名稱,身份別,多方交易口數,多方交易金額,空方交易口數,空方交易金額
2023/11/15,臺股期貨,自營商,1000,2000,1500,3000
2023/11/15,臺股期貨,投信,10,20,15,30
"""


def zipped(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members.items():
            z.writestr(name.replace("__dot__", "."), data)
    return out.getvalue()


@pytest.fixture
def put(spark, tmp_path):
    # On a handful of rows compiling the plans takes longer than running them; the query tests run compiled.
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    folder = tmp_path / "in"
    folder.mkdir()

    def write(name, data):
        (folder / name).write_bytes(data if isinstance(data, bytes) else data.encode())

    write.folder = str(folder)
    write.root = str(tmp_path / "warehouse")
    yield write
    spark.conf.unset("spark.sql.codegen.wholeStage")
    spark.conf.unset("spark.sql.codegen.factoryMode")


def by_name(df, key="file_name"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_golden_run(spark, put):
    put("normal.csv", GOOD)
    put("with_invalid.csv", MIXED)
    put("weekly_bad.csv", "日期,商品名稱,其他\n2023/01/01,TXF,1\n")
    put("unknown.csv", "header1,header2,header3\n" + "a,b,c\na,b,c,d\n" * 6)
    put("header_only.csv", "欄位A,欄位B\n")
    run = ingest_folder(spark, put.folder, put.root)
    report = run.report.first()
    assert report["files_processed_total"] == 5
    assert report["files_successfully_parsed_and_validated_loaded"] == 2
    assert report["files_failed_parsing_or_other_error"] == 3
    assert report["files_with_quarantined_rows"] == 1
    assert report["rows_source_total_from_parsed_files"] == 5
    assert report["rows_added_to_main_tables"] == 3
    assert report["rows_added_to_quarantine_table"] == 2
    assert report["status"] == "PARTIAL_SUCCESS"
    files = by_name(run.files)
    assert "required columns are empty: investor_type, long_pos_volume" in files["weekly_bad.csv"]["message"]
    assert "no header name" in files["unknown.csv"]["message"]
    assert files["header_only.csv"]["message"] == "no data rows"
    assert files["normal.csv"]["disposition"] == "processed"
    assert files["unknown.csv"]["disposition"] == "quarantine"

    house = Warehouse(spark, put.root, build_registry())
    facts = house.read("fact_daily_ohlc").orderBy("trading_date").collect()
    assert [r["volume"] for r in facts] == [100, 200, 1300]
    assert {r["source"] for r in facts} == {"taifex_daily_csv"}
    bad = {r["quarantine_reason"]: r for r in house.read("quarantine_data").collect()}
    assert set(bad) == {"Column 'volume': is less than 0", "Column 'trading_date': is null"}
    assert bad["Column 'volume': is less than 0"]["volume"] == "-50"
    assert bad["Column 'trading_date': is null"]["source_file"] == "with_invalid.csv"
    assert len(house.read("quarantine_data").columns) == 21


def test_rerun_and_backfill(spark, put):
    put("normal.csv", GOOD)
    put("bad.csv", "x,y\n1,2\n")
    house = Warehouse(spark, put.root, build_registry())
    ingest_folder(spark, put.folder, put.root)
    again = ingest_folder(spark, put.folder, put.root)
    files = by_name(again.files)
    assert files["normal.csv"]["status"] == "skipped" and files["normal.csv"]["message"] == "already ingested"
    assert files["bad.csv"]["status"] == "error"  # failures are tried again
    assert again.report.first()["status"] == "FAILURE"
    back = ingest_folder(spark, put.folder, put.root, mode="BACKFILL")
    report = back.report.first()
    assert report["rows_added_to_main_tables"] == 0
    assert report["rows_skipped_on_load_due_to_conflict"] == 2
    assert house.read("fact_daily_ohlc").count() == 2
    # A renamed copy is still known by its content.
    put("copy.csv", GOOD)
    copied = by_name(ingest_folder(spark, put.folder, put.root, targets="copy.csv").files)
    assert set(copied) == {"copy.csv"} and copied["copy.csv"]["status"] == "skipped"
    keys = [r["ledger_key"] for r in house.read(LEDGER_TABLE).filter("status = 'success'").collect()]
    assert len(set(keys)) == 1 and len(keys[0]) == 64


def test_replace_and_null_keys(spark, put):
    short = "交易日期,契約代號,收盤價,成交量\n2023/01/01,TXF,15050,100\n2023/03/01,TXF,1,1\n"
    put("a.csv", short)
    ingest_folder(spark, put.folder, put.root)
    house = Warehouse(spark, put.root, build_registry())
    assert house.read("fact_daily_ohlc").count() == 2  # keys with gaps load and are not lost
    put("b.csv", "交易日期,契約代號,收盤價,成交量\n2023/01/01,TXF,777,5\n2023/01/01,TXF,888,6\n")
    ingest_folder(spark, put.folder, put.root, conflict="IGNORE")
    assert sorted(r["close"] for r in house.read("fact_daily_ohlc").collect()) == [1.0, 15050.0]
    put("c.csv", "交易日期,契約代號,收盤價,成交量\n2023/01/01,TXF,777,5\n2023/01/01,TXF,888,6\n2023/01/09,TXF,9,9\n")
    ingest_folder(spark, put.folder, put.root, conflict="REPLACE")
    assert sorted(r["close"] for r in house.read("fact_daily_ohlc").collect()) == [1.0, 9.0, 888.0]


def test_archives(spark, put):
    put("two.zip", zipped(a__dot__csv=GOOD, b__dot__CSV=WEEKLY.encode("big5"), note__dot__txt="x"))
    put("mixed.zip", zipped(good__dot__csv="\ufeff" + MIXED, empty__dot__csv="", latin__dot__csv="csv\né\n".encode("latin-1")))
    put("none.zip", zipped(note__dot__txt="x", __MACOSX__dot__csv="x"))
    damaged = bytearray(zipped(a__dot__csv=GOOD * 20))
    damaged[60:70] = b"\0" * 10
    put("damaged.zip", bytes(damaged))
    put("really_a_csv.zip", GOOD.replace("KLM", "NOP"))
    put("empty.csv", b"")
    run = ingest_folder(spark, put.folder, put.root, spread_above=600)  # some of the archives are spread
    files, members = by_name(run.files), by_name(run.members, "display_name")
    assert files["two.zip"]["status"] == "success" and files["two.zip"]["rows_inserted"] == 4
    assert members["two.zip/b.CSV"]["encoding"] == "big5"
    assert members["two.zip/b.CSV"]["schema_name"] == "weekly_report"
    assert files["mixed.zip"]["status"] == "success" and files["mixed.zip"]["rows_quarantined"] == 2
    assert members["mixed.zip/empty.csv"]["status"] == "skipped"
    assert members["mixed.zip/latin.csv"]["reason"].startswith("no supported encoding")
    assert files["none.zip"]["message"] == "no CSV file in the archive"
    assert members["damaged.zip/a.csv"]["status"] == "error" and files["damaged.zip"]["status"] == "error"
    assert files["really_a_csv.zip"]["status"] == "success"
    assert files["empty.csv"]["status"] == "skipped" and files["empty.csv"]["disposition"] == "skipped"
    house = Warehouse(spark, put.root, build_registry())
    assert house.read("fact_weekly_report").count() == 2


def test_all_rows_quarantined_is_an_error(spark, put):
    put("neg.csv", f"{DAILY}\n2023/01/01,TXF,202303,0.0,FUT,1,1,1,1,-1\n")
    run = ingest_folder(spark, put.folder, put.root)
    row = run.files.first()
    assert row["status"] == "error" and row["message"] == "all rows quarantined"
    assert run.report.first()["status"] == "FAILURE"
    house = Warehouse(spark, put.root, build_registry())
    assert house.read("quarantine_data").count() == 1


def test_same_run_id_does_not_double_unkeyed_rows(spark, put):
    put("weekly.csv", WEEKLY)
    house = Warehouse(spark, put.root, build_registry())
    for _ in range(2):
        ingest_folder(spark, put.folder, put.root, mode="BACKFILL", run_id="run-1")
    assert house.read("fact_weekly_report").count() == 2
    ingest_folder(spark, put.folder, put.root, mode="BACKFILL", run_id="run-2")
    assert house.read("fact_weekly_report").count() == 4  # no key is enforced by default


class Broken(Exception):
    pass


def test_two_runs_at_once_load_a_file_once(spark, put, monkeypatch):
    """While the first run reads, a second one brings one of its two files, to a table without a key and to the quarantine."""
    both = zipped(weekly__dot__csv=WEEKLY, mixed__dot__csv=MIXED)
    put("both.zip", both)
    put("other.csv", WEEKLY.replace("2023/11/15", "2023/11/22"))
    house = Warehouse(spark, put.root, build_registry())
    real, calls = Warehouse.append, []

    def raced(self, table, *args, **options):
        if not calls:
            calls.append(table)
            second = ingest_folder(spark, put.folder, put.root, targets="both.zip")
            assert by_name(second.files)["both.zip"]["rows_inserted"] > 0
        return real(self, table, *args, **options)

    monkeypatch.setattr(Warehouse, "append", raced)
    first = ingest_folder(spark, put.folder, put.root)
    files = by_name(first.files)
    assert house.read("fact_weekly_report").count() == 4
    assert house.read("quarantine_data").count() == 2  # as many as one run refuses
    assert files["both.zip"]["rows_inserted"] == 0 and files["other.csv"]["rows_inserted"] == 2
    assert files["both.zip"]["rows_skipped"] == files["both.zip"]["rows_valid"]


def test_a_run_that_breaks_off_leaves_no_row_twice(spark, put, monkeypatch):
    """It breaks off after the facts and before the ledger; another run brings the file, then the first one is resumed."""
    put("weekly.csv", WEEKLY)
    house = Warehouse(spark, put.root, build_registry())
    real = Warehouse.append

    def broken(self, table, *args, **options):
        if table == LEDGER_TABLE:
            raise Broken
        return real(self, table, *args, **options)

    with monkeypatch.context() as patched:
        patched.setattr(Warehouse, "append", broken)
        with pytest.raises(Broken):
            ingest_folder(spark, put.folder, put.root, run_id="run-1")
    assert house.read("fact_weekly_report").count() == 2
    other = by_name(ingest_folder(spark, put.folder, put.root).files)["weekly.csv"]
    assert other["status"] == "success" and other["rows_inserted"] == 0
    for _ in range(2):
        ingest_folder(spark, put.folder, put.root, run_id="run-1")
        assert house.read("fact_weekly_report").count() == 2
    assert by_name(ingest_folder(spark, put.folder, put.root).files)["weekly.csv"]["status"] == "skipped"


def test_no_fallback_schema_means_skipped(spark, put):
    put("x.csv", "a,b\n1,2\n")
    run = ingest_folder(spark, put.folder, put.root, build_registry(fallback=None))
    assert run.files.first()["status"] == "skipped"
    assert run.report.first()["status"] == "UNKNOWN"


def test_values_that_do_not_fit_their_type_are_quarantined(spark, put):
    put("odd.csv", f"{DAILY}\n2023/01/01,0100,202303,0.0,FUT,x,1,1,1,5\n2023/13/01,T,1,1,C,1,1,1,1,5\n2023/1/2,T,1,1,C,1,1,1,1,5\n")
    run = ingest_folder(spark, put.folder, put.root)
    assert run.files.first()["rows_quarantined"] == 2
    house = Warehouse(spark, put.root, build_registry())
    reasons = {r[0] for r in house.read("quarantine_data").select("quarantine_reason").collect()}
    assert reasons == {"Column 'open': failed conversion to DOUBLE", "Column 'trading_date': failed conversion to DATE"}
    assert {r["product_id"] for r in house.read("quarantine_data").collect()} == {"0100", "T"}


def test_hidden_and_empty_files_have_an_outcome(spark, put):
    put("_x.csv", GOOD.replace("KLM", "UND"))
    put(".x.csv", GOOD.replace("KLM", "DOT"))
    put("_empty.csv", b"")
    put(".a.zip", zipped(in__dot__csv=GOOD.replace("KLM", "ZIP")))
    put("plain.csv", GOOD)
    files = by_name(ingest_folder(spark, put.folder, put.root).files)
    assert {n: (r["status"], r["rows_inserted"]) for n, r in files.items()} == {
        "_x.csv": ("success", 2), ".x.csv": ("success", 2), "_empty.csv": ("skipped", 0), ".a.zip": ("success", 2), "plain.csv": ("success", 2),
    }
    again = by_name(ingest_folder(spark, put.folder, put.root).files)
    assert again["_x.csv"]["message"] == again[".a.zip"]["message"] == "already ingested"


def test_skip_reason_names_the_schemas(spark, put):
    put("odd.csv", "nothing,known\n1,2\n")
    declared = {"columns_map": {"c": {"db_type": "VARCHAR"}}}
    registry = build_registry({n: {"keywords": [n], "db_table_name": n, **declared} for n in ("only", "other")})
    files = by_name(ingest_folder(spark, put.folder, put.root, registry).files)
    assert files["odd.csv"]["status"] == "skipped" and files["odd.csv"]["message"] == "no schema matches the content; tried: only, other"
