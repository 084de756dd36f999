from test_ingest import DAILY, GOOD, WEEKLY, put  # noqa: F401

from sievemill import Warehouse, build_registry
from sievemill.operators.tables import LEDGER_TABLE
from sievemill.streaming.incremental import ingest_new_files


def test_stream_takes_only_new_files(spark, put, tmp_path):  # noqa: F811
    house = Warehouse(spark, put.root, build_registry())

    def run():
        query = ingest_new_files(spark, put.folder, put.root, str(tmp_path / "checkpoint"))
        query.awaitTermination()

    put("daily.csv", GOOD)
    put("weekly.csv", WEEKLY)
    run()
    assert house.read("fact_daily_ohlc").count() == 2 and house.read("fact_weekly_report").count() == 2
    put("copy.csv", WEEKLY)
    put("more.csv", f"{DAILY}\n2023/05/01,TXF,202305,1.0,C,1,1,1,1,7\n")
    run()
    assert house.read("fact_daily_ohlc").count() == 3
    assert house.read("fact_weekly_report").count() == 2  # the copy is known by its content
    put("none.csv", b"")
    put("_hidden.csv", GOOD.replace("KLM", "HID"))
    put(".dot.csv", GOOD.replace("KLM", "DOT"))
    (tmp_path / "in" / "day=1").mkdir()
    (tmp_path / "in" / "day=1" / "below.csv").write_text(GOOD.replace("KLM", "SUB"))
    put("last.csv", GOOD.replace("KLM", "LST"))
    put("unwanted.csv", GOOD.replace("KLM", "UNW"))
    query = ingest_new_files(spark, put.folder, put.root, str(tmp_path / "checkpoint"), targets="none.csv, _hidden.csv, .dot.csv, last.csv, below.csv")
    query.awaitTermination()
    status = {r["original_filename"]: (r["status"], r["message"]) for r in house.read(LEDGER_TABLE).collect()}
    assert house.read("fact_daily_ohlc").count() == 9, (status, house.read("fact_daily_ohlc").select("product_id").collect())
    status = {r["original_filename"]: r["status"] for r in house.read(LEDGER_TABLE).collect()}
    assert status.pop("none.csv") == "skipped" and {status.pop(n) for n in ("_hidden.csv", ".dot.csv", "last.csv")} == {"success"}
    assert sorted(status) == ["daily.csv", "more.csv", "weekly.csv"]


def test_ledger_names(spark, put, tmp_path):  # noqa: F811
    house = Warehouse(spark, put.root, build_registry())
    put("daily.csv", GOOD)
    put("copy.csv", GOOD)
    ingest_new_files(spark, put.folder, put.root, str(tmp_path / "checkpoint")).awaitTermination()
    names = sorted(r["original_filename"] for r in house.read(LEDGER_TABLE).collect())
    assert names == ["copy.csv", "daily.csv"]
