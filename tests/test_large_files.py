"""Large files give what small ones give: rows, numbers, encodings, errors and identity, read in splits or opened by path."""

import hashlib
import io
import random
import zipfile

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_ingest import DAILY, by_name, put  # noqa: F401

from sievemill import Warehouse, build_registry, ingest_folder
from sievemill.functions import content_hash
from sievemill.plans import catalog_sources
from sievemill.session import write_and_reread
from sievemill.sources import members, split_scan
from sievemill.sources.files import list_files

FACTS = ["rows_source", "rows_too_long", "rows_valid", "rows_quarantined", "schema_name", "status", "reason", "encoding", "n_bytes"]
CHUNK = ["content_hash", "is_archive", "member_no", "n_bytes", "encoding", "error", "decode_error", "head"]


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def quoted(rng, n, odd="中文"):
    """Lines with quoted breaks, some longer than a split of the tests, blank ones, all three line ends."""
    out = []
    for i in range(n):
        value = rng.choice(["x", '"a, b"', '"q""q"', '"two\nlines"', '"cr\r\nlf\r"', '5"', f'"{odd}"', odd, '""', '"\n\n\n"'])
        if i % 400 == 200:
            value = '"' + "long, line\n" * 6000 + '"'
        out.append(f"2023/{i % 12 + 1}/{i % 28 + 1},{value},{i},1,1,1,1,1,{i}.5,{i}" + rng.choice(["\n", "\r\n", "\r", "\n \t\n"]))
    return "".join(out)


def chunk_rows(chunks):
    """(facts of each file, its records by number)."""
    facts, records = {}, {}
    for r in chunks.collect():
        name = r.path.rsplit("/", 1)[1]
        facts.setdefault(name, {}).update({c: r[c] for c in CHUNK} | ({"header": r.header} if r.records else {}))
        for i, record in enumerate(r.records or []):
            assert records.setdefault(name, {}).setdefault(r.first_row + i, record) == record
    return facts, records


def test_splits_equal_whole(spark, put, tmp_path, small_splits):  # noqa: F811
    """Every record with its number, whatever the borders of splits fall on; a Big5 file keeps many tasks busy."""
    rng = random.Random(5)
    body = quoted(rng, 1200)
    put("日報 +1%25.csv", "\ufeff" + DAILY + "\r\n" + body)
    put("old [1].csv", (DAILY + "\n" + quoted(rng, 1200)).encode("big5"))
    put("plain.csv", DAILY + "\n" + "".join(f"2023/1/1,P{i},1,1,1,1,1,1,1,{i}\n" for i in range(3000)))
    put("open.csv", DAILY + "\n" + body + '2023/1/1,"never closed\n' + body.replace('"', ""))
    put("mixed.csv", (DAILY + "\n" + body).encode("big5") + "\u20ac é\n".encode() + b"\xff\xff\n" + body.encode("big5"))
    put("header.csv", '\n \n"trading\ndate",b\n' + body)
    put("only.csv", DAILY)
    files = list_files(spark, put.folder)
    whole_facts, whole_records = chunk_rows(members.read_members(files))
    scratch = str(tmp_path / "scratch")
    surveyed = write_and_reread(split_scan.survey(files), scratch)
    assert surveyed.filter("NOT in_splits").count() == 0
    lines = split_scan.raw_lines(spark, [r.path for r in surveyed.filter("file_name LIKE 'old%'").collect()])
    assert lines.rdd.getNumPartitions() > 5
    facts, records = chunk_rows(split_scan.read_splits(surveyed, scratch))
    assert {n: {k: v for k, v in f.items() if k != "header"} for n, f in facts.items()} == {
        n: {k: v for k, v in f.items() if k != "header"} for n, f in whole_facts.items()
    }
    good = ["日報 +1%25.csv", "old [1].csv", "plain.csv", "header.csv"]
    assert facts["open.csv"]["error"] == split_scan.UNCLOSED and facts["mixed.csv"]["decode_error"]
    assert facts["old [1].csv"]["encoding"] == "big5"
    for name in good:
        assert len(records[name]) >= 1200 and records[name] == whole_records[name], name
        assert facts[name].get("header") == whole_facts[name].get("header")
    assert not records.keys() - set(good)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet='ab,"\n\r 中', max_size=80), st.lists(st.integers(0, 80), max_size=5))
def test_any_borders(text, borders):
    """Scan, states and cut of splits by themselves, against reading the text whole."""
    data = text.encode()
    raw = data.split(b"\n")
    if raw[-1] == b"":
        raw.pop()
    cuts = sorted({0, *(b for b in borders if b < len(raw))})
    parts = [raw[a:b] for a, b in zip(cuts, [*cuts[1:], len(raw)])]

    def batches(extra):
        for block, lines in enumerate(parts):
            for at in range(0, len(lines), 3):  # several batches for a split
                some = lines[at : at + 3]
                yield pa.RecordBatch.from_pylist([{"line": x, "file_name": "f", "block": block, **extra(block)} for x in some])

    facts = [r for b in split_scan._facts(batches(lambda block: {})) for r in b.to_pylist()]
    starts = [r for b in split_scan._starts(iter([pa.RecordBatch.from_pylist(facts)])) for r in b.to_pylist()] if facts else []
    state = {r["block"]: r for r in starts}
    try:
        want = [r for chunk in members.iter_records(io.StringIO(text, newline="")) for r in chunk]
    except ValueError:
        assert state[-1]["inside"]
        return
    got, pieces = {}, {}
    for batch in split_scan._cut(batches(lambda block: {"inside": state[block]["inside"], "number": state[block]["number"], "encoding": "utf-8"})):
        for r in batch.to_pylist():
            if r["piece"] is not None:
                pieces.setdefault(r["number"], []).append((r["block"], r["piece"]))
            for i, record in enumerate(r["records"] or []):
                got[r["number"] + i] = record
    got |= {n: "".join(p for _, p in sorted(found)).rstrip("\r\n") for n, found in pieces.items()}
    assert [got[n] for n in sorted(got)] == want and sorted(got) == list(range(len(want)))
    assert not starts or state[-1]["number"] == len(want)


def test_runs_agree_whatever_the_size(spark, put, tmp_path, small_splits):  # noqa: F811
    lines = []
    for i in range(3000):
        line = f"2023/{i % 12 + 1}/{i % 28 + 1},P{i},202303,{i}.0,FUT,1,2,3,{i}.5,\"{i:,}\""
        if i % 7 == 0:
            line = f"2023/1/1,S{i}"  # short: filled up, and so without price and volume
        if i % 11 == 0:
            line += ",1,2,3,4,5,6,7,8,9,10"  # long: dropped
        lines.append(line)
        if i % 13 == 0:
            lines.append("  ")
    text = "\ufeff" + DAILY + "\n" + "\n".join(lines) + "\n"
    put("日報 +1%25.csv", text)
    put("two.csv", text.replace(",P", ",Q").replace(",S", ",T"))
    put("same.csv", text)
    put("broken.csv", DAILY + "\n" + '2023/1/1,"X\nY",1,1,1,1,1,1,1,1\n')
    put("legacy.csv", (DAILY + "\n2023/1/1,中文,1,1,C,1,1,1,1,1\n").encode("big5"))
    put("header.csv", DAILY + "\n")
    for i in range(6):
        put(f"f{i:02d}.csv", f"{DAILY}\n" + "".join(f"2023/1/{d},F{i},1,1,C,1,1,1,1,{d}\n" for d in range(1, 6)))
    with zipfile.ZipFile(f"{put.folder}/a.zip", "w") as archive:
        archive.writestr("in.csv", (DAILY + "\n2023/1/9,Z,1,1,C,1,1,1,1,1\n").encode("big5"))
        archive.writestr("__MACOSX/in.csv", "no")
    whole = ingest_folder(spark, put.folder, str(tmp_path / "whole"))
    split = ingest_folder(spark, put.folder, str(tmp_path / "split"), split_above=50)
    facts = lambda run: {n: {k: r[k] for k in FACTS} for n, r in by_name(run.members).items()}
    assert facts(split) == facts(whole)
    hashes = lambda run: {n: (r["content_hash"], r["status"], r["message"], r["rows_inserted"]) for n, r in by_name(run.files).items()}
    assert hashes(split) == hashes(whole)
    assert hashes(split)["日報 +1%25.csv"][2] == "same content as same.csv"
    registry = build_registry()
    for table in ("fact_daily_ohlc", "quarantine_data"):
        if table in registry.table_names:
            tables = [Warehouse(spark, str(tmp_path / n), registry).read(table) for n in ("whole", "split")]
            keep = [c for c in tables[0].columns if c not in ("quarantined_at", "quarantine_id")]
            assert tables[0].count() == tables[1].count() > 0
            assert tables[0].select(keep).exceptAll(tables[1].select(keep)).count() == 0
    # Either way the files are known to a later run of the other kind.
    again = by_name(ingest_folder(spark, put.folder, str(tmp_path / "whole"), split_above=50).files)
    assert again["two.csv"]["message"] == again["a.zip"]["message"] == again["legacy.csv"]["message"] == "already ingested"


def test_archive_beyond_two_gigabytes(spark, put, tmp_path):  # noqa: F811
    """A sparse archive that fits no value, and its identity."""
    put("small.csv", DAILY + "\n2023/1/1,S,1,1,C,1,1,1,1,1\n")
    path = f"{put.folder}/huge.zip"
    with open(path, "wb") as f:
        f.truncate((2 << 30) + (100 << 20))
        f.seek(0, 2)
        with zipfile.ZipFile(f, "a") as archive:
            archive.writestr("big5.csv", (DAILY + "\n2023/1/2,中文,1,1,C,1,1,1,1,1\n").encode("big5"))
            archive.writestr("quoted.csv", DAILY + '\n2023/1/3,"A\nB",1,1,C,1,1,1,1,1\n')
    run = ingest_folder(spark, put.folder, str(tmp_path / "out"))
    files = by_name(run.files)
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(1 << 24):
            digest.update(block)
    assert files["huge.zip"]["status"] == "success" and files["huge.zip"]["rows_inserted"] == 2
    assert files["huge.zip"]["content_hash"] == digest.hexdigest()
    names = {r.product_id for r in Warehouse(spark, str(tmp_path / "out"), build_registry()).read("fact_daily_ohlc").collect()}
    assert names == {"S", "中文", "A\nB"}


def test_survey(spark, put, monkeypatch):  # noqa: F811
    put("a.csv", "h1,h2\n1,2\n")
    put("cr.csv", "h1,h2\r1,2\r" * 40)
    with zipfile.ZipFile(f"{put.folder}/a.zip", "w") as archive:
        archive.writestr("in.csv", "x")
    files = list_files(spark, put.folder)
    want = {r.file_name: r.h for r in files.select("file_name", content_hash("content").alias("h")).collect()}
    got = {r.file_name: r for r in split_scan.survey(files).collect()}
    assert {n: r.content_hash for n, r in got.items()} == want
    assert got["a.zip"].is_archive and not got["a.zip"].in_splits and got["a.csv"].in_splits and bytes(got["a.csv"].header) == b"h1,h2"
    monkeypatch.setattr(split_scan, "LINE_BYTES", 100)
    assert [split_scan.surveyed(f"{put.folder}/{n}")[2] for n in ("a.csv", "cr.csv")] == [True, False]
    assert "FileNotFound" in split_scan.surveyed(f"{put.folder}/none.csv")[5]
    assert split_scan.first_record(b"a,b\n", False) is None and split_scan.first_record(b"a,b\n", True) == b"a,b"
    assert split_scan.first_record(b'"a', False) is None and split_scan.first_record(b" \n", True) == b""


def test_size_alone_changes_nothing(spark, put, tmp_path):  # noqa: F811
    """What is legal CSV loads whatever the size: quoted breaks, quotes at a value's start, legacy encodings far down."""
    put("break.csv", DAILY + "\n" + '2023/1/1,"X\nY",1,1,C,1,1,1,1,1\n' * 1)
    put("quote.csv", DAILY + "\n" + '2023/1/2,"""Acme"" Ltd",1,1,C,1,1,1,1,1\n')
    lines = "".join(f"2023/1/{i % 28 + 1},A{i},1,1,C,1,1,1,1,1\n" for i in range(6000))
    put("late.csv", (DAILY.replace("交易日期", "trading_date") + "\n").encode("big5") + lines.encode() + "2023/1/3,中文,1,1,C,1,1,1,1,1\n".encode("big5"))
    run = ingest_folder(spark, put.folder, str(tmp_path / "out"), spread_above=100)
    assert {r["status"] for r in by_name(run.files).values()} == {"success"}
    names = {r.product_id for r in Warehouse(spark, str(tmp_path / "out"), build_registry()).read("fact_daily_ohlc").collect()}
    assert {"X\nY", '"Acme" Ltd', "中文"} <= names


def test_one_content_is_loaded_once_in_a_run(spark, put):  # noqa: F811
    weekly = "日期,商品名稱,身份別,多方交易口數,多方交易金額,空方交易口數,空方交易金額\n2023/11/15,P,D,1,2,3,4\n"
    put("a.csv", weekly)
    put("b.csv", weekly)
    put("e1.csv", b"")
    put("e2.csv", b"")
    files = by_name(ingest_folder(spark, put.folder, put.root).files)
    assert files["a.csv"]["status"] == "success" and files["b.csv"]["message"] == "same content as a.csv"
    assert files["e1.csv"]["message"] == files["e2.csv"]["message"] != "already ingested"
    assert Warehouse(spark, put.root, build_registry()).read("fact_weekly_report").count() == 1


@pytest.mark.parametrize("opens", [True, False])
def test_large_files_are_hashed_block_by_block(spark, tmp_path, monkeypatch, opens):
    """Beyond a size Spark hands out no content; where tasks can't open a file it does, as far as it can."""
    contents = {"small.bin": b"x" * 500, "large 1%25.bin": bytes(range(256)) * 40, "empty.bin": b""}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    monkeypatch.setattr(split_scan, "WHOLE_BYTES", 1000, raising=False)
    if not opens:
        monkeypatch.setattr(split_scan, "open_path", lambda path: 1 / 0)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000" if opens else "100000")
    try:
        got = {r.file_name: (r.length, r.content_hash) for r in catalog_sources.folder_listing(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    # Spark's reader has no row for an empty file.
    assert got == {n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in contents.items() if c}
