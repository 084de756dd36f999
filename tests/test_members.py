"""The reader that turns file contents into records; no Spark session needed but for the last tests."""

import csv
import io
import zipfile

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sievemill.session import BATCH_SETTING
from sievemill.sources import members


def records(data, **kwargs):
    return [r for chunk in members.iter_records(io.StringIO(data, newline="")) for r in chunk]


def rows(data):
    return list(members.file_rows("f", "hash", lambda: io.BytesIO(data)))


def test_records_keep_quoted_line_breaks_and_drop_blank_lines():
    assert records('a,b\r\n"x\r\ny",1\n \t\n\n5"x,2\r3,4') == ["a,b", '"x\r\ny",1', '5"x,2', "3,4"]
    assert records('"a""\n""b",1\n"c",2\n') == ['"a""\n""b",1', '"c",2']
    assert records("") == []


def test_open_quote_at_the_end_is_an_error():
    with pytest.raises(ValueError, match="inside a quoted field"):
        records('a\n"x\ny\n')


@pytest.mark.parametrize("block", [1, 2, 3, 7])
def test_block_borders_do_not_matter(monkeypatch, block):
    text = 'h1,h2\r\n"a\r\nb",""\r\n,"x""y"\rlast,"z"'
    whole = records(text)
    monkeypatch.setattr(members, "BLOCK_CHARS", block)
    assert records(text) == whole == ["h1,h2", '"a\r\nb",""', ',"x""y"', 'last,"z"']


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.text(alphabet='ab,"\n\r ', min_size=0, max_size=6), min_size=2, max_size=3), max_size=6), st.integers(1, 9))
def test_records_agree_with_the_csv_module(table, block):
    out = io.StringIO(newline="")
    csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\r\n").writerows(table)
    size, members.BLOCK_CHARS = members.BLOCK_CHARS, block
    try:
        got = records(out.getvalue())
    finally:
        members.BLOCK_CHARS = size
    assert [next(csv.reader(io.StringIO(r, newline=""))) for r in got] == table


def test_encodings():
    text = "交易日期\n成交量\n"
    assert [r["encoding"] for r in rows(text.encode("utf-8"))] == ["utf-8"]
    assert [r["encoding"] for r in rows(text.encode("big5"))] == ["big5"]
    # A character of code page 950 that Big5 lacks.
    assert [r["encoding"] for r in rows(("碁銹裏\n" + text).encode("cp950"))] == ["ms950"]
    (bad,) = rows(b"csv\n\xe9\n\xff")
    assert bad["encoding"] is None and bad["decode_error"].startswith("no supported encoding")


def test_head_is_cut_by_bytes_without_breaking_a_character():
    head = rows(("x" + "商" * 3000).encode())[0]["head"]
    assert head == "x" + "商" * 1365


def test_late_decode_error_is_found_before_rows_are_handed_on():
    (bad,) = rows(b"a,b\n" + b"1,2\n" * 3_000_000 + b"\xff\n")
    assert bad["decode_error"] and "records" not in bad


def test_bom_and_empty_inputs():
    (row,) = rows("\ufeffa,b\n1,2\n".encode())
    assert row["header"] == "a,b" and row["records"] == ["1,2"] and row["head"].startswith("a,b")
    (row,) = rows(b"")
    assert row["n_bytes"] == 0
    (row,) = rows(b"a,b\n")
    assert row["header"] == "a,b" and "records" not in row


def test_chunks_number_their_rows():
    got = rows(b"h\n" + b"x" * 40 + b"\n" + (b"0123456789" * 10 + b"\n") * 30000)
    assert len(got) > 1
    assert [r["chunk_no"] for r in got] == list(range(len(got)))
    firsts = [r["first_row"] for r in got]
    sizes = [len(r["records"]) for r in got]
    assert firsts == [sum(sizes[:i]) for i in range(len(sizes))] and sum(sizes) == 30001


def test_archive_members():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("d/one.csv", "h\n1\n")
        z.writestr("two.CSV", "h\n2\n")
        z.writestr("__MACOSX/one.csv", "junk")
        z.writestr("readme.txt", "junk")
    got = rows(out.getvalue())
    assert [(r["member_no"], r["member"], r["records"]) for r in got] == [(0, "d/one.csv", ["1"]), (1, "two.CSV", ["2"])]
    assert all(r["is_archive"] for r in got)


def test_archive_with_a_bad_member_keeps_the_good_one():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("bad.csv", "h\nAAAAAAAAAA\n")
        z.writestr("good.csv", "h\n1\n")
    bad, good = rows(out.getvalue().replace(b"AAAAAAAAAA", b"BAAAAAAAAA"))
    assert "CRC" in bad["error"] and good["records"] == ["1"]


def test_empty_archive_is_an_error():
    out = io.BytesIO()
    zipfile.ZipFile(out, "w").close()
    (row,) = rows(out.getvalue())
    assert row["is_archive"] and row["error"] == "no CSV file in the archive"


def test_files_come_to_python_in_small_batches(spark, monkeypatch):
    """Not 64 MB at a time, which every worker would hold in several copies; a limit that was set stays."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pylist([{"path": str(batch.nbytes)}], schema=members._OUT)

    monkeypatch.setattr(members, "_expand", sizes)
    spark.conf.unset(BATCH_SETTING)
    files = spark.range(0, 40, 1, 1).selectExpr("string(id) path", "encode(repeat('x', 500000), 'UTF-8') content")
    got = [int(r.path) for r in members.read_members(files).collect()]
    assert sum(got) > 40 * 500_000 and max(got) < 6_000_000
    spark.conf.set(BATCH_SETTING, "1m")
    try:
        assert max(int(r.path) for r in members.read_members(files).collect()) < 2_000_000
    finally:
        spark.conf.unset(BATCH_SETTING)


def test_rows_leave_python_in_small_batches():
    """Rows of texts are handed on by some 2 million characters."""
    rows = [{"path": str(i), "records": ["x" * 100_000]} for i in range(100)]
    got = list(members._batches(iter(rows)))
    assert [p for b in got for p in b.column("path").to_pylist()] == [r["path"] for r in rows]
    assert max(b.nbytes for b in got) < 3_000_000
