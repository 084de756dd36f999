"""File contents to CSV records: unzip, find the encoding, cut into records.

This is the one place where rows pass through Python, as Spark has no reader for ZIP archives, for strict decoding
with alternatives or for line breaks inside quotes. It runs inside tasks over streams of bounded size and hands back
batches of whole records; splitting records into fields and all that follows is left to expressions.

Whatever is wrong with one file or archive member becomes a value in its row and never fails the job.
"""

from __future__ import annotations

import codecs
import io
import sys
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from sievemill.functions import content_hash
from sievemill.session import small_python_batches

# Encodings in the order they are tried, size of the head that is searched for schema keywords.
ENCODINGS = ("utf-8", "big5", "ms950", "cp950")
HEAD_BYTES = 4096

# Members of an archive that are read, and those that are not.
MEMBER_SUFFIX = ".csv"
IGNORED_PREFIX = "__MACOSX"

BLOCK_CHARS = 1 << 20
READ_BYTES = 4 << 20

_OUT = pa.schema(
    [
        ("path", pa.string()),
        ("content_hash", pa.string()),
        ("is_archive", pa.bool_()),
        ("member_no", pa.int32()),
        ("member", pa.string()),
        ("n_bytes", pa.int64()),
        ("encoding", pa.string()),
        ("error", pa.string()),
        ("decode_error", pa.string()),
        ("head", pa.string()),
        ("header", pa.string()),
        ("chunk_no", pa.int32()),
        ("first_row", pa.int64()),
        ("records", pa.list_(pa.string())),
    ]
)
_SPARK_OUT = (
    "path string, content_hash string, is_archive boolean, member_no int, member string, n_bytes long, encoding string, error string, "
    "decode_error string, head string, header string, chunk_no int, first_row long, records array<string>"
)

Opener = Callable[[], io.BufferedIOBase]


def find_encoding(opener: Opener) -> tuple[str | None, int, str | None]:
    """(first encoding that decodes every byte, size, what went wrong). Reads block by block."""
    problems = []
    for name in ENCODINGS:
        decoder = codecs.getincrementaldecoder(name)()
        size = 0
        try:
            with opener() as stream:
                while block := stream.read(READ_BYTES):
                    size += len(block)
                    decoder.decode(block)
            decoder.decode(b"", final=True)
            return name, size, None
        except UnicodeDecodeError as e:
            problems.append(f"{name}: {e.reason}")
    return None, size, "no supported encoding fits; " + "; ".join(problems)


def head_text(head: bytes) -> str | None:
    """The head in the first encoding that fits; a character cut off at its end does not count."""
    for name in ENCODINGS:
        try:
            return codecs.getincrementaldecoder(name)().decode(head)
        except UnicodeDecodeError:
            continue
    return None


def still_quoted(line: str, inside: bool) -> bool:
    """Whether a quoted field is open at the end of ``line``, given whether one was at its start."""
    at = 0
    if not inside:
        if not line.startswith('"'):
            at = line.find(',"') + 1
            if at == 0:
                return False
        at += 1
    while True:
        # Inside a quoted field: look for the quote that closes it.
        at = line.find('"', at)
        if at < 0:
            return True
        if line.startswith('"', at + 1):
            at += 2
            continue
        at = line.find(',"', at + 1)
        if at < 0:
            return False
        at += 2


def _blank(line: str) -> bool:
    return not line.strip(" \t\r\n")


def iter_records(text: io.TextIOBase) -> Iterator[list[str]]:
    """Lists of whole records. Blank lines are left out; a record may span lines inside quotes."""
    carry = ""
    parts: list[str] = []
    inside = False
    while True:
        block = text.read(BLOCK_CHARS)
        data = carry + block
        if block:
            # Hold back the last, maybe unfinished line; a trailing CR may be half of a CRLF.
            cut = max(data.rfind("\n"), data.rfind("\r", 0, len(data) - 1)) + 1
            data, carry = data[:cut], data[cut:]
        else:
            carry = ""
        if not inside and '"' not in data:
            lines = data.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            records = [line for line in lines if not _blank(line)]
        else:
            records = []
            # newline="" splits at CR, LF and CRLF and keeps them as they are.
            for line in io.StringIO(data, newline=""):
                if not inside and '"' not in line:
                    if not _blank(line):
                        records.append(line.rstrip("\r\n"))
                    continue
                inside = still_quoted(line, inside)
                parts.append(line)
                if not inside:
                    records.append("".join(parts).rstrip("\r\n"))
                    parts = []
        if records:
            yield records
        if not block:
            break
    if inside:
        raise ValueError("end of file inside a quoted field")


def _member_rows(base: dict, opener: Opener) -> Iterator[dict]:
    """Rows of one plain file or one archive member: at least one, one per chunk of records otherwise."""
    row = dict(base)
    try:
        with opener() as stream:
            head = stream.read(HEAD_BYTES)
        if not head:
            yield {**row, "n_bytes": 0}
            return
        row["head"] = (head_text(head) or "").removeprefix("\ufeff")
        row["encoding"], row["n_bytes"], row["decode_error"] = find_encoding(opener)
        if row["encoding"] is None:
            yield row
            return
        chunk_no, first_row, header = 0, 0, None
        with opener() as stream:
            text = io.TextIOWrapper(stream, encoding=row["encoding"], newline="")
            for records in iter_records(text):
                if header is None:
                    header = records[0].removeprefix("\ufeff")
                    records = records[1:]
                if records:
                    yield {**row, "header": header, "chunk_no": chunk_no, "first_row": first_row, "records": records}
                    chunk_no += 1
                    first_row += len(records)
        if chunk_no == 0:
            yield {**row, "header": header}
    except Exception as e:  # any fault of a file is that file's outcome
        yield {**row, "error": f"{type(e).__name__}: {e}"}


def file_rows(path: str, content_hash: str, opener: Opener) -> Iterator[dict]:
    """Rows of one input file; archives are known by their content, not their name."""
    base = {"path": path, "content_hash": content_hash, "is_archive": False, "member_no": 0, "chunk_no": 0, "first_row": 0}
    try:
        with opener() as stream:
            if not zipfile.is_zipfile(stream):
                archive = None
            else:
                archive = zipfile.ZipFile(opener())
    except Exception as e:
        yield {**base, "is_archive": True, "error": f"damaged archive: {e}"}
        return
    if archive is None:
        yield from _member_rows(base, opener)
        return
    with archive:
        wanted = [
            m
            for m in archive.infolist()
            if m.filename.lower().endswith(MEMBER_SUFFIX) and not m.filename.startswith(IGNORED_PREFIX)
        ]
        if not wanted:
            yield {**base, "is_archive": True, "error": "no CSV file in the archive"}
        for number, info in enumerate(wanted):
            member = {**base, "is_archive": True, "member_no": number, "member": info.filename}
            yield from _member_rows(member, lambda info=info: archive.open(info))


def _batches(rows: Iterable[dict], max_chars: int = 2 * BLOCK_CHARS, max_rows: int = 2000) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row.get("head") or "") + sum(map(len, row.get("records") or ()))
        if size >= max_chars or len(held) >= max_rows:
            yield pa.RecordBatch.from_pylist(held, schema=_OUT)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=_OUT)


def _expand(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[dict]:
        for batch in batches:
            for path, digest, content in zip(*batch.columns):
                data = content.as_py() or b""
                yield from file_rows(path.as_py(), digest.as_py(), lambda data=data: io.BytesIO(data))

    yield from _batches(rows())


# Tasks get the functions themselves, so the package need not be installed on every machine.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read_members(files: DataFrame) -> DataFrame:
    """Chunks of records of all ``files`` (columns ``path`` and ``content``).

    Every file and every CSV member of an archive has at least one row, also when nothing could be read from it. Files come to Python in
    batches of a few MB, a larger one alone.
    """
    small_python_batches(files.sparkSession)
    return files.select("path", content_hash("content"), "content").mapInArrow(_expand, _SPARK_OUT)
