"""Files beyond a size: opened by path inside tasks, and plain ones read in splits by many tasks.

One task streams each such file once for its SHA-256, its head and its header, and tells archives, whose members are then read from the open
file. Of plain files Spark hands out the raw lines of splits. A line feed is no part of a character in any of the encodings, so lines
can be decoded by themselves; but whether a split begins inside a quoted field hangs on all before it:

1. Each split is scanned under both hypotheses, outside and inside a quoted field, for its state at the end and the number of records that
   begin in it. The same pass tries all encodings.
2. Per file, what holds of its splits is put together in their order: state and number of the first record of each; the encoding that
   all splits allow.
3. Each split is cut into records from the state that holds. A record that crosses a border leaves a piece in each split, which are joined.

So rows, their numbers, encoding and errors are those of reading the file whole.
"""

from __future__ import annotations

import hashlib
import io
import re
import sys
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemill.session import write_and_reread
from sievemill.sources.files import glob_literal, hash_files
from sievemill.sources.members import (
    _SPARK_OUT,
    ENCODINGS,
    HEAD_BYTES,
    READ_BYTES,
    _batches,
    _blank,
    file_rows,
    head_text,
    iter_records,
    still_quoted,
)

# Files that are hashed from their content as Spark hands it out, whole; longer ones are streamed.
WHOLE_BYTES = 64 << 20
# A header, and a line as Spark hands it out, are to be no longer; files where one is are read by one task.
HEADER_BYTES = 64 << 20
LINE_BYTES = 256 << 20
UNCLOSED = "ValueError: end of file inside a quoted field"
NO_ENCODING = "no supported encoding fits"

SURVEY = pa.schema(
    [
        ("path", pa.string()), ("file_name", pa.string()), ("length", pa.int64()), ("content_hash", pa.string()), ("is_archive", pa.bool_()),
        ("in_splits", pa.bool_()), ("head", pa.string()), ("header", pa.binary()), ("error", pa.string()),
    ]
)
HASHES = pa.schema([SURVEY.field(n) for n in ("path", "file_name", "length", "content_hash")])
FACTS = pa.schema(
    [("file_name", pa.string()), ("block", pa.int64()), ("problems", pa.list_(pa.string()))]
    + [(f"{what}_{state}", kind) for state in ("out", "in") for what, kind in (("ends_inside", pa.bool_()), ("records", pa.int64()))]
)
STARTS = pa.schema([("file_name", pa.string()), ("block", pa.int64()), ("inside", pa.bool_()), ("number", pa.int64())])
CUT = pa.schema(
    [("file_name", pa.string()), ("number", pa.int64()), ("block", pa.int64()), ("records", pa.list_(pa.string())), ("piece", pa.string())]
)


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


class Stream(io.BufferedReader):
    """A stream whose failed seeks are errors of the system, as those of plain files are; the archive reader relies on it."""

    def seek(self, offset: int, whence: int = 0) -> int:
        try:
            return super().seek(offset, whence)
        except ValueError as e:
            raise OSError(str(e)) from e


def open_path(path: str) -> Stream:
    """The file as a stream that can seek, opened where this runs. ``path`` is as Spark lists it, with the characters as they are."""
    scheme, host, place = re.match(r"(?:([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?)?(/.*)", path, re.S).groups()
    if scheme in (None, "file"):
        return Stream(fs.LocalFileSystem().open_input_file(place), READ_BYTES)
    store = fs.FileSystem.from_uri(f"{scheme.replace('s3a', 's3')}://{host or ''}/")[0]
    # Object stores take the bucket as the first part of the path.
    return Stream(store.open_input_file(place if scheme in ("hdfs", "viewfs") else f"{host}{place}"), READ_BYTES)


def first_record(start: bytes, is_all: bool) -> bytes | None:
    """The header's bytes, empty where a file has no record; None where it is not to be had from the start of the file."""
    text = io.TextIOWrapper(io.BytesIO(start), encoding="latin-1", newline="")
    try:
        records = next(iter_records(text), None)
    except ValueError:  # an open quote up to the end
        return b"" if is_all else None
    if records is None or (len(records) == 1 and not is_all):
        return b"" if is_all else None
    return records[0].encode("latin-1")


def surveyed(path: str) -> tuple:
    """(hash, is_archive, in_splits, head, header, error) of a file, read once from end to end."""
    try:
        with open_path(path) as stream:
            digest, size, since, longest = hashlib.sha256(), 0, 0, 0
            start = stream.read(HEADER_BYTES)
            stream.seek(0)
            while block := stream.read(READ_BYTES):
                digest.update(block)
                size += len(block)
                first = block.find(b"\n")
                longest = max(longest, since + (len(block) if first < 0 else first))
                since = since + len(block) if first < 0 else len(block) - 1 - block.rfind(b"\n")
            is_archive = zipfile.is_zipfile(stream)
        header = None if is_archive else first_record(start, size <= len(start))
        in_splits = header is not None and longest <= LINE_BYTES
        return digest.hexdigest(), is_archive, in_splits, (head_text(start[:HEAD_BYTES]) or "").removeprefix("﻿"), header, None
    except Exception as e:  # any fault of a file is that file's outcome
        return None, False, False, None, None, f"{type(e).__name__}: {e}"


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, name, length in zip(*(c.to_pylist() for c in batch.columns)):
            yield _rows(SURVEY, [(path, name, length, *surveyed(path))])


def survey(files: DataFrame) -> DataFrame:
    """What is to be known of each of ``files`` (``path, file_name, length``) before its rows are read; contents stay where they are."""
    layout = "path string, file_name string, length long, content_hash string, is_archive boolean, in_splits boolean, head string, header binary, error string"
    return files.select("path", "file_name", "length").mapInArrow(_survey, layout)


def streamed_digest(path: str) -> str | None:
    """SHA-256 of a file, read block by block; None where it can't be opened here."""
    try:
        with open_path(path) as stream:
            return hashlib.file_digest(stream, "sha256").hexdigest()
    except Exception:  # it is left to Spark's reader, which then says what is wrong
        return None


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, name, length in zip(*(c.to_pylist() for c in batch.columns)):
            yield _rows(HASHES, [(path, name, length, streamed_digest(path))])


def hash_all(files: DataFrame, folder: str) -> DataFrame:
    """``hash_files`` without a limit to the size of a file, which Spark's reader has at 2 GB.

    A file beyond ``WHOLE_BYTES`` is streamed by one task, as SHA-256 takes the bytes in their order, and never held. Where tasks can't open
    one, as in a store that only Spark can read, Spark hands out its content, up to 2 GB.
    """
    beyond = F.col("length") > WHOLE_BYTES
    hashes, large = hash_files(files.filter(~beyond)), files.filter(beyond)
    narrow = large.select("path", "file_name", "length")
    if narrow.isEmpty():
        return hashes
    layout = "path string, file_name string, length long, content_hash string"
    streamed = write_and_reread(narrow.mapInArrow(_digests, layout), folder)
    unopened = streamed.filter("content_hash IS NULL").select("path")
    hashes = hashes.unionByName(streamed.filter("content_hash IS NOT NULL"))
    return hashes if unopened.isEmpty() else hashes.unionByName(hash_files(large.join(unopened, "path", "left_semi")))


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[dict]:
        for batch in batches:
            for path, digest in zip(*(c.to_pylist() for c in batch.columns)):
                yield from file_rows(path, digest, lambda path=path: open_path(path))

    yield from _batches(rows())


def read_opened(files: DataFrame) -> DataFrame:
    """Chunks of records as of ``read_members``, of files (``path, content_hash``) that tasks open themselves."""
    partitions = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("path", "content_hash").repartition(partitions, "path").mapInArrow(_expand, _SPARK_OUT)


class Cutter:
    """Cuts the text of a split into records as ``iter_records`` does that of a file; whole lines are fed one text after another."""

    def __init__(self, inside: bool, keep: bool = True) -> None:
        self.inside, self.keep = inside, keep
        #: Whether the record that is open now began in an earlier split, and its parts so far.
        self.from_before, self.parts = inside, []

    def _hold(self, text: str) -> None:
        if self.keep or not self.parts:
            self.parts.append(text if self.keep else "")

    def feed(self, text: str) -> tuple[str | None, list[str]]:
        """(the end of a record begun before the split, records begun in it), as far as they end here."""
        if '"' not in text:
            if self.inside:
                self._hold(text)
                return None, []
            return None, [line for line in text.replace("\r\n", "\n").replace("\r", "\n").split("\n") if not _blank(line)]
        ended, records = None, []
        for line in io.StringIO(text, newline=""):
            if not self.inside and '"' not in line:
                if not _blank(line):
                    records.append(line.rstrip("\r\n"))
                continue
            self.inside = still_quoted(line, self.inside)
            self._hold(line)
            if not self.inside:
                record, self.parts = "".join(self.parts), []
                if self.from_before:
                    ended, self.from_before = record, False
                else:
                    records.append(record.rstrip("\r\n"))
        return ended, records


def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bytes, bool]]:
    """(file, split and what else is known of it, its next lines joined, whether a split begins). The first column is the lines."""
    before = None
    for batch in batches:
        lines, keys = batch.column(0).to_pylist(), list(zip(*(c.to_pylist() for c in batch.columns[1:])))
        at = 0
        while at < len(keys):
            end = at + 1
            while end < len(keys) and keys[end] == keys[at]:
                end += 1
            yield keys[at], b"\n".join(lines[at:end]) + b"\n", keys[at] != before
            before, at = keys[at], end


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, problems, counts, cutters = None, [], [], []

    def done() -> pa.RecordBatch:
        # An open record counts where it began.
        begun = [n + (bool(c.parts) and not c.from_before) for n, c in zip(counts, cutters)]
        return _rows(FACTS, [(*key, problems, cutters[0].inside, begun[0], cutters[1].inside, begun[1])])

    for now, data, begins in stretches(batches):
        if begins:
            if key:
                yield done()
            key, problems, counts, cutters = now, [None] * len(ENCODINGS), [0, 0], [Cutter(False, keep=False), Cutter(True, keep=False)]
        if not data.isascii():
            for i, name in enumerate(ENCODINGS):
                if problems[i] is None:
                    try:
                        data.decode(name)
                    except UnicodeDecodeError as e:
                        problems[i] = f"{name}: {e.reason}"
        text = data.decode("latin-1")  # quotes, commas and line breaks are the same bytes in all encodings
        for i, cutter in enumerate(cutters):
            counts[i] += len(cutter.feed(text)[1])
    if key:
        yield done()


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """State and record number at the start of each split, in their order; at the end of a file those after it, as split -1."""
    name, inside, number = None, False, 0
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["file_name"] != name:
                if name is not None:
                    out.append((name, -1, inside, number))
                name, inside, number = row["file_name"], False, 0
            out.append((name, row["block"], inside, number))
            state = "in" if inside else "out"
            inside, number = row[f"ends_inside_{state}"], number + row[f"records_{state}"]
        yield _rows(STARTS, out)
    if name is not None:
        yield _rows(STARTS, [(name, -1, inside, number)])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, cutter, number = None, None, 0

    def rest() -> Iterator[pa.RecordBatch]:
        if cutter and cutter.parts:
            yield _rows(CUT, [(key[0], key[3] - 1 if cutter.from_before else number, key[1], None, "".join(cutter.parts))])

    for now, data, begins in stretches(batches):
        if begins:
            yield from rest()
            key, cutter, number = now, Cutter(now[2]), now[3]
        ended, records = cutter.feed(data.decode(now[4]))
        if ended is not None:
            yield _rows(CUT, [(key[0], key[3] - 1, key[1], None, ended)])
        if records:
            yield _rows(CUT, [(key[0], number, key[1], records, None)])
            number += len(records)
    yield from rest()


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The header's bytes in the file's encoding."""
    for batch in batches:
        rows = batch.to_pylist()
        texts = [r["header"].decode(r["encoding"]).removeprefix("﻿") if r["encoding"] and r["header"] else None for r in rows]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["file_name", "header"])


# Tasks get the functions themselves, so the package need not be installed on every machine.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _scanned_name() -> Column:
    # File metadata has names as in a URL; a plus is no space there, as url_decode would have it.
    return F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B")))


def raw_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(line, file_name, block): bytes between line feeds, in the order of the file within each split, which ``block`` names."""
    lines = spark.read.option("lineSep", "\n").text([glob_literal(p) for p in paths])
    return lines.select(F.col("value").cast("binary").alias("line"), _scanned_name().alias("file_name"), F.col("_metadata.file_block_start").alias("block"))


def _layout(schema: pa.Schema) -> str:
    names = {pa.string(): "string", pa.int64(): "long", pa.bool_(): "boolean", pa.list_(pa.string()): "array<string>"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def split_states(lines: DataFrame, scratch: str) -> tuple[DataFrame, DataFrame]:
    """(state and record number at the start of each split, encoding and errors of each file), both written."""
    facts = write_and_reread(lines.mapInArrow(_facts, _layout(FACTS)), scratch)
    in_order = facts.drop("problems").repartition("file_name").sortWithinPartitions("file_name", "block")
    starts = write_and_reread(in_order.mapInArrow(_starts, _layout(STARTS)), scratch)
    problem: Callable[[int], Column] = lambda i: F.get("problems", i)
    first = [F.min(F.when(problem(i).isNotNull(), F.struct("block", problem(i).alias("what"))))["what"].alias(f"problem_{i}") for i in range(len(ENCODINGS))]
    votes = facts.groupBy("file_name").agg(*first)
    encoding = F.coalesce(*[F.when(F.col(f"problem_{i}").isNull(), F.lit(name)) for i, name in enumerate(ENCODINGS)])
    decode_error = F.concat_ws("; ", F.lit(NO_ENCODING), *[f"problem_{i}" for i in range(len(ENCODINGS))])
    ends = starts.filter("block = -1").select("file_name", F.col("inside").alias("open"))
    files = votes.withColumn("encoding", encoding).join(ends, "file_name")
    marks = files.select(
        "file_name",
        "encoding",
        F.when(F.col("encoding").isNull(), decode_error).alias("decode_error"),
        F.when(F.col("encoding").isNotNull() & F.col("open"), F.lit(UNCLOSED)).alias("error"),
    )
    return starts.filter("block >= 0"), write_and_reread(marks, scratch)


def read_splits(files: DataFrame, scratch: str) -> DataFrame:
    """Chunks of records as of ``read_members``, of plain files as ``survey`` tells of them. Every file has a row of its facts alone."""
    spark = files.sparkSession
    paths = {r.file_name: r.path for r in files.select("file_name", "path").collect()}  # one for each file beyond the size for splits
    starts, marks = split_states(raw_lines(spark, sorted(paths.values())), scratch)
    known = write_and_reread(files.drop("error").join(marks, "file_name", "left"), scratch)
    headers = known.select("file_name", "header", "encoding").mapInArrow(_headers, "file_name string, header string")
    facts = known.drop("header").join(headers, "file_name").select(
        "file_name", "path", "content_hash", F.lit(False).alias("is_archive"), F.lit(0).alias("member_no"), F.col("length").alias("n_bytes"),
        "encoding", "error", "decode_error", "head", "header",
    )
    facts = write_and_reread(facts, scratch)

    good = facts.filter("encoding IS NOT NULL AND error IS NULL").select("file_name", "encoding")
    names = sorted(paths[r.file_name] for r in good.select("file_name").collect())
    alone = facts.withColumns({"chunk_no": F.lit(0), "first_row": F.lit(0).cast("long")})
    if not names:
        return alone.drop("file_name")
    # One row for each split, so some hundred bytes for each 128 MB of input; a sort would undo the order of lines.
    states = F.broadcast(starts.join(good, "file_name"))
    lines = raw_lines(spark, names).join(states, ["file_name", "block"], "left")
    checked = F.coalesce("number", F.raise_error(F.lit("files or splits changed while they were read; run again")).cast("long"))
    cut = lines.select("line", "file_name", "block", "inside", checked.alias("number"), "encoding").mapInArrow(_cut, _layout(CUT))
    cut = write_and_reread(cut, scratch)
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "piece"))), lambda p: p["piece"]), "")
    pieces = cut.filter("piece IS NOT NULL").groupBy("file_name", "number").agg(F.array(F.regexp_replace(joined, "[\\r\\n]+$", "")).alias("records"))
    records = cut.filter("records IS NOT NULL").select("file_name", "number", "records").unionByName(pieces)
    # Record 0 is the header.
    rows = records.select(
        "file_name",
        F.greatest(F.col("number") - 1, F.lit(0)).alias("first_row"),
        F.when(F.col("number") == 0, F.slice("records", 2, F.greatest(F.size("records"), F.lit(1)))).otherwise(F.col("records")).alias("records"),
    ).filter(F.size("records") > 0)
    chunks = rows.join(facts, "file_name").withColumn("chunk_no", F.lit(0))
    return chunks.unionByName(alone, allowMissingColumns=True).drop("file_name")
