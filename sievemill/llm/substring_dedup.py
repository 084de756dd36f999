"""Substring dedup: passages of ``window`` words or more that also stand elsewhere are removed.

Every window of ``window`` consecutive words gets two Rabin-Karp hashes, polynomials over the hashes of its words: 64 bits and
16 more of another base, 80 bits in all. Spark deals the hashes to buckets and windows whose hash occurs twice are told there; the
places of repeated windows go back to their documents, where they merge into maximal intervals.

1. A task gathers whole documents to chunks of some ``CHUNK_WORDS`` words and hashes all windows of a chunk at once. Windows that
   repeat within the chunk are noted there; of each distinct hash one place goes to its bucket. So a passage that a third of all
   documents hold sends a bucket one entry for each chunk, not for each document.
2. The entries of a chunk and bucket travel as one row, sorted by hash: differences, check bits and places, compressed.
3. A bucket returns the places of hashes that came from more than one chunk; a chunk's directory of documents travels along, by way
   of any bucket. By chunk, places become intervals of words in documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from sievemill.llm.common import columns_but, free_names, keyed, word_list

WINDOW = 35
CHUNK_WORDS = 1 << 20
#: Odd bases of the two polynomials, modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
DIRECTORY, PLACES = 0, 1
PACKED = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int8()), ("payload", pa.binary())])
INTERVALS = pa.schema(
    [("doc_id", pa.int64()), ("tid", pa.int64()), ("intervals", pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])))]
)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(tokens: np.ndarray, window: int, base: int) -> np.ndarray:
    """Polynomial of each ``window`` tokens in a row, modulo 2**64: windows of length a and b join to one of length a + b."""
    length, joined, power, hashes, weight = 0, None, 1, tokens, base
    with np.errstate(over="ignore"):
        while window >= power:
            if window & power:
                if joined is None:
                    joined, length = hashes, power
                else:
                    n = len(tokens) - length - power + 1
                    joined, length = joined[:n] * np.uint64(weight) + hashes[length : length + n], length + power
            n = len(tokens) - 2 * power + 1
            if n <= 0:
                break
            hashes = hashes[:n] * np.uint64(weight) + hashes[power : power + n]
            weight, power = weight * weight % 2**64, power * 2
    return joined


def pack(*columns: np.ndarray) -> bytes:
    """Columns of equal length, each byte plane by byte plane, compressed."""
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.itemsize).T).tobytes() for c in columns]
    return zstandard.compress(b"".join(planes), 1)


def unpack(payload: bytes, *kinds: type) -> list[np.ndarray]:
    data = np.frombuffer(zstandard.decompress(payload), np.uint8)
    n, out, at = len(data) // sum(np.dtype(k).itemsize for k in kinds), [], 0
    for kind in kinds:
        width = np.dtype(kind).itemsize
        planes = data[at : at + n * width].reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * width
    return out


def equal_runs(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by (first, second), and for each place in it but the first, whether it equals the place before."""
    order = np.argsort(first, kind="stable")
    same = first[order][1:] == first[order][:-1]
    if (same & (second[order][1:] != second[order][:-1])).any():
        order = np.lexsort((second, first))
        same = (first[order][1:] == first[order][:-1]) & (second[order][1:] == second[order][:-1])
    return order, same


def chunk_rows(chunk: int, docs: list[tuple], window: int, bits: int) -> Iterator[tuple]:
    """The directory of a chunk and its entries by bucket. docs: (doc_id, tid, hashes of words)."""
    sizes = np.array([len(t) for _, _, t in docs], np.int64)
    ends = np.cumsum(sizes)
    tokens = np.concatenate([t for _, _, t in docs])
    known = np.empty(0, np.uint32)
    if len(tokens) >= window:
        place = np.flatnonzero(np.arange(len(tokens)) + window <= np.repeat(ends, sizes))
        first = window_hashes(tokens, window, BASES[0])[place]
        second = (window_hashes(tokens, window, BASES[1])[place] >> np.uint64(48)).astype(np.uint16)
        order, same = equal_runs(first, second)
        first, second, place = first[order], second[order], place[order].astype(np.uint32)
        known = place[np.r_[same, False] | np.r_[False, same]]
        one = np.r_[True, ~same][: len(place)]
        first, second, place = first[one], second[one], place[one]
        bucket = (first >> np.uint64(64 - bits)).astype(np.int64)
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]][: len(bucket)])
        for a, b in zip(cuts, [*cuts[1:], len(bucket)]):
            yield int(bucket[a]), chunk, PLACES, pack(np.diff(first[a:b], prepend=np.uint64(0)), second[a:b], place[a:b])
    ids = np.array([d or 0 for d, _, _ in docs], np.int64)
    no_id = np.array([d is None for d, _, _ in docs], np.uint8)
    directory = pack(ids, np.array([t for _, t, _ in docs], np.int64), sizes, no_id)
    payload = len(directory).to_bytes(4, "little") + directory + pack(known)
    yield chunk % (1 << bits), chunk, DIRECTORY, payload


def packed_windows(window: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, words, number = [], 0, 0

        def flush() -> pa.RecordBatch:
            # The name of a chunk depends on what is in it: should a task be run again over rows in another order, places of the
            # old chunk would find no directory, instead of the wrong one.
            ids = np.array([(d or 0, t) for d, t, _ in docs], np.int64).tobytes()
            seed = TaskContext.get().partitionId() * 1_000_003 + number
            chunk = xxhash.xxh64_intdigest(ids, seed=seed & (2**64 - 1)) >> 1
            columns = zip(*chunk_rows(chunk, docs, window, bits))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PACKED)], schema=PACKED)

        for batch in batches:
            for doc_id, tid, text in zip(*(batch.column(c) for c in range(3))):
                hashes = word_hashes(word_list(text.as_py()))
                if len(hashes) >= window:
                    docs.append((doc_id.as_py(), tid.as_py(), hashes))
                    words += len(hashes)
                if words >= CHUNK_WORDS:
                    yield flush()
                    docs, words, number = [], 0, number + 1
        if docs:
            yield flush()

    return run


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[dict]]:
    """Rows that follow each other with the same key; rows are sorted by it."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0][key] != row[key]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def repeated_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the entries of a bucket, places by chunk of hashes with more than one entry; directories pass."""
    for rows in runs(batches, "bucket"):
        out = [(r["bucket"], r["chunk"], DIRECTORY, r["payload"]) for r in rows if r["kind"] == DIRECTORY]
        entries = [r for r in rows if r["kind"] == PLACES]
        if entries:
            parts = [unpack(r["payload"], np.uint64, np.uint16, np.uint32) for r in entries]
            of = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
            first = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
            order, same = equal_runs(first, np.concatenate([p[1] for p in parts]))
            again = np.sort(order[np.r_[same, False] | np.r_[False, same]])
            place = np.concatenate([p[2] for p in parts])[again]
            cuts = np.flatnonzero(np.r_[True, of[again][1:] != of[again][:-1]][: len(again)])
            for a, b in zip(cuts, [*cuts[1:], len(again)]):
                out.append((rows[0]["bucket"], entries[of[again[a]]]["chunk"], PLACES, pack(place[a:b])))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), PACKED)], schema=PACKED)


def merged(starts: np.ndarray, sizes: np.ndarray, window: int) -> Iterator[tuple[int, list[dict]]]:
    """(number of the document, its maximal intervals) from sorted starts of windows in a chunk of documents of these sizes."""
    ends = np.cumsum(sizes)
    doc = np.searchsorted(ends, starts, "right")
    new = np.r_[True, (doc[1:] != doc[:-1]) | (starts[1:] > starts[:-1] + window)]
    begins = np.flatnonzero(new)
    lasts = np.r_[begins[1:], len(starts)] - 1
    base = (ends - sizes)[doc[begins]]
    first, end = starts[begins] - base, starts[lasts] + window - base
    at = np.flatnonzero(np.r_[True, doc[begins][1:] != doc[begins][:-1]])
    for a, b in zip(at, [*at[1:], len(begins)]):
        yield int(doc[begins[a]]), [{"first": int(f), "end": int(e)} for f, e in zip(first[a:b], end[a:b])]


def document_intervals(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, "chunk"):
            if rows[0]["kind"] != DIRECTORY:
                raise RuntimeError("places of a chunk without its directory: the input's rows changed between two runs of a task")
            payload = rows[0]["payload"]
            size = int.from_bytes(payload[:4], "little")
            ids, tids, sizes, no_id = unpack(payload[4 : 4 + size], np.int64, np.int64, np.int64, np.uint8)
            places = [unpack(payload[4 + size :], np.uint32)[0], *(unpack(r["payload"], np.uint32)[0] for r in rows[1:])]
            starts = np.unique(np.concatenate(places)).astype(np.int64)
            if len(starts):
                out = [(None if no_id[d] else int(ids[d]), int(tids[d]), spans) for d, spans in merged(starts, sizes, window)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), INTERVALS)], schema=INTERVALS)

    return run


def repeated_intervals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, tid, intervals): the maximal intervals of words, [first, end), that repeated windows cover; one row for each document with any."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = max(1, (8 * partitions - 1).bit_length())  # eight buckets or more for each partition, so that hashing deals them evenly
    packed = "bucket int, chunk long, kind tinyint, payload binary"
    rows = keyed(docs, id_col, text_col).select(F.col("doc_id").cast("long"), "tid", "text").mapInArrow(packed_windows(window, bits), packed)
    places = rows.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(repeated_places, packed)
    by_chunk = places.repartition(partitions, "chunk").sortWithinPartitions("chunk", "kind")
    found = by_chunk.mapInArrow(document_intervals(window), "doc_id long, tid long, intervals array<struct<first:int,end:int>>")
    return found.dropDuplicates(["doc_id", "tid"])  # rows all alike have the same intervals


KEPT = T.StructType().add("n_words", T.LongType()).add("n_removed", T.LongType()).add("text", T.StringType())


@arrow_udf(KEPT)
def without(text: pa.Array, intervals: pa.Array) -> pa.Array:
    """The words of a text that are in no interval, joined by a space."""
    out = []
    for value, spans in zip(text, intervals):
        words, kept, at, removed = word_list(value.as_py()), [], 0, 0
        for span in spans.as_py() or ():
            kept += words[at : span["first"]]
            removed += span["end"] - span["first"]
            at = span["end"]
        kept += words[at:]
        out.append((len(words), removed, b" ".join(kept).decode("utf-8", "surrogatepass")))
    n_words, n_removed, kept_texts = zip(*out) if out else ((), (), ())
    return pa.StructArray.from_arrays(
        [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept_texts, pa.string())], ["n_words", "n_removed", "text"]
    )


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, out_col: str = "_kept"
) -> DataFrame:
    """All rows and columns of ``docs``, and ``out_col``: (n_words, n_removed, text left, words joined by a space).

    A word goes if a window that covers it also starts anywhere else, in the same document too. Null and empty texts, and those shorter
    than a window, lose nothing; rows all alike lose every word that a window covers; an empty table gives no rows. Ids are integers
    or null. A column that is called ``out_col`` already gives way to it; other columns may have any name.
    """
    key, spans = free_names(docs, "_intervals_of", "_intervals")
    found = repeated_intervals(docs, id_col, text_col, window).select(
        F.struct(F.col("doc_id").alias("id"), "tid").alias(key), F.col("intervals").alias(spans)
    )
    tid = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    joined = docs.join(found, F.col(id_col).eqNullSafe(F.col(f"{key}.id")) & (tid == F.col(f"{key}.tid")), "left")
    return joined.select(*columns_but(docs, out_col), without(F.col(text_col), F.col(spans)).alias(out_col))
