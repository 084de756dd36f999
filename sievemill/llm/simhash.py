"""SimHash near-dedup by anchor points of a covering code.

Fingerprints that differ in ``THRESHOLD`` bits or fewer are linked; documents that links connect form a component.

The anchors are the words of two [23, 12] Golay codes side by side, over the first 46 bits of a fingerprint. The code is perfect: every
23 bits lie within its covering radius 3 of exactly one word, so a fingerprint has one home anchor of the 2**24. Each fingerprint is
replicated to every anchor within covering radius plus threshold: a fingerprint at most 3 bits away is within 3 + a and 3 + b bits of its
own home in the two blocks, where a + b <= 3 bits are those that differ. Therefore the two meet at the home anchor of either, and there
all 64 bits are compared. About 300 anchors qualify; of them only those count that some fingerprint has as its home, which a bitmap of
all 2**24 anchors (2 MB, whatever the input) tells.

At an anchor the homes are compared with each replica that streams by, many anchors at once, and a spanning forest of the links leaves the task, never all
pairs. Components come from rounds of contraction: every fingerprint joins its smallest neighbour, and links between what has joined go to
the next round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from sievemill.llm.common import free_names, once, written

SHINGLE = 3
THRESHOLD = 3
#: The seed of the hash; length, radius and generator polynomial of the Golay code.
SEED = 42
LENGTH, RADIUS, GENERATOR = 23, 3, 0b110001110101
BLOCK = (1 << LENGTH) - 1
ANCHOR_BITS = 24
#: Bits that one row of the bitmap of homes has.
PIECE = 1 << 15


def fingerprint(text: str | None, shingle: int) -> int:
    """A bit is set if it is set in more than half of the shingles' hashes; no words: zero. A-Z are lower-cased, as bytes are."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    joined, width = b" ".join(words), min(shingle, len(words))
    begins, lasts = np.r_[0, ends[:-1] + 1][: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(begins, lasts)), np.uint64, len(begins))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):  # a bounded part at a time
        counts += np.unpackbits(hashes[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def simhash(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of each text as a signed long of the same bits."""

    def run(texts: pa.Array) -> pa.Array:
        found = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), np.uint64, len(texts))
        return pa.array(found.view(np.int64))

    return arrow_udf(run, T.LongType())(text)


def golay_tables() -> tuple[np.ndarray, list[list[np.ndarray]]]:
    """syndrome -> the error of weight 3 or less that has it; and, by excess e from 0 to THRESHOLD, syndrome -> all errors of weight 3 + e,
    or at most 3 for e = 0."""
    of_bit = np.zeros(LENGTH, np.uint32)
    for i in range(LENGTH):
        rest = 1 << i
        for k in range(i, 10, -1):
            if rest >> k & 1:
                rest ^= GENERATOR << (k - 11)
        of_bit[i] = rest
    leader, by_excess = np.zeros(1 << 11, np.uint32), []
    errors, syndromes, top = np.zeros(1, np.uint32), np.zeros(1, np.uint32), np.full(1, -1)
    within = [(errors, syndromes)]
    for weight in range(1, RADIUS + THRESHOLD + 1):
        more = [np.flatnonzero(top < i) for i in range(LENGTH)]
        errors, syndromes, top = (
            np.concatenate([errors[m] | np.uint32(1 << i) for i, m in enumerate(more)]),
            np.concatenate([syndromes[m] ^ of_bit[i] for i, m in enumerate(more)]),
            np.repeat(np.arange(LENGTH), [len(m) for m in more]),
        )
        within.append((errors, syndromes))
    near = [np.concatenate(x) for x in zip(*within[: RADIUS + 1])]
    leader[near[1]] = near[0]
    for e, s in [tuple(near), *within[RADIUS + 1 :]]:
        order = np.argsort(s, kind="stable")
        by_excess.append(np.split(e[order], np.searchsorted(s[order], np.arange(1, 1 << 11))))
    return leader, by_excess


def syndrome(block: np.ndarray) -> np.ndarray:
    rest = block.astype(np.uint32)
    for k in range(LENGTH - 1, 10, -1):
        rest = np.where(rest >> np.uint32(k) & np.uint32(1), rest ^ np.uint32(GENERATOR << (k - 11)), rest)
    return rest


def blocks(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (prints & np.uint64(BLOCK)).astype(np.uint32), (prints >> np.uint64(LENGTH) & np.uint64(BLOCK)).astype(np.uint32)


def anchor(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The number of a pair of code words; the upper 12 bits of a word of the cyclic code tell it."""
    return ((left >> np.uint32(11)) << np.uint32(12) | right >> np.uint32(11)).astype(np.int32)


def homes(prints: np.ndarray) -> np.ndarray:
    leader, _ = once(golay_tables)
    left, right = blocks(prints)
    return anchor(left ^ leader[syndrome(left)], right ^ leader[syndrome(right)])


def reached(prints: np.ndarray) -> Iterator[np.ndarray]:
    """For each fingerprint, all anchors that may be the home of one at most THRESHOLD bits away."""
    _, by_excess = once(golay_tables)
    left, right = blocks(prints)
    for x, y, s, t in zip(left, right, syndrome(left), syndrome(right)):
        at = []
        for e in range(THRESHOLD + 1):
            first = x ^ by_excess[e][s]
            second = y ^ np.concatenate([by_excess[f][t] for f in range(THRESHOLD + 1 - e)])
            at.append(anchor(np.repeat(first, len(second)), np.tile(second, len(first))))
        yield np.concatenate(at)


HOMES, REPLICAS = 0, 1
PACKED = pa.schema([("bucket", pa.int32()), ("kind", pa.int8()), ("anchors", pa.binary()), ("prints", pa.binary())])
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
#: Pairs that are compared at once.
AT_ONCE = 1 << 20


def home_bitmap(prints: DataFrame) -> np.ndarray:
    """One bit for each anchor: whether it is some fingerprint's home. 512 rows of 4 KB at most come to the driver."""

    def run(values: pa.Array) -> pa.Array:
        return pa.array(homes(values.to_numpy(zero_copy_only=False).view(np.uint64)))

    at = prints.select(arrow_udf(run, T.IntegerType())("print").alias("at"))
    pieces = at.groupBy(F.floor(F.col("at") / PIECE).cast("int").alias("piece")).agg(
        F.bitmap_construct_agg(F.col("at").cast("long") % PIECE).alias("bits")
    )
    out = np.zeros((1 << ANCHOR_BITS) // 8, np.uint8)
    for piece, bits in pieces.collect():
        out[piece * PIECE // 8 : (piece + 1) * PIECE // 8] = np.frombuffer(bits, np.uint8)
    return out


def packed(at: np.ndarray, prints: np.ndarray, kind: int, buckets: int) -> Iterator[tuple]:
    """One row for each bucket of anchors, its entries in the order of anchors."""
    bucket = at % buckets
    order = np.lexsort((at, bucket))
    at, prints, bucket = at[order], prints[order], bucket[order]
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]][: len(bucket)])
    for a, b in zip(cuts, [*cuts[1:], len(bucket)]):
        yield int(bucket[a]), kind, at[a:b].astype(np.int32).tobytes(), prints[a:b].tobytes()


def replicas(bitmap: np.ndarray, buckets: int):
    """Each fingerprint at its home and at every other anchor within reach that is some fingerprint's home: 300 entries at most, on average.
    Entries of a bucket of anchors travel together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):  # so that what is replicated at once is bounded
                prints = batch.column(0)[a : a + 4096].to_numpy(zero_copy_only=False).view(np.uint64)
                home, some = homes(prints), []
                for own, at in zip(home, reached(prints)):
                    at = at[(bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)]
                    some.append(at[at != own])
                rows = [*packed(home, prints, HOMES, buckets)]
                rows += packed(np.concatenate(some), np.repeat(prints, [len(x) for x in some]), REPLICAS, buckets)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), PACKED)], schema=PACKED)

    return run


class Bucket:
    """The homes of a bucket's anchors, and which of them links have already connected."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray]]):
        at, prints = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(at, kind="stable")
        self.at, self.prints, self.part = at[order], prints[order], np.arange(len(at))

    def join(self, print_: int, some: np.ndarray) -> Iterator[tuple[int, int]]:
        """Of the links from a fingerprint to these homes, the first and those that connect homes not connected yet."""
        for i in some:
            r, s = self.part[some[0]], self.part[i]
            if i == some[0] or r != s:
                self.part[self.part == s] = r
                yield print_, int(self.prints[i])

    def links(self, at: np.ndarray, prints: np.ndarray) -> Iterator[tuple[int, int]]:
        """One link from each fingerprint to the homes at its anchor, and those by which it connects several of them."""
        low, high = np.searchsorted(self.at, at, "left"), np.searchsorted(self.at, at, "right")
        upto = np.cumsum(high - low)
        begin = 0
        while begin < len(at):
            done = upto[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(upto, done + AT_ONCE, "right")))
            sizes = (high - low)[begin:end]
            which = np.repeat(np.arange(begin, end), sizes)
            home = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low[begin:end], sizes)
            apart = np.bitwise_count(prints[which] ^ self.prints[home])
            near = (apart <= THRESHOLD) & (apart > 0)
            which, home = which[near], home[near]
            # Of the homes that a fingerprint finds, one of each part is enough.
            _, first = np.unique(which * len(self.at) + self.part[home], return_index=True)
            which, home = which[np.sort(first)], home[np.sort(first)]
            cuts = np.flatnonzero(np.r_[True, which[1:] != which[:-1]][: len(which)])
            for a, b in zip(cuts, [*cuts[1:], len(which)]):
                yield from self.join(int(prints[which[a]]), home[a:b])
            begin = end


def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the links in each bucket. Rows come by bucket, homes first; only the homes of one bucket are held."""

    def found() -> Iterator[list[tuple[int, int]]]:
        number, parts, bucket = -1, [], None
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != number:
                    if parts and bucket is None:
                        bucket = Bucket(parts)
                        yield [*bucket.links(bucket.at, bucket.prints)]
                    number, parts, bucket = row["bucket"], [], None
                at, prints = np.frombuffer(row["anchors"], np.int32), np.frombuffer(row["prints"], np.uint64)
                if row["kind"] == HOMES:
                    parts.append((at, prints))
                    continue
                if bucket is None:
                    bucket = Bucket(parts)
                    yield [*bucket.links(bucket.at, bucket.prints)]
                yield [*bucket.links(at, prints)]
        if parts and bucket is None:
            bucket = Bucket(parts)
            yield [*bucket.links(bucket.at, bucket.prints)]

    for out in found():
        if out:
            pairs = np.array(out, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], schema=LINKS)


def contracted(pairs: DataFrame) -> DataFrame:
    """(node, part) of all nodes that have links; part is the smallest node of the component.

    In a round, every node joins the smallest of itself and its neighbours, and links are rewritten to what their ends joined. At least
    half of the nodes with links are gone after a round. The rounds' maps, each a written table, are then followed one after another.
    """
    rounds = []
    while True:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        joined = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("into")))
        rounds.append(joined)
        to_a, to_b = joined.toDF("a", "into_a"), joined.toDF("b", "into_b")
        moved = pairs.join(to_a, "a").join(to_b, "b").where("into_a != into_b")
        ends = F.least("into_a", "into_b").alias("a"), F.greatest("into_a", "into_b").alias("b")
        pairs = written(moved.select(*ends).distinct())
        if pairs.isEmpty():
            break
    out = rounds[0].toDF("node", "part")
    for later in rounds[1:]:
        out = out.join(later.toDF("part", "next"), "part", "left").select("node", F.coalesce("next", "part").alias("part"))
    return out


def with_components(prints: DataFrame) -> DataFrame:
    """(doc_id, print, part, component_id) of every row of the written table ``prints`` (doc_id, print).

    part tells components apart, also those that share their smallest id or have none.
    """
    distinct = written(prints.groupBy("print").agg(F.min("doc_id").alias("least_id")))
    partitions = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    only = distinct.select("print")
    # The table is small and the work for each of its rows is not, so all cores get some.
    replicated = only.repartition(partitions).mapInArrow(replicas(home_bitmap(only), 8 * partitions), "bucket int, kind tinyint, anchors binary, prints binary")
    by_bucket = replicated.repartition(partitions, "bucket").sortWithinPartitions("bucket", "kind")
    pairs = written(by_bucket.mapInArrow(links, "a long, b long").distinct())
    parts = contracted(pairs)
    named = distinct.join(parts, distinct["print"] == parts["node"], "left").select("print", "least_id", F.coalesce("part", "print").alias("part"))
    named = written(named)
    least = named.groupBy("part").agg(F.min("least_id").alias("component_id"))
    components = named.join(least, "part").select("print", "part", "component_id")
    return prints.join(components, "print")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, print, component_id) of every row: the fingerprint as a signed long, and the smallest id that links reach.

    Texts without words (null, empty, blank) have fingerprint zero and are linked like any other. Rows all alike share a fingerprint.
    A null id is never the smallest unless its component has no other. An empty table gives no rows. Very long texts are hashed whole.
    """
    prints = written(docs.select(F.col(id_col).alias("doc_id"), simhash(F.col(text_col), shingle).alias("print")))
    return with_components(prints).drop("part")


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one row left of each component, that of the smallest id, then fingerprint; all columns stay, whatever their names.

    Rows all alike are one row, as are those that share id and fingerprint. A null id stays only where its component has no other. Null
    and empty texts are one component. An empty table gives no rows.
    """
    (own,) = free_names(docs, "_own")
    # Written with the fingerprints, which are worked out once, and a number of the row; from here on rows travel as (id, fingerprint, number).
    known = F.struct(F.col(id_col).alias("doc_id"), simhash(F.col(text_col), shingle).alias("print"), F.monotonically_increasing_id().alias("place"))
    rows = written(docs.select("*", known.alias(own)))
    placed = rows.select(f"{own}.*")
    found = with_components(placed.select("doc_id", "print")).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stay = written(found.groupBy("part").agg(F.min("doc_id").alias("doc_id"), F.min("print").alias("print")).select("doc_id", "print"))
    same = (placed["print"] == stay["print"]) & placed["doc_id"].eqNullSafe(stay["doc_id"])
    places = placed.join(stay, same, "left_semi").groupBy("doc_id", "print").agg(F.min("place").alias("place"))
    # One bit for each row, 64 to a word: a table so small that Spark broadcasts it, and whole rows are not shuffled.
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("place") % 64).cast("int"))
    chosen = written(places.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits")))
    place = F.col(f"{own}.place")
    here = (F.shiftright(place, 6) == chosen["word"]) & (F.getbit(chosen["bits"], (place % 64).cast("int")) == 1)
    return rows.join(chosen, here, "left_semi").drop(own)
