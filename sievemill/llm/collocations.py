"""Phrase collocation mining: phrases that stand together more often than their parts would by chance.

Counting is a multikey three-way quicksort of pointers to suffixes, the up to ``longest`` words from a place to the end of its piece:
pointers are split by one word into smaller, equal and greater ones; the size of the equal part is the count of a phrase, and goes on at
the next word. A part whose pointers weigh less than ``least`` holds no frequent phrase and is abandoned unsorted.

1. Words are counted per language. Only words of ``least`` occurrences can be in a candidate; a bitmap of fixed size tells most others.
2. Tasks cut texts into suffixes of frequent words, merge equal ones of a chunk of documents to one with a weight, and route them by
   leading words: by the first word, and where that is one of the few hot ones, by the second as well, and so on to the first that is
   not hot. So the suffixes routed alike are at most as many as the occurrences of a word that is not hot, or are all alike.
3. Each bucket is sorted. Counts of prefixes that reach the word routed by are whole, and rare ones are abandoned there; prefixes of hot
   words alone are counted in parts, which Spark adds up. A bucket beyond ``SLICE`` suffixes is sorted slice by slice and counted in parts.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievemill.llm.common import LOWER, UPPER, written
from sievemill.llm.substring_dedup import pack, unpack

LEAST, LONGEST, MOST = 100, 5, 2000
#: The characters that end a piece, and the language of documents without one.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
NO_LANGUAGE = "und"
TO_PIECES = bytes.maketrans(UPPER.encode() + b"\t" + PIECE_ENDS, LOWER.encode() + b" " + b"\n" * len(PIECE_ENDS))

CHUNK_WORDS = 1 << 21
#: Words that a bucket is meant for, and suffixes that are sorted at once.
BUCKET_WORDS = 1 << 21
SLICE = 1 << 22
#: Bits of the bitmap of frequent words: 16 for each of them, and so many at most (16 MB).
BITMAP_BITS = 27
#: A word that holds more than one in so many of all words is common: there are no more of them, and they travel by rank (12 MB known to all).
COMMON = 1 << 20
SALTS = 64
COUNTS = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])
WORDS = pa.schema([*COUNTS, ("h", pa.int64())])
ROUTED = pa.schema([("bucket", pa.int64()), ("payload", pa.binary())])
COUNTED = pa.schema([("key", pa.binary()), ("n", pa.int64())])


def word_hash(lang: str, word: bytes, seed: int) -> int:
    """Never 0, which stands for the end of a suffix."""
    return max(1, xxhash.xxh3_64_intdigest(word, xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"), seed)))


class Numbers(dict):
    """Words of one language, numbered as they come."""

    def __init__(self, numbers: Iterator[int]) -> None:
        self.numbers = numbers

    def __missing__(self, word: bytes) -> int:
        self[word] = number = next(self.numbers)
        return number


class Chunk:
    """Words of some documents as numbers from 1; a 0 stands after each piece."""

    def __init__(self) -> None:
        self.numbers, self.languages, self.parts, self.size = itertools.count(1), {}, [], 0

    def add(self, lang: str | None, text: str | None) -> None:
        lang = NO_LANGUAGE if lang is None else lang
        if lang not in self.languages:
            self.languages[lang] = Numbers(self.numbers)
        number, out = self.languages[lang].__getitem__, []
        for piece in (text or "").encode("utf-8", "surrogatepass").translate(TO_PIECES).split(b"\n"):
            if words := piece.split():
                out += map(number, words)
                out.append(0)
        self.parts.append(np.array(out, np.int32))
        self.size += len(out)

    def tokens(self) -> np.ndarray:
        return np.concatenate(self.parts)

    def words(self) -> Iterator[tuple[str, bytes]]:
        """(language, word) by number."""
        known = [(number, lang, word) for lang, words in self.languages.items() for word, number in words.items()]
        return ((lang, word) for _, lang, word in sorted(known))

    def hashes(self, seed: int) -> np.ndarray:
        """Their hashes by number, that of 0 is 0."""
        return np.array([0, *(word_hash(lang, word, seed) for lang, word in self.words())], np.uint64)


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    chunk = Chunk()
    for batch in batches:
        for lang, text in zip(*batch.columns):
            chunk.add(lang.as_py(), text.as_py())
            if chunk.size >= CHUNK_WORDS:
                yield chunk
                chunk = Chunk()
    if chunk.size:
        yield chunk


def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches):
        counts, names = np.bincount(chunk.tokens())[1:], list(chunk.words())
        for at in range(0, len(names), 100_000):
            langs, words = zip(*names[at : at + 100_000])
            yield pa.RecordBatch.from_arrays([pa.array(langs), pa.array(words, pa.string()), pa.array(counts[at : at + 100_000], pa.int64())], schema=COUNTS)


def hashed_words(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            hashes = np.array([word_hash(lang, word.encode("utf-8", "surrogatepass"), seed) for lang, word in names], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hashes.view(np.int64))], schema=WORDS)

    return run


def suffix_columns(tokens: np.ndarray, longest: int) -> list[np.ndarray]:
    """The words of each suffix of two words or more, column by column; 0 past its end."""
    padded = np.r_[tokens, np.zeros(longest, tokens.dtype)]
    at = np.flatnonzero((padded[:-1] > 0) & (padded[1:] > 0))
    columns = [padded[at]]
    for d in range(1, longest):
        columns.append(np.where(columns[-1] > 0, padded[at + d], 0))
    return columns


def routes(columns: list[np.ndarray], hashes: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each suffix: by its words up to the first that is not hot. ``hashes`` and ``hot`` go by number of the word."""
    route, open_ = hashes[columns[0]], hot[columns[0]]
    with np.errstate(over="ignore"):
        for column in columns[1:]:
            route = np.where(open_, route * np.uint64(0x9E3779B97F4A7C15) + hashes[column], route)
            open_ = open_ & hot[column]
        route = (route ^ (route >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return ((route ^ (route >> np.uint64(32))) % np.uint64(buckets)).astype(np.int64)


def merged_suffixes(route: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(places of distinct suffixes, sorted by bucket; how often each occurs)."""
    pairs = [columns[d].astype(np.int64) << 32 | (columns[d + 1] if d + 1 < len(columns) else 0) for d in range(0, len(columns), 2)]
    order = np.lexsort([*pairs[::-1], route])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in [*pairs, route]:
        new[1:] |= key[order][1:] != key[order][:-1]
    first = np.flatnonzero(new)
    return order[first], np.diff(first, append=len(order))


def ranks(hashes: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The rank of each hash among the common ones (sorted, with their ranks), their number for others."""
    known, rank = common
    if not len(known):
        return np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, rank[at], len(known))


def routed_suffixes(frequent, hot_hashes: np.ndarray, buckets: int, longest: int, seed: int):
    """``frequent``: a broadcast of the bitmap of frequent words and of the common ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, common = frequent.value
        n_common = len(common[0])
        shift = np.uint64(64 - (8 * len(bits)).bit_length() + 1)
        for chunk in chunks(batches):
            hashes = chunk.hashes(seed)
            rank = ranks(hashes, common)
            bit = hashes >> shift
            known = (bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            known[0] = False
            # Words are numbered by rank, frequent ones first, so that the numbers pack well.
            order = np.flatnonzero(known)
            order = np.r_[0, order[np.argsort(rank[order], kind="stable")]]
            number = np.zeros(len(hashes), np.int32)
            number[order] = np.arange(len(order))
            hashes, rank = hashes[order], rank[order]
            columns = suffix_columns(number[chunk.tokens()], longest)
            route = routes(columns, hashes, np.isin(hashes, hot_hashes), buckets)
            place, weight = merged_suffixes(route, columns)
            route, columns = route[place], [c[place] for c in columns]
            cuts = np.flatnonzero(np.diff(route, prepend=-1))
            for a, b in zip(cuts, [*cuts[1:], len(route)]):
                # In each entry words are numbered anew: the end of a suffix, common words by rank, others.
                numbers, local = np.unique(np.concatenate([c[a:b] for c in columns]), return_inverse=True)
                numbers = numbers[numbers > 0]
                local += len(numbers) + 1 - (local.max() + 1)  # an entry without the end has no 0
                by_rank = numbers[rank[numbers] < n_common]
                parts = [
                    pack(np.diff(rank[by_rank], prepend=0).astype(np.uint32)),
                    pack(hashes[numbers[len(by_rank) :]]),
                    pack(*local.astype(np.uint32).reshape(longest, b - a), weight[a:b].astype(np.uint32)),
                ]
                payload = b"".join(len(p).to_bytes(4, "little") for p in parts[:2]) + b"".join(parts)
                yield pa.RecordBatch.from_arrays([pa.array([route[a]], pa.int64()), pa.array([payload], pa.binary())], schema=ROUTED)

    return run


def unpacked(payload: bytes, ranked: np.ndarray, longest: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(hashes by number from 1, columns of numbers, weights) of an entry; ``ranked``: hashes of common words by rank."""
    first, second = (8 + int.from_bytes(payload[:4], "little"), int.from_bytes(payload[4:8], "little"))
    by_rank = ranked[np.cumsum(unpack(payload[8:first], np.uint32)[0], dtype=np.int64)]
    others = unpack(payload[first : first + second], np.uint64)[0]
    *columns, weights = unpack(payload[first + second :], *[np.uint32] * (longest + 1))
    return np.r_[by_rank, others], columns, weights


def frequent_prefixes(columns: list[np.ndarray], weights: np.ndarray, hot: int, least: int) -> Iterator[tuple[int, int, int]]:
    """(a suffix, number of its leading words, occurrences of these) for all prefixes of two words or more that may be frequent.

    ``columns``: numbers of words, 0 past the end. Words up to number ``hot`` are hot: what is counted here of a prefix of such words alone
    is a part, given whatever its size. Of all other prefixes those of ``least`` occurrences are given.
    """
    stack: list[tuple[np.ndarray, int, bool]] = []

    def enter(at: np.ndarray, depth: int, in_parts: bool) -> None:
        word = columns[depth][at]
        if in_parts:
            stack.append((at[(word > 0) & (word <= hot)], depth, True))
        stack.append((at[word > (hot if in_parts else 0)], depth, False))

    enter(np.arange(len(weights)), 0, True)
    while stack:
        at, depth, in_parts = stack.pop()
        floor = 1 if in_parts else least
        if weights[at].sum() < floor:
            continue
        word = columns[depth][at]
        # The median of some words on the way, so that sorted suffixes are no bad case.
        some = np.sort(word[:: len(word) // 9 + 1])
        pivot = some[len(some) // 2]
        equal, below = at[word == pivot], at[word < pivot]
        if len(equal) + len(below) < len(at):
            stack.append((at[word > pivot], depth, in_parts))
        if len(below):
            stack.append((below, depth, in_parts))
        if (count := int(weights[equal].sum())) >= floor:
            if depth:
                yield int(equal[0]), depth + 1, count
            if depth + 1 < len(columns):
                enter(equal, depth + 1, in_parts)


def sorted_slice(entries: list[tuple], hot_hashes: np.ndarray, least: int) -> Iterator[pa.RecordBatch]:
    """Counts of the prefixes of some entries, unpacked."""
    # Numbers of the slice: 0 for the end, then the hot words, then the others.
    distinct = np.unique(np.concatenate([hashes for hashes, _, _ in entries]))
    is_hot = np.isin(distinct, hot_hashes)
    ordered = np.r_[np.zeros(1, np.uint64), distinct[is_hot], distinct[~is_hot]]
    number = np.empty(len(distinct), np.int32)
    number[np.r_[np.flatnonzero(is_hot), np.flatnonzero(~is_hot)]] = np.arange(1, len(ordered))
    local = [np.r_[np.zeros(1, np.int32), number[np.searchsorted(distinct, hashes)]] for hashes, _, _ in entries]
    columns = [np.concatenate(parts) for parts in zip(*([of[c] for c in columns] for of, (_, columns, _) in zip(local, entries)))]
    weights = np.concatenate([w for _, _, w in entries]).astype(np.int64)
    found = frequent_prefixes(columns, weights, int(is_hot.sum()), least)
    while some := list(itertools.islice(found, 50_000)):
        keys = [ordered[[c[at] for c in columns[:size]]].astype(">u8").tobytes() for at, size, _ in some]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([n for _, _, n in some], pa.int64())], schema=COUNTED)


def bucket_counts(frequent, hot_hashes: np.ndarray, least: int, longest: int):
    """Rows come sorted by bucket. A bucket of more than SLICE suffixes is counted in parts, none of which may be left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = frequent.value[1]
        ranked = np.empty_like(known)
        ranked[rank] = known
        rows = ((b, p) for batch in batches for b, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        for _, group in itertools.groupby(rows, key=lambda row: row[0]):
            held, size, cut = [], 0, False
            for _, payload in group:
                if size >= SLICE:
                    yield from sorted_slice(held, hot_hashes, 1)
                    held, size, cut = [], 0, True
                held.append(unpacked(payload, ranked, longest))
                size += len(held[-1][2])
            yield from sorted_slice(held, hot_hashes, 1 if cut else least)

    return run


def counted_words(texts: DataFrame, least: int) -> tuple[DataFrame, int]:
    """(lang, word, n, h) of all words, written, and the seed under which no word shares its hash with a frequent one."""
    parts = texts.mapInArrow(word_counts, "lang string, word string, n long")
    counts = written(parts.groupBy("lang", "word").agg(F.sum("n").alias("n")))
    for seed in itertools.count():
        words = written(counts.mapInArrow(hashed_words(seed), "lang string, word string, n long, h long"))
        shared = words.groupBy("h").agg(F.count(F.lit(1)).alias("words"), F.max("n").alias("most"))
        if shared.where((F.col("words") > 1) & (F.col("most") >= least)).isEmpty():
            return words, seed


def word_bitmap(frequent: DataFrame, n_words: int) -> np.ndarray:
    """Bits by the upper bits of the hashes of frequent words; put together in Spark, in pieces of 4 KB."""
    bits = min(BITMAP_BITS, max(20, (16 * n_words).bit_length()))
    at = F.shiftrightunsigned("h", 64 - bits) + 1
    pieces = frequent.select(F.bitmap_bucket_number(at).alias("piece"), F.bitmap_bit_position(at).alias("bit"))
    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    for row in pieces.groupBy("piece").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        piece = np.frombuffer(row.bits, np.uint8)
        bitmap[(row.piece - 1) * 4096 :][: len(piece)] = piece
    return bitmap


def frequent_phrases(
    texts: DataFrame, words: DataFrame, seed: int, least: int, longest: int, spread: int | None
) -> DataFrame:
    """(key, n) of the phrases of 2 to ``longest`` words; the key is the hashes of the words, 8 bytes each."""
    spark = texts.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    frequent = words.where(F.col("n") >= least)
    # Words of more than a share of all: at most as many as there are shares. Hot ones have more than a partition's share.
    common = frequent.where(F.col("n") > total // COMMON).select("h", "n").toArrow()
    hashes, sizes = common.column(0).to_numpy().view(np.uint64), common.column(1).to_numpy()
    hot_hashes = hashes[sizes > total // min(spread or partitions, COMMON)]
    by_hash, rank = np.argsort(hashes), np.empty(len(hashes), np.int32)
    rank[np.lexsort([hashes, -sizes])] = np.arange(len(hashes))
    known = (word_bitmap(frequent, frequent.count()), (hashes[by_hash], rank[by_hash]))
    broadcast = spark.sparkContext.broadcast(known)
    # As many buckets for every partition, and few: an entry carries the hashes of its words, which tell when it is large.
    buckets = partitions * max(1, -(-total // (partitions * BUCKET_WORDS)))
    routed = texts.mapInArrow(routed_suffixes(broadcast, hot_hashes, buckets, longest, seed), "bucket long, payload binary")
    dealt = routed.repartitionById(partitions, (F.col("bucket") % partitions).cast("int")).sortWithinPartitions("bucket")
    counts = dealt.mapInArrow(bucket_counts(broadcast, hot_hashes, least, longest), "key binary, n long")
    return written(counts.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least))


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST, most: int = MOST,
    spread: int | None = None,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``most`` best phrases of each language.

    A phrase is 2 to ``longest`` words of one piece; pieces end at PIECE_ENDS, words at spaces and tabs, and A-Z are lower-cased. ``a`` is
    its occurrences, at least ``least``, ``n`` those of all words of the language. Of the cuts in two the one of lowest
    floor(1000 a n / (l r)) counts, where ``l`` and ``r`` are the occurrences of the parts, the first one on a tie. A phrase that stands
    in a longer one with as many occurrences is left out. ``spread`` sets how many words at most are routed as hot (default: the shuffle
    partitions), and changes no result.

    Null texts are empty, a null language counts as NO_LANGUAGE, rows all alike count each; an empty table gives no rows. Other columns
    of ``docs`` are not looked at.
    """
    texts = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    words, seed = counted_words(texts, least)
    phrases = frequent_phrases(texts, words, seed, least, longest, spread)
    totals = words.groupBy("lang").agg(F.sum("n").alias("words_of_lang"))
    single = words.where(F.col("n") >= least).select(F.unhex(F.lpad(F.hex("h"), 16, "0")).alias("key"), "lang", "word", "n")
    counts = phrases.unionByName(single.select("key", "n"))

    # Whatever holds a phrase as often as the phrase occurs, also holds one longer by a word as often.
    inner = phrases.where(F.octet_length("key") > 16).select(
        F.explode(F.array(F.expr("substring(key, 1, octet_length(key) - 8)"), F.expr("substring(key, 9)"))).alias("key"), "n"
    )
    own = phrases.join(inner, ["key", "n"], "left_anti")
    cuts = own.select(F.col("key").alias("phrase_key"), F.col("n").alias("a"), F.explode(F.expr("sequence(1, octet_length(key) div 8 - 1)")).alias("cut"))
    cuts = cuts.select("*", F.expr("substring(phrase_key, 1, 8 * cut)").alias("left_key"), F.expr("substring(phrase_key, 8 * cut + 1)").alias("right_key"))
    languages = single.select(F.col("key").alias("first_key"), "lang").join(totals, "lang")
    parted = (
        cuts.join(counts.select(F.col("key").alias("left_key"), F.col("n").alias("l")), "left_key")
        .join(counts.select(F.col("key").alias("right_key"), F.col("n").alias("r")), "right_key")
        .withColumn("first_key", F.expr("substring(phrase_key, 1, 8)"))
        .join(languages, "first_key")
    )
    wide = "cast({} as decimal(19, 0))"
    score = F.expr(f"1000 * {wide.format('a')} * {wide.format('words_of_lang')} div ({wide.format('l')} * {wide.format('r')})")
    best = parted.groupBy("phrase_key", "lang", "a", "words_of_lang").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best"))
    scored = best.select("phrase_key", "lang", "a", F.col("words_of_lang").alias("n"), "best.score", "best.l", "best.r")

    # Ranks among a part of a language's phrases leave few for the rank among all, which wants the texts for ties.
    order = [F.desc("score"), F.desc("a")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase_key"), F.lit(SALTS))).orderBy(*order)
    few = written(scored.withColumn("of_part", F.rank().over(part)).where(F.col("of_part") <= most).drop("of_part"))
    keys = few.select("phrase_key", F.posexplode(F.expr("transform(sequence(0, octet_length(phrase_key) div 8 - 1), i -> substring(phrase_key, 8 * i + 1, 8))")).alias("at", "key"))
    named = keys.join(single.select("key", "word"), "key").groupBy("phrase_key").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
    phrase = F.array_join(F.transform("words", lambda w: w["word"]), " ")
    ranked = few.join(named, "phrase_key").withColumn("phrase", phrase)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("long"))
    return ranked.where(F.col("rank") <= most).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
