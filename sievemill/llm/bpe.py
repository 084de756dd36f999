"""BPE encoding and decoding with word ends, for vocabulary files in the tokenizers library's JSON format.

Many words are encoded at once: their symbols lie in one flat array. In a round, all neighbouring pairs of a word are looked up by binary
search in the sorted pair keys; the lowest rank of each word is merged wherever it stands in the word, and words without a pair that
merges are done. Rounds go on until none is left. Words that a worker has met before are taken from a table of bounded size.

What the file's normalizer and pre-tokenizer do is done here: NFC, white space to a space, lower case, and words by the file's own pattern.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from sievemill.llm.common import once

#: Words whose ids a worker remembers; the table starts anew when it is full.
REMEMBERED = 200_000
#: Words that are encoded at once.
AT_ONCE = 20_000
NO_RANK = np.iinfo(np.int64).max
#: Fixed values. First and last of the characters that this box's regex module has as letters or numbers and the tokenizers library, with
#: older tables, has not; and capitals whose lower case the library knows and this Python does not.
NOT_YET_LETTERS = """
558 558 58b 58c 88f 88f c5c c5c cdc cdc 208f 208f 209d 209f a7ce a7cf a7dd a7dd a7e2 a7e2 a7f1 a7f1 ab6c ab6d 107bb 107bf
10940 10959 10ec5 10ec7 10ed9 10eee 11b0a 11b0a 11db0 11ddb 11de0 11de9 11df1 11df1 1246f 1246f 12475 1247f 12550 12686
16ea0 16eb8 16ebb 16ed3 16ff2 16ff6 187f8 187ff 18cd6 18cda 18d09 18d20 18d80 18df2 18e00 19191 191a0 191d2 1b123 1b128
1b168 1b168 1d6a6 1d6a6 1df1f 1df24 1df2b 1df81 1df90 1df96 1dfcd 1dfff 1e6c0 1e6de 1e6e0 1e6e2 1e6e4 1e6e5 1e6e7 1e6ed
1e6f0 1e6f4 1e6fe 1e6ff 2b73a 2b73f 2b81e 2b81e 2cea2 2cead 323b0 33479 3d000 3fc3f
"""
NEW_CAPITALS = {
    0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
    **{c: c + 0x20 for c in range(0x10D50, 0x10D66)}, **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}
#: Letters, numbers and white space up to U+00FF.
LATIN_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
LATIN_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
LATIN_SPACE = "\t-\r \x85\xa0"


def ranges(codes: list[str]) -> str:
    return "".join(f"\\U{int(a, 16):08x}-\\U{int(b, 16):08x}" for a, b in zip(codes[::2], codes[1::2]))


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if it is visible, else the next one from 256 on."""
    visible = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b if b in visible else 256 + hidden.index(b)) for b in range(256)]


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, ids = file["model"], file["model"]["vocab"]
        self.suffix = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.tokens = {i: t for t, i in (ids | self.special).items()}
        self.special_pattern = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")")
        pattern = next(p["pattern"]["Regex"] for p in file["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # The library's \s is white space as Unicode has it.
        pattern = pattern.replace(r"\s", r"\p{White_Space}")
        self.word = regex.compile(pattern)
        # The same for texts of Latin-1 alone, with the classes spelled out, for the faster module.
        spelled = ((r"\p{White_Space}", LATIN_SPACE), (r"\p{L}", LATIN_LETTER), (r"\p{N}", LATIN_NUMBER))
        latin = pattern
        for name, chars in spelled:
            latin = latin.replace(f"[{name}]+", f"[{chars}]+").replace(f"[{name}]", f"[{chars}]").replace(name, chars)
        self.latin_word = re.compile(latin)
        new = ranges(NOT_YET_LETTERS.split())
        self.unusual = regex.compile(f"[{new}{''.join(map(chr, NEW_CAPITALS))}]")
        for kind in (r"\p{L}", r"\p{N}"):
            pattern = pattern.replace(kind, f"[{kind}--[{new}]]")
        self.careful_word = regex.compile(pattern, regex.V1)
        symbols = byte_symbols()
        self.inner = np.array([ids[s] for s in symbols], np.int64)
        self.last = np.array([ids[s + self.suffix] for s in symbols], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.array([ids[p[k]] for p in pairs], np.int64) for k in (0, 1))
        key = left << 32 | right
        order = np.argsort(key)
        self.key, self.rank = key[order], order
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.known: dict[str, bytes] = {}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank[at], NO_RANK)

    def pair_ranks(self, symbols: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The rank of the pair that begins at each place; none where its word ends."""
        out, after = np.full(len(at), NO_RANK), np.minimum(at + 1, len(symbols) - 1)
        inside = (after > at) & (word[after] == word[at])
        out[inside] = self.ranks(symbols[at[inside]], symbols[after[inside]])
        return out

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word (not empty) as int32, all merged together round by round."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.array([len(r) for r in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols, word = self.inner[data], np.repeat(np.arange(len(raw)), sizes)
        ends = np.cumsum(sizes) - 1
        symbols[ends] = self.last[data[ends]]
        out = [b""] * len(raw)
        rank = self.pair_ranks(symbols, word, np.arange(len(symbols)))
        while len(symbols):
            begins = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.minimum.reduceat(rank, begins)
            lengths = np.diff(np.r_[begins, len(word)])
            done = best == NO_RANK
            flat = symbols.astype(np.int32).tobytes()
            for w, a, n in zip(word[begins[done]].tolist(), begins[done].tolist(), lengths[done].tolist()):
                out[w] = flat[4 * a : 4 * (a + n)]
            best = np.repeat(best, lengths)
            at = np.flatnonzero((rank == best) & (best != NO_RANK))
            # In a run such as a a a the pairs overlap: every other one from the left is merged.
            run = np.r_[True, at[1:] != at[:-1] + 1][: len(at)]
            since = np.arange(len(at)) - np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[since % 2 == 0]
            symbols[at] = self.merged[rank[at]]
            stay = best != NO_RANK
            stay[at + 1] = False
            moved = (np.cumsum(stay) - 1)[at]
            symbols, word, rank = symbols[stay], word[stay], rank[stay]
            changed = np.r_[moved, np.maximum(moved - 1, 0)]
            rank[changed] = self.pair_ranks(symbols, word, changed)
        return out

    def words(self, text: str) -> list[str]:
        """Words, normalised, with special tokens of the text as they are."""
        out: list[str] = []
        for part in self.special_pattern.split(text) if "<|" in text else (text,):
            if part in self.special:
                out.append(part)
            elif is_latin(part):
                out += self.latin_word.findall(part.lower())
            else:
                part = lower(unicodedata.normalize("NFC", part))
                if self.unusual.search(part):
                    out += self.careful_word.findall(part.translate(NEW_CAPITALS))
                else:
                    out += self.word.findall(part)
        return out

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [self.words(t or "") for t in texts]
        every = set().union(*split)
        new = every - self.known.keys()
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {}, every
        plain = sorted(new - self.special.keys())
        for at in range(0, len(plain), AT_ONCE):
            some = plain[at : at + AT_ONCE]
            self.known |= zip(some, self.encode_words(some))
        self.known |= {t: np.int32(i).tobytes() for t, i in self.special.items()}
        return [np.frombuffer(b"".join(map(self.known.__getitem__, ws)), np.int32) for ws in split]

    def decode(self, ids) -> str:
        """Tokens joined by a space, as the library does for a file without a decoder; special ones too, unknown ids left out."""
        return " ".join(filter(None, map(self.tokens.get, ids)))


def is_latin(text: str) -> bool:
    """Whether all of it is up to U+00FF. Such a text is in NFC."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def lower(text: str) -> str:
    """Lower case character by character: a sigma at a word's end is no special case."""
    return text.lower() if "Σ" not in text else "σ".join(p.lower() for p in text.split("Σ"))


def vocabulary(path: str) -> Vocabulary:
    return once(Vocabulary, path)


def id_lists(found: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, found)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int32), *found])))


def in_parts(texts: pa.Array, known: Vocabulary) -> list[np.ndarray]:
    return [ids for at in range(0, len(texts), 256) for ids in known.encode(texts[at : at + 256].to_pylist())]


def encode(text: Column, path: str) -> Column:
    """The ids of each text; null, empty and blank texts have none. ``path`` is a vocabulary file that every executor has."""
    return arrow_udf(lambda texts: id_lists(in_parts(texts, vocabulary(path))), T.ArrayType(T.IntegerType()))(text)


def decode(ids: Column, path: str) -> Column:
    """The text that ids stand for: what the vocabulary has for them, joined by spaces. Null is taken for no ids."""

    def run(lists: pa.Array) -> pa.Array:
        known = vocabulary(path)
        return pa.array([known.decode(x.as_py() or ()) for x in lists], pa.string())

    return arrow_udf(run, T.StringType())(ids)


def round_trip(text: Column, path: str) -> Column:
    """(ids, decoded) of each text: the ids, and what they are decoded to. As two calls Spark would encode each text twice."""

    def run(texts: pa.Array) -> pa.Array:
        known = vocabulary(path)
        ids = in_parts(texts, known)
        decoded = pa.array([known.decode(x.tolist()) for x in ids], pa.string())
        return pa.StructArray.from_arrays([id_lists(ids), decoded], ["ids", "decoded"])

    kind = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])
    return arrow_udf(run, kind)(text)
