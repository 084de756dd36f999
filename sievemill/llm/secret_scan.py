"""Secret scans: patterns of well-known secrets, and stretches of high entropy in other strings that look like keys.

All is one expression over the text. A regular expression cuts the text into matches and what stands between them, whose lengths add up
to places. Over every candidate string a window of WINDOW characters slides: each step counts one character in and one out and changes
the sum of c log2 c over the counts c accordingly. The windows whose Shannon entropy reaches the limit of the string's character class
merge to spans. Sums are integers, in units of 1 / SCALE bits, so that they come out the same whatever way they are added.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns, by kind; the least length of a match, of its group 2 for assign.
ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
KINDS = ("assign", "access", "hex")
LEAST = {"assign": 6, "access": 20, "hex": 24}

WINDOW = 20
SCALE = 1 << 20
CANDIDATE = "[A-Za-z0-9+/_-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
#: Character classes: a candidate belongs to the first whose pattern it matches. Bits a character, of at most log2(WINDOW) = 4.32.
CLASSES = (("entropy_hex", "^[0-9A-Fa-f]+$", 3.0), ("entropy_base64", "", 3.8))
#: Candidates that are no secrets: letters or figures with separators (names, paths, dates), UUIDs, alphabets in order, placeholders,
#: digests that pages publish to be checked against.
ALLOWED = (
    "^[A-Za-z]+([+/_-]+[A-Za-z]+)*[+/_-]*$",
    "^[0-9+/_-]+$",
    "^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
    "0123456789|abcdefghij|ABCDEFGHIJ",
    "[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|[Pp][Ll][Aa][Cc][Ee][Hh][Oo][Ll][Dd][Ee][Rr]|[Xx]{6}|[Dd][Uu][Mm][Mm][Yy]",
    "^[Ss][Hh][Aa][0-9]+-",
)

BLOCK = 256
SPANS = "array<struct<start:int,end:int,kind:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def weighted(count: int) -> int:
    """c log2 c in units of 1 / SCALE."""
    return round(count * math.log2(count) * SCALE) if count else 0


def most_weight(bits: float) -> int:
    """The largest sum of c log2 c over the counts of a window whose entropy is ``bits`` or more."""
    return math.floor(WINDOW * (math.log2(WINDOW) - bits) * SCALE)


def running_starts(pieces: Column) -> Column:
    """Where each of ``pieces`` (gap, size: what is before it, and it) starts; block by block, as a list grows by being copied."""
    of = lambda e: e["gap"] + e["size"]
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / BLOCK).cast("int")), lambda b: F.slice(pieces, b * BLOCK + 1, BLOCK))
    totals = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda at, e: at + of(e)))

    def in_block(block: Column, offset: Column) -> Column:
        first = F.struct(offset.alias("at"), F.expr("cast(array() as array<int>)").alias("starts"))
        return F.aggregate(
            block,
            first,
            lambda a, e: F.struct((a["at"] + of(e)).alias("at"), F.array_append(a["starts"], a["at"] + e["gap"]).alias("starts")),
            lambda a: a["starts"],
        )

    def with_offsets(parts: Column) -> Column:
        offsets = F.aggregate(parts["totals"], F.array(F.lit(0)), lambda a, total: F.array_append(a, F.element_at(a, -1) + total))
        return F.flatten(F.zip_with(parts["blocks"], F.slice(offsets, 1, F.size(parts["blocks"])), in_block))

    return let(F.struct(blocks.alias("blocks"), totals.alias("totals")), with_offsets)


def occurrences(text: Column, pattern: str) -> Column:
    """(start, token) of all matches, leftmost and non-overlapping; places in code points."""

    def placed(parts: Column) -> Column:
        pieces = F.zip_with(
            F.slice(parts["gaps"], 1, F.size(parts["tokens"])),
            parts["tokens"],
            lambda gap, token: F.struct(F.char_length(gap).alias("gap"), F.char_length(token).alias("size")),
        )
        return F.zip_with(let(pieces, running_starts), parts["tokens"], lambda start, token: F.struct(start.alias("start"), token.alias("token")))

    parts = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("tokens"))
    return F.when(text.rlike(pattern), let(parts, placed)).otherwise(F.expr("cast(array() as array<struct<start:int,token:string>>)"))


def base_spans(text: Column) -> Column:
    """Spans of the patterns, by start, then kind as listed."""

    def spans(kind: str, pattern: str, size: Callable[[Column], Column]) -> Column:
        kept = F.filter(occurrences(text, pattern), lambda o: size(o["token"]) >= LEAST[kind])
        return F.transform(
            kept,
            lambda o: F.struct(
                o["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), (o["start"] + F.char_length(o["token"])).alias("end"), F.lit(kind).alias("kind")
            ),
        )

    # Of a run of allowed characters only all of it matches, so that shorter runs can be left to the pattern.
    found = F.concat(
        spans("assign", ASSIGN, lambda token: F.char_length(F.regexp_extract(token, ASSIGN, 2))),
        spans("access", ACCESS[:-1] + "{16,}+", F.char_length),
        spans("hex", HEX[:-1] + "{24,}+", F.char_length),
    )
    return F.transform(F.sort_array(found), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))


def dense_stretches(token: Column, limit: Column) -> Column:
    """(open, close) of the stretches of ``token``, from 1, whose windows weigh ``limit`` at most."""
    entering = F.array(*[F.lit(weighted(c + 1) - weighted(c)) for c in range(WINDOW)])
    leaving = F.array(*[F.lit(weighted(c) - weighted(c - 1) if c else 0) for c in range(WINDOW + 1)])

    def slide(codes: Column) -> Column:
        def step(a: Column, i: Column) -> Column:
            """Settles the window that ended before character i, then moves on to i."""
            dense = (i > WINDOW) & (a["weight"] <= limit)
            apart = i - WINDOW > a["close"] + 1
            new, old = F.coalesce(F.get(codes, i - 1), F.lit(0)), F.coalesce(F.get(codes, i - 1 - WINDOW), F.lit(0))
            change = F.when(new == old, 0).otherwise(
                F.when(new > 0, F.get(entering, F.get(a["counts"], new))).otherwise(0) - F.when(old > 0, F.get(leaving, F.get(a["counts"], old))).otherwise(0)
            )
            return F.struct(
                F.transform(a["counts"], lambda c, k: c + F.when(k == new, 1).otherwise(0) - F.when(k == old, 1).otherwise(0)).alias("counts"),
                (a["weight"] + change).alias("weight"),
                F.when(dense & apart, i - WINDOW).otherwise(a["open"]).alias("open"),
                F.when(dense, i - 1).otherwise(a["close"]).alias("close"),
                F.when(dense & apart & (a["open"] > 0), F.array_append(a["done"], F.struct(a["open"].alias("open"), a["close"].alias("close"))))
                .otherwise(a["done"])
                .alias("done"),
            )

        start = F.struct(
            F.array_repeat(F.lit(0), len(ALPHABET) + 1).alias("counts"), F.lit(0).alias("weight"), F.lit(0).alias("open"), F.lit(-1).alias("close"),
            F.expr("cast(array() as array<struct<open:int,close:int>>)").alias("done"),
        )
        last = lambda a: F.when(a["open"] > 0, F.array_append(a["done"], F.struct(a["open"].alias("open"), a["close"].alias("close")))).otherwise(a["done"])
        return F.aggregate(F.sequence(F.lit(1), F.size(codes) + 1), start, step, last)

    return let(F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c)), slide)


def entropy_spans(text: Column, allowed: Sequence[str]) -> Column:
    """Spans of high entropy in the candidates that no pattern of ``allowed`` is found in."""

    def in_candidate(o: Column) -> Column:
        kind, limit = F.lit(CLASSES[-1][0]), F.lit(most_weight(CLASSES[-1][2]))
        for name, pattern, bits in reversed(CLASSES[:-1]):
            mine = o["token"].rlike(pattern)
            kind, limit = F.when(mine, name).otherwise(kind), F.when(mine, most_weight(bits)).otherwise(limit)
        return F.transform(
            dense_stretches(o["token"], limit),
            lambda s: F.struct((o["start"] + s["open"] - 1).alias("start"), (o["start"] + s["close"]).alias("end"), kind.alias("kind")),
        )

    def suspicious(o: Column) -> Column:
        keep = F.lit(True)
        for pattern in allowed:
            keep = keep & ~o["token"].rlike(pattern)
        return keep

    return F.flatten(F.transform(F.filter(occurrences(text, CANDIDATE + "+"), suspicious), in_candidate))


def secrets(text: Column, allowed: Sequence[str] = ALLOWED) -> Column:
    """(base, added): spans (start, end, kind) of a text, in code points, end exclusive.

    ``base``: what the patterns find, by start, then kind as listed. ``added``: stretches of high entropy that touch no span of these,
    by start; ``allowed`` patterns keep a candidate string out. Null and empty texts have none, and rows all alike have the same. An
    expression over one column: other columns, whatever their names, and empty tables make no difference.
    """

    def both(found: Column) -> Column:
        clear = lambda s: ~F.exists(found["base"], lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        return F.struct(found["base"].cast(SPANS).alias("base"), F.filter(found["added"], clear).cast(SPANS).alias("added"))

    whole = F.coalesce(text, F.lit(""))
    return let(F.struct(base_spans(whole).alias("base"), entropy_spans(whole, allowed).alias("added")), both)
