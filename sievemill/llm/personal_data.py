"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds what the patterns miss.

The field works on stretches of a text that may hold an entity: around an @ or a disguised one, and runs of figures and the signs
between them. A stretch is cut into atoms (letters, figures, white space, single signs). Candidate segments are runs of at most ``MOST_ATOMS``
atoms; features look at a whole candidate: how its figures are grouped, by what, its checksum, its surroundings. Dynamic programming
over the ends of bounded segments chooses boundaries and kinds together.

Weights are learned from the corpus itself, by likelihood: stretches whose patterns are sure teach their kinds, those with a match
that failed its check (a wrong checksum, a number above 255) teach nothing. Variants of sure ones, a phone without its country code or an
address with a disguised @, stand for forms that patterns miss, and dates, amounts and serial numbers for what is no entity.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from sievemill.llm.common import written

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)
#: The patterns. A match of ip starts at a run's first figure and takes runs whole, which finds the same and stays linear.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
FIGURES = re.compile(r"[0-9][0-9\x20.()+-]*")
DISGUISED = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[\[({] ?at ?[\])}] ?[A-Za-z0-9-]{1,64}(?:(?:\.| ?[\[({] ?dot ?[\])}] ?)[A-Za-z0-9-]{1,64}){1,8}", re.I)
#: What every match of DISGUISED holds; texts without it are spared the longer search.
AT = re.compile(r"[\[({] ?at ?[\])}]", re.I)
ATOM = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.S)
#: Atoms, joined by NUL, before the end of a disguised domain, and around a disguised @.
DOT_BEFORE = re.compile(r"[^\W\d_]*dot\0(?: \0)?[\])}](?:\0 )?$", re.I)
AT_BEFORE, AT_AFTER = re.compile(r"[\[({](?:\0 )?$"), re.compile(r"(?: \0)?[\])}]")

#: A candidate without an @, or one disguised, has this many figures; no card, phone or ip has more.
LEAST_FIGURES, MOST_FIGURES = 7, 19
MOST_ATOMS, MOST_CHARS = 40, 160
#: So many first atoms have their candidates made at a time.
PIECE = 2_048
#: Stretches that weights are learned from, of each kind those whose text has the smallest hash; the driver gets at most so many of each kind.
STRETCHES = 1_500
PLACES = 1 << 12
FIGURE = "0123456789"
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^`{|}~"
#: For hashes of the sizes of up to eight groups.
BASE = 0x9E3779B1
INVERSE = pow(BASE, -1, 1 << 64)


def luhn(figures: str) -> bool:
    total = sum(int(f) if i % 2 == 0 else sum(divmod(2 * int(f), 10)) for i, f in enumerate(reversed(figures)))
    return total % 10 == 0


def only_figures(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int, int]]:
    """Matches of LOCAL+@DOMAIN from the left, found from each @; so a long run of letters is walked once."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text[start - 1]):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield 0, start, done
        at = text.find("@", max(at + 1, done))


def figure_runs(text: str) -> Iterator[tuple[int, int]]:
    """Runs of figures and what may stand between them, with a sign before the first; all matches of figures lie within one."""
    for m in FIGURES.finditer(text):
        start = m.start()
        while start and text[start - 1] in "+(":
            start -= 1
        yield start, m.end()


def base_spans(text: str, runs: list[tuple[int, int]] | None = None, failed: list | None = None) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns' matches that pass their checks; those that fail go to ``failed``."""
    out = [*emails(text)]
    for start, end in figure_runs(text) if runs is None else runs:
        run = text[start:end]
        for kind, pattern in ((1, IP), (2, CARD), (3, PHONE)):
            for m in pattern.finditer(run):
                figures = only_figures(m[0])
                if kind == 1:
                    good = all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split("."))
                elif kind == 2:
                    good = 13 <= len(figures) <= 19 and luhn(figures)
                else:
                    good = 9 <= len(figures) <= 15
                if good:
                    out.append((kind, start + m.start(), start + m.end()))
                elif failed is not None and (kind != 2 or 13 <= len(figures) <= 19):
                    failed.append((kind, start + m.start(), start + m.end()))
    return sorted(out)


def stretches(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Where an entity may be; what touches or overlaps is one stretch."""
    found = [r for r in runs if r[1] - r[0] >= LEAST_FIGURES and len(only_figures(text[r[0] : r[1]])) >= LEAST_FIGURES]
    at = text.find("@")
    while at >= 0:
        start = end = at
        while start and at - start < MOST_CHARS and not text[start - 1].isspace():
            start -= 1
        while end < len(text) and end - at < MOST_CHARS and not text[end].isspace():
            end += 1
        found.append((start, end))
        at = text.find("@", end)
    if AT.search(text):
        found += [m.span() for m in DISGUISED.finditer(text)]
    out: list[tuple[int, int]] = []
    for start, end in sorted(found):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


# --- candidates and their features ------------------------------------------------------------------------------------


def surrounding(char: str) -> int:
    """What kind of character it is: none 0, space 1, figure 2, letter 3, any other by itself."""
    return 0 if not char else 1 if char.isspace() else 2 if char.isdigit() else 3 if char.isalpha() else 4 + ord(char)


def places(name: int, *values: np.ndarray) -> np.ndarray:
    """The places of a feature's values: their hashes by name, modulo PLACES."""
    value = np.full(len(values[0]), name + 1, np.uint64)
    for v in values:
        value = (value ^ v.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(32)
        value *= np.uint64(0xD6E8FEB86659FD93)
        value ^= value >> np.uint64(32)
    return (value % np.uint64(PLACES)).astype(np.int64)


def since_start(values) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(np.array(values, np.int64))])


class Atoms:
    """Arrays over the atoms of some stretches of a text, from which the features of any run of atoms follow in a few steps."""

    def __init__(self, text: str, pieces: list[tuple[int, int]]):
        cut = [ATOM.findall(text[a:b]) for a, b in pieces]
        atoms = [a for piece in cut for a in piece]
        count = np.array([len(piece) for piece in cut], np.int64)
        # What is true of an atom by itself is worked out once for equal ones.
        number: dict[str, int] = {}
        which = np.fromiter((number.setdefault(a, len(number)) for a in atoms), np.int64, len(atoms))

        def each(value, kind=np.int64) -> np.ndarray:
            return np.array([value(a) for a in number], kind)[which]

        self.piece = np.repeat(np.arange(len(pieces)), count)
        size, heads = each(len), since_start(count)
        begun = since_start(size)
        offset = np.array([a for a, _ in pieces], np.int64) - begun[heads[:-1]]
        self.start = begun[:-1] + offset[self.piece]
        self.end = self.start + size

        figure = each(lambda a: len(a) if a[0] in FIGURE else 0)
        digits = np.frombuffer("".join([a for a in atoms if a[0] in FIGURE]).encode(), np.uint8).astype(np.int64) - 48
        doubled, odd = 2 * digits - 9 * (digits > 4), np.arange(len(digits)) % 2 == 1
        # Sums of figures, those at even places doubled, and those at odd ones.
        self.luhn = [since_start(np.where(odd, digits, doubled)), since_start(np.where(odd, doubled, digits))]
        self.figures, self.groups = since_start(figure), since_start(figure > 0)
        self.large = since_start(each(lambda a: a[0] in FIGURE and (len(a) > 3 or int(a) > 255)))
        lengths = figure[figure > 0].astype(np.uint64)
        self.power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(lengths), BASE, np.uint64)]))
        backwards = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(lengths), INVERSE, np.uint64)]))
        self.sizes = np.concatenate([np.zeros(1, np.uint64), np.cumsum(lengths * backwards[:-1])])
        self.letters = since_start(each(lambda a: 0 if a[0] in FIGURE else sum(map(str.isalpha, a))))
        self.spaces, self.dots, self.ats = (since_start(each(lambda a, c=c: a.count(c))) for c in " .@")
        self.at_words = since_start(each(lambda a: a == "@" or a.lower() == "at"))
        self.signs = each(lambda a: 1 << SIGNS.find(a) if a in SIGNS else 0 if a[0].isspace() or a[0].isalnum() or a == "_" else 1 << len(SIGNS))
        self.blank, self.closes = each(str.isspace, bool), each(lambda a: a[0].isalnum(), bool)
        self.plus = each(lambda a: a == "+", bool)
        self.first, self.last = (each(lambda a, k=k: surrounding(a[k])) for k in (0, -1))
        self.before, self.after = np.append(0, self.last)[: len(atoms)], np.append(self.first, 0)[1:]
        full = np.flatnonzero(count)
        self.before[heads[full]] = [surrounding(text[pieces[k][0] - 1] if pieces[k][0] else "") for k in full]
        self.after[heads[full + 1] - 1] = [surrounding(text[pieces[k][1] : pieces[k][1] + 1]) for k in full]
        # By last atom: the first atom of a disguised @ that ends there, and of a domain's ending; -1 for none.
        self.at_from, self.dot_from = np.full(len(atoms), -1), np.full(len(atoms), -1)
        for k in np.flatnonzero(each(lambda a: len(a) > 1 and a.isascii() and a.isalpha(), bool)).tolist():
            own = atoms[heads[self.piece[k]] : k] if k - heads[self.piece[k]] < 5 else atoms[k - 5 : k]
            if own and own[-1] == ".":
                self.dot_from[k] = k - 1
            elif m := DOT_BEFORE.search("\0".join(own)):
                self.dot_from[k] = k - 1 - m[0].count("\0")
            if atoms[k].lower() == "at" and (m := AT_BEFORE.search("\0".join(own))):
                rest = atoms[k + 1 : min(k + 3, heads[self.piece[k] + 1])]
                if n := AT_AFTER.match("\0".join(rest)):
                    self.at_from[k + 1 + n[0].count("\0")] = k - 1 - m[0].count("\0")

    def __len__(self) -> int:
        return len(self.blank)

    def candidates(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first atoms, atoms after the last, features) of the candidates that begin at atoms low to high - 1, in that order."""
        found, start = [], low + np.flatnonzero(~self.blank[low:high])
        signs, at, dotted = np.zeros(len(start), np.int64), np.zeros(len(start), bool), np.zeros(len(start), bool)
        for width in range(1, MOST_ATOMS + 1):
            last = start + width - 1
            inside = self.piece[np.minimum(last, len(self) - 1)] == self.piece[start]
            inside &= last < len(self)
            if not inside.all():
                start, last, signs, at = start[inside], last[inside], signs[inside], at[inside]
            if not len(start):
                break
            signs, at = signs | self.signs[last], at | (self.at_from[last] >= start)
            figures, fits = self.figures[last + 1] - self.figures[start], self.end[last] - self.start[start] <= MOST_CHARS
            has_at = self.at_words[last + 1] > self.at_words[start]
            enough = (figures >= LEAST_FIGURES) & (figures <= MOST_FIGURES) | has_at | (figures >= 4) & (figures <= MOST_FIGURES) & (width > 6)
            good = np.flatnonzero(fits & enough & self.closes[last])
            dotted = self.dot_from[last] >= start
            found.append((start[good], last[good] + 1, signs[good], at[good], dotted[good]))
            more = fits & ((figures <= MOST_FIGURES) | has_at)
            # A run that is too long or has too many figures stays so, but for an @ that may follow.
            more |= fits & (self.at_words[np.minimum(start + MOST_ATOMS, len(self))] > self.at_words[start])
            start, signs, at = start[more], signs[more], at[more]
        first, after, signs, at, dotted = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 5
        order = np.lexsort((after, first))
        first, after, signs, at, dotted = first[order], after[order], signs[order], at[order], dotted[order]
        return first, after, self.features(first, after, signs, at, dotted)

    def features(self, i: np.ndarray, j: np.ndarray, signs: np.ndarray, at: np.ndarray, dotted: np.ndarray) -> np.ndarray:
        def inside(sums: np.ndarray) -> np.ndarray:
            return sums[j] - sums[i]

        figures, groups, letters = inside(self.figures), inside(self.groups), inside(self.letters)
        few = groups <= 8
        sizes = (self.sizes[self.groups[j]] - self.sizes[self.groups[i]]) * self.power[self.groups[i]]
        in_luhn = np.where(self.figures[j] % 2 == 0, *(s[self.figures[j]] - s[self.figures[i]] for s in self.luhn))
        card = (figures >= 13) & (figures <= 19)
        first, last, before, after = self.first[i], self.last[j - 1], self.before[i], self.after[j - 1]
        named = [
            (np.minimum(figures, MOST_FIGURES + 2),), (np.where(few, sizes, np.uint64(0)), few), (np.minimum(groups, 9),), (signs,), (self.plus[i],),
            (signs >> SIGNS.index("(") & 1,), (np.minimum(letters, 3), figures > 8), (np.minimum(inside(self.spaces), 5),),
            (card & (in_luhn % 10 == 0), card), ((groups == 4) & (inside(self.large) == 0), np.minimum(inside(self.dots), 9)),
            (np.minimum(inside(self.ats), 9), at), (dotted,), (first,), (last,), (before,), (after,), (before, first), (np.ones(len(i), bool),),
        ]
        return np.stack([places(k, *f) for k, f in enumerate(named)], axis=1)


@dataclass
class Lattice:
    """Ends of a stretch's atoms and the candidates among their runs: (first atom, atom after the last), features of each."""

    ends: list[int]
    candidates: list[tuple[int, int]]
    table: np.ndarray


def lattice(text: str, start: int, end: int) -> Lattice:
    atoms = Atoms(text, [(start, end)])
    first, after, table = atoms.candidates(0, len(atoms))
    return Lattice(atoms.end.tolist(), list(zip(first.tolist(), after.tolist())), table)


def joint(n: int, first: list[int], after: list[int], kinds: list[int], values: list[float]) -> list[tuple[int, int, int]]:
    """(kind, first atom, atom after the last) of the segmentation of the largest score, among candidates of positive score in order of their ends."""
    best, back, c = [0.0] * (n + 1), [-1] * (n + 1), 0
    for j in range(1, n + 1):
        top, by = best[j - 1], -1
        while c < len(after) and after[c] == j:
            if (v := best[first[c]] + values[c]) > top:
                top, by = v, c
            c += 1
        best[j], back[j] = top, by
    out, j = [], n
    while j:
        if back[j] < 0:
            j -= 1
        else:
            out.append((kinds[back[j]], first[back[j]], j))
            j = first[back[j]]
    return out[::-1]


def positive(first: np.ndarray, after: np.ndarray, table: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """First atoms, ends, kinds and scores of the candidates that one kind has a positive score for."""
    scores = weights[:, table].sum(2)
    values = scores.max(0)
    good = np.flatnonzero(values > 0)
    return first[good], after[good], scores[:, good].argmax(0), values[good]


def best_of(n: int, parts: list[tuple[np.ndarray, ...]]) -> list[tuple[int, int, int]]:
    first, after, kinds, values = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((first, after))
    return joint(n, first[order].tolist(), after[order].tolist(), kinds[order].tolist(), values[order].tolist())


def best_segments(lat: Lattice, weights: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind, first atom, atom after the last) of the segmentation of the largest score; atoms outside of entities score 0."""
    if not lat.candidates:
        return []
    first, after = np.array(lat.candidates).T
    return best_of(len(lat.ends), [positive(first, after, lat.table, weights)])


def entities(text: str, pieces: list[tuple[int, int]], weights: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the best segmentation of some stretches of any length.

    Candidates are made and scored for so many first atoms at a time; only those of a positive score stay, and the dynamic programming goes
    over all of them.
    """
    atoms = Atoms(text, pieces)
    parts = [positive(*atoms.candidates(low, min(len(atoms), low + PIECE)), weights) for low in range(0, len(atoms), PIECE)]
    return [(kind, int(atoms.start[i]), int(atoms.end[j - 1])) for kind, i, j in best_of(len(atoms), parts)] if parts else []


def log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum([math.exp(v - top) for v in values])) if len(values) > 1 else top


def expected(lat: Lattice, scores: np.ndarray) -> tuple[float, np.ndarray]:
    """The log of the sum over all segmentations, and the chance of each candidate with each kind in one."""
    n = len(lat.ends)
    by_end, by_start = [[] for _ in range(n + 1)], [[] for _ in range(n + 1)]
    whole = np.logaddexp.reduce(scores, axis=0).tolist()
    for c, (i, j) in enumerate(lat.candidates):
        by_end[j].append((i, whole[c]))
        by_start[i].append((j, whole[c]))
    forward, backward = [0.0] * (n + 1), [0.0] * (n + 1)
    for j in range(1, n + 1):
        forward[j] = log_sum([forward[j - 1], *[forward[i] + v for i, v in by_end[j]]])
    for i in range(n - 1, -1, -1):
        backward[i] = log_sum([backward[i + 1], *[v + backward[j] for j, v in by_start[i]]])
    outside = np.array([forward[i] + backward[j] - forward[n] for i, j in lat.candidates])
    return forward[n], np.exp(np.minimum(scores + outside, 0))


# --- learning ---------------------------------------------------------------------------------------------------------


def lesson(text: str) -> list[tuple[int, int, int]] | None:
    """The sure entities of a stretch in its surroundings; None if it teaches nothing, as matches overlap or fail their check."""
    failed: list = []
    spans = base_spans(text, failed=failed)
    if not all(a[2] <= b[1] for a, b in pairwise(sorted(spans, key=lambda s: s[1:]))):
        return None
    if [f for f in failed if not any(s[1] <= f[1] and f[2] <= s[2] for s in spans)]:
        return None
    return spans


def examples(contexts: list[str]) -> list[tuple[str, int, int, list[tuple[int, int, int]]]]:
    """(text, start, end, entities) of stretches in their surroundings, one character either side; variants and made-up ones included."""
    out, rng = [], np.random.default_rng(0)

    def add(text: str, spans: list[tuple[int, int, int]]) -> None:
        for a, b in stretches(text, [*figure_runs(text)]):
            out.append((text, a, b, [s for s in spans if a <= s[1] and s[2] <= b]))

    sure = []
    for text in contexts:
        if (spans := lesson(text)) is not None:
            add(text, spans)
            sure += [(k, text[a:b]) for k, a, b in spans]
    for kind, span in sure:
        if kind == 3 and (m := re.match(r"\+[0-9]{1,3}[ .-]?(?=[(0-9])", span)) and len(only_figures(span[m.end() :])) >= LEAST_FIGURES:
            add(f"a {span[m.end():]} b", [(3, 2, 2 + len(span) - m.end())])
        elif kind == 0:
            name, domain = span.split("@")
            for at, dot in ((" [at] ", " [dot] "), ("(at)", "."), (" (at) ", " (dot) ")):
                text = name + at + domain.replace(".", dot)
                add(f"a {text} b", [(0, 2, 2 + len(text))])

    def figures(n: int) -> str:
        return "".join(map(str, rng.integers(0, 10, n)))

    for _ in range(40):
        for text in (
            f"{figures(4)}-{figures(2)}-{figures(2)} {figures(2)}", f"{figures(2)}.{figures(2)}.{figures(4)}", figures(int(rng.integers(7, 9))), f"{figures(9)}.{figures(2)}",
            figures(int(rng.integers(21, 40))), f"{figures(4)}-{figures(4)}", " ".join(figures(int(k)) for k in rng.integers(1, 4, 12)), f"{figures(8)}-{figures(6)}",
            f"{figures(2)}.{figures(1)}.{figures(2)}.{rng.integers(256, 1000)}", f"10.{figures(1)}.{rng.integers(1000, 99999)}.{rng.integers(256, 9999)}",
        ):
            add(f"a {text} b", [])
    return out


def learn(contexts: list[str], rounds: int = 40, rate: float = 0.4, ridge: float = 0.02) -> np.ndarray:
    """Weights by kind and feature. Adaptive steps on the penalised likelihood of the segmentations."""
    # Stretches of the same shape teach the same: they are worked out once, and count as often as there are of them.
    known: dict[tuple, list] = {}
    for text, start, end, spans in examples(contexts):
        lat = lattice(text, start, end)
        if lat.candidates:
            at = {(lat.ends[i - 1] if i else start, lat.ends[j - 1]): c for c, (i, j) in enumerate(lat.candidates)}
            if all((a, b) in at for _, a, b in spans):
                told = tuple((k, at[a, b]) for k, a, b in spans)
                known.setdefault((len(lat.ends), tuple(lat.candidates), lat.table.tobytes(), told), [lat, told, 0])[2] += 1
    lessons = list(known.values())
    weights, squares = np.zeros((len(KINDS), PLACES)), np.full((len(KINDS), PLACES), 1e-6)
    if lessons:
        table = np.concatenate([lat.table for lat, _, _ in lessons])
        cuts = np.cumsum([len(lat.candidates) for lat, _, _ in lessons])[:-1]
        told = np.zeros((len(KINDS), len(table)))
        for at, (_, spans, times) in zip([0, *cuts], lessons):
            for k, c in spans:
                told[k, at + c] += times
        for _ in range(rounds):
            scores = np.split(weights[:, table].sum(2), cuts, axis=1)
            chance = told - np.concatenate([times * expected(lat, s)[1] for (lat, _, times), s in zip(lessons, scores)], axis=1)
            slope = -ridge * weights
            for k in range(len(KINDS)):
                slope[k] += np.bincount(table.ravel(), np.repeat(chance[k], table.shape[1]), PLACES)
            squares += slope * slope
            weights += rate * slope / np.sqrt(squares)
    # No entity was seen of a kind: nothing is known of it, and nothing is added.
    seen = {k for _, spans, _ in lessons for k, _ in spans}
    weights[[k for k in range(len(KINDS)) if k not in seen]] = -1.0
    return weights


def sample(docs: DataFrame, text_col: str = "text", most: int = STRETCHES) -> list[str]:
    """At most ``most`` distinct stretches that teach something, with a character of their surroundings.

    All of them if there are no more. Else each kind, and those without an entity, have an equal share of the places, and what
    one does not fill goes to the others. So a kind that occurs anywhere is among them, however rare it is.
    """

    def contexts(texts: pa.Array) -> pa.Array:
        out = []
        for value in texts:
            text = value.as_py() or ""
            runs, row = [*figure_runs(text)], []
            for a, b in stretches(text, runs):
                if b - a <= MOST_CHARS and (spans := lesson(context := text[max(0, a - 1) : b + 1])) is not None:
                    row.append({"context": context, "kinds": sum(1 << k for k in {s[0] for s in spans} or {OTHER})})
            out.append(row)
        return pa.array(out, pa.list_(pa.struct([("context", pa.string()), ("kinds", pa.int32())])))

    kind = T.StructType([T.StructField("context", T.StringType()), T.StructField("kinds", T.IntegerType())])
    found = written(docs.select(F.inline(arrow_udf(contexts, T.ArrayType(kind))(F.col(text_col)))).distinct())
    first: dict[tuple[int, str], int] = {}
    for k in range(OTHER + 1):
        rows = found.where(F.col("kinds").bitwiseAND(1 << k) != 0).select(F.xxhash64("context").alias("hash"), "context")
        for rank, r in enumerate(rows.orderBy("hash", "context").limit(most).collect()):
            first[r.hash, r.context] = min(rank, first.get((r.hash, r.context), rank))
    return [context for _, context in sorted(sorted(first, key=lambda c: (first[c], c))[:most])]


def fit(docs: DataFrame, text_col: str = "text", most: int = STRETCHES) -> np.ndarray:
    """Weights learned from the ``sample`` of the corpus."""
    return learn(sample(docs, text_col, most))


# --- finding ----------------------------------------------------------------------------------------------------------


def find(text: str, weights: np.ndarray) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(spans of the patterns, spans that the field adds); none of the latter overlaps one of the former."""
    runs = [*figure_runs(text)]
    base, pieces = base_spans(text, runs), []
    taken, t = sorted((a, b) for _, a, b in base), 0
    for start, end in stretches(text, runs):
        # What the patterns took is taken: the field goes over what is left between.
        at = start
        while t < len(taken) and taken[t][0] < end:
            pieces.append((at, taken[t][0]))
            at = max(at, taken[t][1])
            t += 1
        pieces.append((at, end))
    pieces = [(a, b) for a, b in pieces if b - a >= LEAST_FIGURES]
    return base, sorted(entities(text, pieces, weights)) if pieces else []


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
FOUND = T.StructType([T.StructField("base", T.ArrayType(SPAN)), T.StructField("added", T.ArrayType(SPAN))])


def personal_data(text: Column, weights: np.ndarray) -> Column:
    """(base, added) spans of each text: kind, start and end in code points, the end exclusive, by kind as in KINDS and start.

    A null or empty text has none. Texts are read whole; rows all alike have the same spans.
    """
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(texts: pa.Array) -> pa.Array:
        both: tuple[list, list] = [], []
        for value in texts:
            for out, found in zip(both, find(value.as_py() or "", weights)):
                out.append([{"kind": KINDS[k], "start": a, "end": b} for k, a, b in found])
        return pa.StructArray.from_arrays([pa.array(x, spans) for x in both], ["base", "added"])

    return arrow_udf(run, FOUND)(text)
