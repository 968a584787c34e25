"""Operator 6: license notices, exact phrases and fuzzy short notices.

A text is normalised to its words, A-Z lower-cased, one space between them. Phrases are counted where their
words stand consecutively. A notice is found with up to `errors` edits: split into errors + 1 pieces, at least
one piece stands unchanged in any text within those edits (pigeonhole), so an automaton of all pieces gives
every candidate place. The least edits of a part ending at each character, kept as the bits of one number, narrow
these to where some part is within the edits; the regex library's bounded-error matching decides there and reports the
span. Time is so linear in a text that nearly has notices all over.
Places are taken by rising share of edits, each in what the ones before left free, so none hides another beside it.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from skyfold.llm.common import TO_WORDS, columns_of

# The phrases of the base rule and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Short notices as their normalised words, and their labels.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by 4 0": "cc-by",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "licensed under the gnu general public license version 3": "gpl-3",
    "licensed under the gnu general public license version 2": "gpl-2",
    "mozilla public license version 2 0": "mpl-2",
    "redistribution and use in source and binary forms": "bsd",
    "all rights reserved": "all-rights-reserved",
}

RESULT = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans string"


def words_of(text: str | None) -> bytes:
    """The words of a text in UTF-8, one space between them and around them."""
    return b" %s " % b" ".join((text or "").encode().translate(TO_WORDS).split())


@dataclass(frozen=True)
class Notice:
    words: str
    label: str
    errors: int


def notices(table: dict[str, str], per_error: int = 10) -> tuple[Notice, ...]:
    """One edit allowed for each `per_error` characters."""
    return tuple(Notice(w, label, len(w) // per_error) for w, label in table.items())


def pieces(notice: Notice) -> list[tuple[int, str]]:
    """(place, piece): the notice split into errors + 1 pieces of nearly the same length."""
    n, k = len(notice.words), notice.errors + 1
    cuts = [n * i // k for i in range(k + 1)]
    return [(a, notice.words[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def near_ends(words: str, errors: int, text: str, begin: int, end: int) -> list[tuple[int, int]]:
    """(place, edits) where a part of text[begin:end] ends that is within the errors of words, with its least edits.

    The column of edits of all prefixes of words is held as its differences, up and down, one bit a prefix.
    """
    marks: dict[str, int] = {}
    for k, c in enumerate(words):
        marks[c] = marks.get(c, 0) | 1 << k
    full, last = (1 << len(words)) - 1, 1 << len(words) - 1
    up, down, edits = full, 0, len(words)
    found = []
    for at in range(begin, end):
        equal = marks.get(text[at], 0)
        level = (((equal & up) + up) ^ up) | equal
        more, less = down | (full & ~(level | up)), up & level
        if more & last:
            edits += 1
        elif less & last:
            edits -= 1
        more, less, kept = more << 1 & full, less << 1 & full, equal | down
        up, down = less | (full & ~(kept | more)), more & kept
        if edits <= errors:
            found.append((at + 1, edits))
    return found


class Search:
    """The automaton of all notices' pieces and their patterns."""

    def __init__(self, wanted: tuple[Notice, ...]):
        import ahocorasick
        import regex

        self.wanted = wanted
        self.patterns = [[regex.compile(rf"(?:{regex.escape(n.words)}){{e<={e}}}") for e in range(n.errors + 1)] for n in wanted]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for k, n in enumerate(wanted):
            for at, piece in pieces(n):
                seeds.setdefault(piece, []).append((k, at))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """Of each notice the stretches of text that hold all its places; those that touch are one."""
        if not self.wanted:
            return {}
        seeded: dict[int, list[list[int]]] = {}
        for last, (size, uses) in self.automaton.iter(text):
            for k, at in uses:
                n = self.wanted[k]
                begin = last + 1 - size - at - n.errors
                end = begin + len(n.words) + 2 * n.errors
                seeded.setdefault(k, []).append([max(0, begin), min(len(text), end)])
        found = {}
        for k, spans in seeded.items():
            spans.sort()
            joined = found[k] = [spans[0]]
            for begin, end in spans[1:]:
                if begin <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], end)
                else:
                    joined.append([begin, end])
        return found

    @staticmethod
    def stretches(windows: list[list[int]], ends: list[tuple[int, int]], errors: int, longest: int) -> Iterator[list[int]]:
        """Stretches of the windows that hold all matches of at most so many errors and characters; apart, from the left."""
        held: list[int] | None = None
        w = 0
        for end, edits in ends:
            if edits <= errors:
                while windows[w][1] < end:
                    w += 1
                begin = max(windows[w][0], end - longest)
                if held and begin <= held[1]:
                    held[1] = end
                else:
                    if held:
                        yield held
                    held = [begin, end]
        if held:
            yield held

    def places(self, text: str, windows: dict[int, list[list[int]]]) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, edits), none over another, until no window has a match in what is left free.

        By rising share of edits, the longer notice first, then from the left. What a step leaves free has no match
        of its notice within its edits, so each step adds those of one edit more. A match ends where some part within
        its edits ends, so each step looks no further than before such ends.
        """
        ends = {k: [p for window in own for p in near_ends(self.wanted[k].words, self.wanted[k].errors, text, *window)] for k, own in windows.items()}
        steps = sorted((e / len(self.wanted[k].words), -len(self.wanted[k].words), k, e) for k in windows for e in range(self.wanted[k].errors + 1))
        taken: list[tuple[int, int]] = []
        found = []
        for _, size, k, e in steps:
            for begin, end in self.stretches(windows[k], ends[k], e, -size + e):
                at = bisect_left(taken, (begin, begin))
                inside = taken[max(0, at - 1) : bisect_left(taken, (end, end))]
                for low, high in zip([begin, *[max(begin, b) for _, b in inside]], [*[a for a, _ in inside], end], strict=True):
                    if high - low >= -size - e:
                        for m in self.patterns[k][e].finditer(text, low, high):
                            insort(taken, m.span())
                            found.append((k, *m.span(), sum(m.fuzzy_counts)))
        return found

    def __call__(self, text: str) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, edits) of every place, by notice and start; of each notice none overlapping."""
        return sorted(p for k, own in self.windows(text).items() for p in self.places(text, {k: own}))


@lru_cache(maxsize=8)
def _search(wanted: tuple[Notice, ...]) -> Search:
    return Search(wanted)


def scan(text: str | None, phrases: dict[str, str], wanted: tuple[Notice, ...]) -> tuple:
    """A row of RESULT without its doc_id."""
    norm = words_of(text)
    n_words = norm.count(b" ") - 1 if norm != b"  " else 0
    starts, base = [], set()
    for phrase, label in phrases.items():
        needle = b" %s " % phrase.encode()
        at, before, counted = norm.find(needle), 0, 0
        while at >= 0:
            before, counted = before + norm.count(b" ", counted, at), at
            starts.append(before)
            base.add(label)
            at = norm.find(needle, at + 1)
    labels, score, spans = set(base), 1.0 if base else 0.0, []
    own = norm.decode()
    search, spaces = _search(wanted), []
    # of matches over one another the one with the smallest share of edits stands
    for k, begin, end, edits in search.places(own, search.windows(own)):
        n = wanted[k]
        spaces = spaces or [m.start() for m in re.finditer(" ", own)]
        labels.add(n.label)
        score = max(score, 1 - edits / len(n.words))
        # the words that the match touches; spaces at its ends don't count
        touched = own[begin:end]
        first = begin + len(touched) - len(touched.lstrip())
        last = max(first, end - 1 - len(touched) + len(touched.rstrip()))
        spans.append((n.label, bisect_left(spaces, first) - 1, bisect_left(spaces, last) - 1, edits))
    return n_words, len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score, ",".join(f"{a}:{b}:{c}:{d}" for a, b, c, d in sorted(set(spans), key=lambda s: (s[1], s[0])))


def find_licenses(docs: DataFrame, phrases: dict[str, str] = PHRASES, wanted: tuple[Notice, ...] | None = None) -> DataFrame:
    """One row a document: n_words, the phrases' places and labels, all labels, the best score and the fuzzy spans.

    spans holds label:first word:last word:edits of each fuzzy match. score is 1 for an exact phrase, else the
    best match's share of unedited characters, 0 without any. A null or empty text has no words. Repeated rows
    are scanned alike; an empty table gives no rows; other columns are not looked at.
    """
    wanted = notices(NOTICES) if wanted is None else wanted
    kinds = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.float64(), pa.string()]
    names = [x.split()[0] for x in RESULT.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(doc_id, *scan(text, phrases, wanted)) for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found, strict=True), kinds, strict=True)], names=names)

    return columns_of(docs).mapInArrow(rows, RESULT)
