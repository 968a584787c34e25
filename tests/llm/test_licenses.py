import random
import re
import time

import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from skyfold.llm.licenses import NOTICES, PHRASES, Search, find_licenses, near_ends, notices, scan, words_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        own = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += own
        labels |= {label} if own else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


TEXTS = {
    1: "Foo bar.\nReleased under the MIT License. under the MIT license under the mit license",
    2: "Licensed under the Apache License, Version 2.0.",
    3: "CC BY-NC 4.0 cc by nc; cc by n c",
    4: None,
    5: "",
    6: "Ünder the mit license ÀÉ undér",
    7: "Released undr the MIT Licnse",
    8: "This work is licensed under the GNU General Public License, version 3.",
    9: "clean prose about nothing in particular " * 800,
    10: "§§ --- !!",
}


def test_base_against_brute_force(spark, make_docs):
    rows = {r.doc_id: r for r in find_licenses(make_docs(TEXTS)).collect()}
    assert rows.keys() == TEXTS.keys()
    for i, text in TEXTS.items():
        r = rows[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text), i
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
    assert rows[7].base_labels == "" and rows[7].labels == "mit" and 0.8 < rows[7].score < 1
    assert rows[8].labels == "gpl-3" and rows[8].spans == "gpl-3:3:11:0"
    assert rows[9].labels == "" and rows[9].score == 0


def test_seeds_lose_no_match():
    """Every match of the whole text's fuzzy pattern is found through the pieces."""
    search = Search(notices(NOTICES))
    for text in TEXTS.values():
        norm = words_of(text).decode()[:3000]
        found = {k for k, *_ in search(norm)}
        for k, n in enumerate(search.wanted):
            assert (regex.search(rf"(?:{n.words}){{e<={n.errors}}}", norm) is not None) == (k in found), (n, norm)


def test_repeats_and_empty(spark, make_docs):
    assert find_licenses(make_docs([])).count() == 0
    assert find_licenses(make_docs([(1, "cc by nc"), (1, "cc by nc"), (None, "x")])).count() == 3
    assert scan("x", {}, ())[:2] == (1, 0)


def least_edits(words, text):
    """The fewest edits from words to any part of text, by the table of all prefixes (Sellers)."""
    row = list(range(len(words) + 1))
    least = row[-1]
    for c in text:
        before, row = row, [0]
        for k, w in enumerate(words):
            row.append(min(before[k] + (w != c), before[k + 1] + 1, row[k] + 1))
        least = min(least, row[-1])
    return least


def test_very_many_notices_in_seconds():
    """Time follows the number of places: words before them are counted once."""
    text = "".join(f"{notice} and {k} words between them. " for k in range(1000) for notice in ("released undr the mit license", "all rights reservd", "cc by nc"))
    begun = time.process_time()
    found = scan(text, PHRASES, notices(NOTICES))
    assert time.process_time() - begun < 20 and found[7].count(":") == 3 * 2000 and found[1] == 1000
    assert found[7].startswith("mit:0:4:1,all-rights-reserved:10:12:1,mit:")


def test_no_place_hides_another():
    search = Search(notices(NOTICES))
    two = " foo releasd under the mit license bar released under the mit license x"
    assert [p[1:] for p in search(two) if p[0] == 0] == [(5, 34, 1), (39, 69, 0)]
    both = scan("licensed undr the gnu genral public license version 3 or licensed under the gnu general public license version 2", PHRASES, notices(NOTICES))
    assert both[5] == "gpl-2,gpl-3" and both[7] == "gpl-3:0:8:2,gpl-2:10:18:0"


@settings(max_examples=200, deadline=None)
@given(st.text("ab c", min_size=1, max_size=12), st.text("ab cd", max_size=40), st.integers(0, 5))
def test_near_ends_against_brute_force(words, text, errors):
    def least(end):
        row = list(range(len(words) + 1))  # parts that are empty at the start; each character may begin one
        for c in text[:end]:
            before, row = row, [0]
            for k, w in enumerate(words):
                row.append(min(before[k] + (w != c), before[k + 1] + 1, row[k] + 1))
        return row[-1]

    assert near_ends(words, errors, text, 0, len(text)) == [(k, least(k)) for k in range(1, len(text) + 1) if least(k) <= errors]


def test_near_misses_all_over_a_long_text_in_seconds():
    text = "permission is hereby xx granted yy free of zz charge qq " * 18_000 + "permision is hereby granted free of charge to any person obtaining a copy"
    begun = time.process_time()
    found = scan(text, PHRASES, notices(NOTICES))
    assert time.process_time() - begun < 10 and found[5] == "mit" and found[7] == "mit:198000:198012:1"


def test_places_against_brute_force():
    """What the found places leave free holds no match of any notice: of each notice alone, and of all together."""
    rng = random.Random(3)
    wanted = notices(NOTICES)
    search = Search(wanted)
    for _ in range(40):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            own = list(rng.choice(list(NOTICES)))
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(own))
                own[at] = rng.choice(["", "x", own[at] + "y"])
            parts += ["".join(own), *rng.choices(["and", "or", "the licence"], k=rng.randrange(2))]
        norm = words_of(" ".join(parts)).decode()
        alone, together = search(norm), search.places(norm, search.windows(norm))
        for k, n in enumerate(wanted):
            for places in ([p for p in alone if p[0] == k], sorted(together, key=lambda p: p[1])):
                cuts = [0, *[x for p in places for x in p[1:3]], len(norm)]
                assert cuts == sorted(cuts)
                assert all(least_edits(n.words, norm[a:b]) > n.errors for a, b in zip(cuts[::2], cuts[1::2], strict=True)), (n, norm, places)
        for k, a, b, edits in alone + together:
            assert least_edits(wanted[k].words, norm[a:b]) == edits
