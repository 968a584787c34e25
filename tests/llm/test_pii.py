import hashlib
import math
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from skyfold.llm.pii import base_spans, find_pii, luhn, pii_digest, sanitise

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    spans = [("email", *m.span()) for m in EMAIL.finditer(text)]
    spans += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    spans += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return spans + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]


ALPHABET = list("ab1.9@+-( )%_é\n") + ["1.2.3.4", "@x.de", "+49 30 1234", "4929348385146306", "256"]


@given(st.lists(st.sampled_from(ALPHABET), max_size=30).map("".join))
@settings(max_examples=1500, deadline=None)
def test_base_spans_are_the_patterns(text):
    assert base_spans(text) == brute(text)


def test_luhn():
    assert luhn("4929348385146306") and not luhn("4929348385146307") and luhn("0")


def corpus():
    texts = {i: f"filler text number {i} about common things and other words {i * 7}" for i in range(200)}
    for i in range(4):  # a rare term that always stands by one address
        texts[500 + i] = f"prose {i} here then zebrafish contact jo@corp.example now and {i * 3} more common things"
    texts[600] = "no address but zebrafish is named"
    texts[700], texts[701] = None, ""
    texts[702] = "copy of a page with card 4929348385146306 and uniqueword"
    texts[703] = texts[702]
    texts[704] = "ring +49 (30) 1234-567 or 10.0.0.1 not 10.0.0.256 " + "lang " * 20000
    return texts


def test_disclosing_terms(spark, make_docs):
    texts = corpus()
    found = find_pii(make_docs([*texts.items(), (500, texts[500]), (None, "me@home.example")]))
    rows = {r.doc_id: r for r in pii_digest(found).collect()}
    assert found.count() == len(texts) + 2
    for i, text in texts.items():
        base = brute(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        r = rows[i]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in base) for k in ("email", "ip", "card", "phone"))
        assert r.spans.startswith(joined)
        terms = [s.split(":") for s in r.spans[len(joined) :].strip(",").split(",") if s]
        named = {text[int(a) : int(b)] for _, a, b in terms} if text else set()
        assert ("zebrafish" in named) == (500 <= i < 504), (i, named)
        assert not terms or 500 <= i < 504
    assert rows[600].spans == "" and rows[702].spans.startswith("card:")


def test_sanitise(spark, make_docs):
    texts = corpus()
    docs = make_docs([*texts.items(), (500, texts[500])])
    clean = sanitise(docs, find_pii(docs))
    assert clean.columns == docs.columns and clean.count() == docs.count()
    rows = {r.doc_id: r.text for r in clean.collect()}
    assert "[EMAIL]" in rows[500] and "[TERM]" in rows[500] and "zebrafish" not in rows[500] and "jo@" not in rows[500]
    assert rows[600] == texts[600] and rows[700] is None and rows[701] == ""
    assert "[PHONE]" in rows[704] and "[IP]" in rows[704] and "10.0.0.256" in rows[704]


def test_empty_table(spark, make_docs):
    assert pii_digest(find_pii(make_docs([]))).count() == 0


def with_terms(found):
    return {r.doc_id: [s.split(":")[1:] for s in r.spans.split(",") if s.startswith("term:")] for r in pii_digest(found).collect()}


def test_one_context_discloses(spark, make_docs):
    """A term found only with an entity of one context is over the threshold: no floor on contexts keeps it in."""
    texts = {i: f"filler text number {i} about common things" for i in range(2000)}
    texts[5000] = "about quokka jo@corp.example common things"
    terms = with_terms(find_pii(make_docs(texts)))
    assert terms.pop(5000) == [["6", "12"]] and not any(terms.values())


def test_copies_count_once(spark, make_docs):
    """Copies of one page don't hide its terms: all numbers count different texts."""
    texts = {i: f"filler text number {i} about common things" for i in range(2000)}
    texts[5000] = "things quokka jo@corp.example common about"
    copied = "about quokka jo@corp.example common things"
    terms = with_terms(find_pii(make_docs([*texts.items(), *[(6000 + i, copied) for i in range(500)]])))
    assert terms.pop(5000) == [["7", "13"]]
    assert all(terms.pop(6000 + i) == [["6", "12"]] for i in range(500)) and not any(terms.values())


def test_terms_far_from_their_entity(spark, make_docs):
    """A disclosing term counts and goes over the whole text of its entity, in any case, and only there."""
    texts = {i: f"filler text number {i} about common things" for i in range(2000)}
    gap = "about common things " * 10
    texts[5000] = f"Quokka {gap}jo@corp.example {gap}quokka"
    texts[5001] = f"quokka {gap}"
    docs = make_docs(texts)
    found = find_pii(docs)
    assert with_terms(found)[5000] == [["0", "6"], [str(len(texts[5000]) - 6), str(len(texts[5000]))]]
    rows = {r.doc_id: r.text for r in sanitise(docs, found).collect()}
    assert rows.pop(5000) == f"[TERM] {gap}[EMAIL] {gap}[TERM]" and all(rows[i] == texts[i] for i in rows)


def test_terms_against_brute_force(spark, make_docs):
    """Every (entity, term) over the threshold, counted and placed over whole texts: the bound before the pairs loses none."""
    rng = random.Random(5)
    texts = {}
    for i in range(300):
        words = [f"w{min(int(rng.expovariate(0.05)), 150)}" for _ in range(20)]
        for _ in range(rng.choice([0, 0, 1, 2])):
            words.insert(rng.randrange(20), f"u{rng.randrange(12)}@x.de" if rng.random() < 0.8 else f"v{i}@y.de")
        texts[i] = " ".join(words)
    texts[300] = texts[301] = texts[0]
    every = {t: (set(re.findall("[a-z0-9]+", t)), {("email", t[a:b]) for _, a, b in base_spans(t)}) for t in texts.values()}
    over = set()
    for e in {e for _, own in every.values() for e in own}:
        held = [t for t, (_, own) in every.items() if e in own]
        p = len(held) / len(every)
        for w in set().union(*(every[t][0] for t in held)):
            both, n = sum(w in every[t][0] for t in held), sum(w in ws for ws, _ in every.values())
            if math.log((both + 2 * p) / (n + 2) / p) / math.log(1 / p) >= 0.8:
                over.add((e, w))
    terms = with_terms(find_pii(make_docs(texts)))
    n = 0
    for i, t in texts.items():
        base = base_spans(t)
        expected = [[str(m.start()), str(m.end())] for m in re.finditer("[a-z0-9]+", t) if any((e, m[0]) in over for e in every[t][1]) and not any(a < m.end() and m.start() < b for _, a, b in base)]
        assert terms[i] == expected, t
        n += len(expected)
    assert n


def test_clashing_columns(spark, make_docs):
    texts = corpus()
    docs = make_docs([*texts.items(), (None, "me@home.example")]).selectExpr("*", "1 AS _doc", "2 AS _key", "3 AS _spans", "4 AS spans", "5 AS `key`", "6 AS found_doc", "7 AS `row`", "8 AS _own")
    clean = sanitise(docs, find_pii(docs))
    assert clean.columns == docs.columns
    rows = clean.collect()
    assert len(rows) == len(texts) + 1 and {tuple(r)[5:] for r in rows} == {(1, 2, 3, 4, 5, 6, 7, 8)}
    assert [r.text for r in rows if r.doc_id is None] == ["[EMAIL]"]


def test_many_entities_of_one_text(spark, make_docs):
    """A text of very many addresses and words of its own, in seconds and without a row a pair of them."""
    texts = {i: f"filler text number {i} about common things" for i in range(300)}
    texts[5000] = " ".join(f"own{k}word u{k}@x.de" for k in range(6000))
    found = find_pii(make_docs(texts))
    (row,) = [r for r in pii_digest(found).collect() if r.doc_id == 5000]
    assert row.n_email == 6000 and row.spans.count("term:") == 6000
