import re
from collections import Counter

import numpy as np
import pytest

from skyfold.llm.quality import Hashing, counts, judge, labelled_sample, train

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = {
    1: None,
    2: "",
    3: "one two three",
    4: "a b c d e f a b c d e f a b c d e\nx\nx\n  \n x\nx",
    5: "un été à la plage ici ### $$$ <b>|&*%\n\tun été\r\nfin",
    6: "word " * 4000,
    7: " ".join(f"w{i}" for i in range(2000)),
    8: "\x1c\x85 a\x1cb   c",
    9: "\n\n\n",
}


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered)


@pytest.mark.parametrize("i", TEXTS)
def test_counts(i):
    assert counts((TEXTS[i] or "").encode()) == brute(TEXTS[i])


def test_hashing_is_local():
    """n-grams of a text are those of its parts, whatever stands before them."""
    h = Hashing()
    alone, inside = h.places(b"beta gamma"), h.places(b"alpha beta gamma")
    assert alone[0].tolist() == inside[0].tolist()[1:] and alone[1].tolist() == inside[1].tolist()[1:]
    assert alone[2].tolist() == inside[2].tolist()[6:]
    assert [len(x) for x in h.places("é".encode())] == [1, 0, 0, 0, 0] and max(map(max, inside)) < h.size


def test_long_texts_hash_like_short_ones(monkeypatch):
    """Cut into parts at white space, a text has the n-grams that it has whole, and the shares by plain counting."""
    text = ("alpha beta\n gamma été delta\t" * 40).encode()
    h = Hashing()
    whole = [sorted(x.tolist()) for x in h.places(text)]
    at, share = h.shares(text)
    monkeypatch.setattr("skyfold.llm.quality.PART", 50)
    assert len(list(h.parts(text))) > 20 and [sorted(x.tolist()) for x in h.places(text)] == whole
    counted = {p: n / len(x) for x in whole for p, n in Counter(x).items()}
    assert dict(zip(at.tolist(), share.tolist())) == pytest.approx(counted)
    assert dict(zip(*map(np.ndarray.tolist, h.shares(text)))) == pytest.approx(counted)


def test_probability_against_brute_force(labelled):
    """The calibrated line over the bias and each family's mean weight, for every judged row."""
    docs, labels = labelled
    model = train(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in judge(docs, model).collect():
        score = model.bias + sum(np.mean([float(model.weights[p]) for p in x.tolist()]) for x in model.hashing.places(texts[r.doc_id].encode()) if len(x))
        assert r.probability == pytest.approx(1 / (1 + np.exp(-(model.slope * score + model.shift))), abs=1e-6)


def test_the_sample_is_bounded_in_rows_and_bytes(spark, make_docs):
    docs = make_docs([(1, f"text {i} " + "x" * 1000) for i in range(300)] + [(1, "same")] * 300 + [(2, "other words")])
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0)], "doc_id long, quality int")
    assert labelled_sample(docs, labels, "quality", 50, 10**9).count() == 50
    small = labelled_sample(docs, labels, "quality", 1000, 5000).collect()
    assert 0 < sum(len(r.text) for r in small) <= 5000
    assert labelled_sample(docs, labels, "quality", 1000, 10**9).count() == 302


@pytest.fixture(scope="module")
def labelled(make_docs, spark):
    rng = np.random.default_rng(3)
    good = [" ".join(f"wort{k}" for k in rng.integers(0, 300, 60)) for _ in range(150)]
    bad = [" ".join(f"wort{k}###" for k in rng.integers(0, 300, 60)) for _ in range(60)]
    docs = make_docs(dict(enumerate(good + bad)))
    labels = spark.createDataFrame([(i, int(i < 150), 0) for i in range(0, 210, 2)] + [(3, None, 0), (None, 1, 0), (999, 0, 0)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_held_out_accuracy(labelled):
    docs, labels = labelled
    model = train(docs, labels)
    assert model.held_out["accuracy"] > 0.9
    rows = {r.doc_id: r for r in judge(docs, model).collect()}
    assert all(rows[i].kept == (i < 150) for i in range(210))
    again = train(docs.repartition(3), labels.repartition(2))
    assert np.array_equal(again.weights, model.weights) and again.slope == model.slope


def test_judge_edges(spark, make_docs, labelled):
    model = train(*labelled)
    rows = {r.doc_id: r for r in judge(make_docs(TEXTS), model).collect()}
    for i, text in TEXTS.items():
        r, b = rows[i], brute(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == b
        assert r.base_failed == (b[0] < 10 or 100 * b[4] > 20 * b[0]) and not (r.base_failed and r.kept)
    assert judge(make_docs([]), model).count() == 0
    assert judge(make_docs([(1, "x"), (1, "x"), (None, None)]), None).count() == 3


def test_no_model_without_both_labels(spark, make_docs):
    docs = make_docs({1: "a b", 2: "c d"})
    assert train(docs, spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")) is None
    assert train(docs, spark.createDataFrame([], "doc_id long, quality int")) is None
