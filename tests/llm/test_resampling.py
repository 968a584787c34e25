import math
from collections import Counter

import numpy as np
import pytest

from skyfold.llm.resampling import bucket_counts, buckets_of, resample


def test_buckets_follow_words():
    a, b = buckets_of(b"Alpha beta, GAMMA", 5000), buckets_of(b"xx alpha beta gamma", 5000)
    assert a[:3].tolist() == b[1:4].tolist() and a[3:].tolist() == b[5:].tolist()
    assert len(buckets_of(b"", 10)) == len(buckets_of(b"--", 10)) == 0


def test_counts_are_of_all_documents(spark, make_docs):
    texts = {i: f"w{i % 7} w{i % 5} é{i}" for i in range(500)} | {900: None, 901: ""}
    expected = Counter()
    for t in texts.values():
        expected.update(buckets_of((t or "").encode(), 300).tolist())
    assert bucket_counts(make_docs(texts), 300).tolist() == [expected[k] for k in range(300)]


def test_target_like_documents_come_first(spark, make_docs):
    rng = np.random.default_rng(2)
    good = {i: " ".join(f"gut{k}" for k in rng.integers(0, 40, 30)) for i in range(100)}
    bad = {i: " ".join(f"schlecht{k}" for k in rng.integers(0, 40, 30)) for i in range(100, 200)}
    docs = make_docs({**good, **bad, 300: None, 301: ""})
    rows = resample(docs, docs.where("doc_id < 20"), share=0.5).collect()
    assert len(rows) == 202 and sorted(r["rank"] for r in rows) == list(range(1, 203))
    assert all(r.kept == (r["rank"] <= 101) for r in rows) and sum(r.kept for r in rows) == 101
    assert len({r.doc_id for r in rows if r.kept} & set(good)) >= 97
    by_rank = sorted(rows, key=lambda r: r["rank"])
    assert all(a.gumbel_key >= b.gumbel_key for a, b in zip(by_rank, by_rank[1:]))
    again = {r.doc_id: r["rank"] for r in resample(docs.repartition(5), docs.where("doc_id < 20"), share=0.5).collect()}
    assert again == {r.doc_id: r["rank"] for r in rows}


def test_shares_follow_importance(spark, make_docs):
    """With one n-gram a document, the share of each kind drawn first follows its weight."""
    docs = make_docs({i: "a" if i % 2 else "b" for i in range(4000)})
    target = make_docs({i: "a" if i % 4 else "b" for i in range(4000)})
    rows = resample(docs, target, share=0.1).collect()
    drawn = sum(1 for r in rows if r.kept and r.doc_id % 2)
    assert 0.68 < drawn / 400 < 0.82


def test_weights_and_ranks_against_brute_force(spark, make_docs):
    """log_weight from plain counts of words and pairs of words, each bucket's, and the order of the keys."""
    rng = np.random.default_rng(4)
    texts = {i: " ".join(f"w{k}" for k in rng.integers(0, 50, rng.integers(1, 40))) for i in range(150)} | {200: None, 201: "Été, W1  w2"}
    docs = make_docs(texts)
    rows = resample(docs, docs.where("doc_id % 3 = 0"), share=0.3, buckets=97, smoothing=0.5).collect()
    grams = {i: buckets_of((t or "").encode(), 97).tolist() for i, t in texts.items()}
    raw, target = Counter(x for g in grams.values() for x in g), Counter(x for i, g in grams.items() if i % 3 == 0 for x in g)
    n_raw, n_target = sum(raw.values()) + 48.5, sum(target.values()) + 48.5
    for r in rows:
        expected = sum(math.log((target[x] + 0.5) / n_target) - math.log((raw[x] + 0.5) / n_raw) for x in grams[r.doc_id])
        assert r.log_weight == pytest.approx(expected, abs=1e-9)
    assert [r["rank"] for r in sorted(rows, key=lambda r: (-r.gumbel_key, r.doc_id))] == list(range(1, len(rows) + 1))
    words = [w.encode() for w in "w1 w2 été".split()]
    assert len({buckets_of(w, 1 << 30)[0] for w in words}) == 3 and len(buckets_of("Été, W1  w2".encode(), 97)) == 5


def test_edges(spark, make_docs):
    assert resample(make_docs([]), make_docs([]), share=0.5).count() == 0
    rows = resample(make_docs([(1, "x"), (1, "x"), (None, "y")]), make_docs([]), share=1.0).collect()
    assert len(rows) == 3 and all(r.kept for r in rows)
