import random
import re

import numpy as np
import pytest
import xxhash

from skyfold.llm import simhash


def by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def linked(fps):
    """The least place reachable from each, over all pairs."""
    least = list(range(len(fps)))
    while True:
        after = [min(least[j] for j in range(len(fps)) if (fps[i] ^ fps[j]).bit_count() <= 3) for i in range(len(fps))]
        if after == least:
            return least
        least = after


def altered(draw, words, edits):
    out = list(words)
    for _ in range(edits):
        out[draw.randrange(len(out))] = f"w{draw.randrange(10**6)}"
    return out


def texts(seed):
    draw = random.Random(seed)
    base = [[f"word{draw.randrange(400)}" for _ in range(n)] for n in (1, 2, 3, 4, 30, 200, 200, 600)]
    found = [" ".join(b) for b in base] + [" ".join(altered(draw, draw.choice(base[5:]), draw.randrange(4))) for _ in range(60)]
    return found + [found[5], found[7].upper(), "  " + found[6].replace(" ", "\t\n"), "ÄÖ ñ 🙂 x y", "ÄÖ ñ 🙂 x y", "", None, " \x0b\x0c\r", "\x1c\x85"]


def test_fingerprint_equals_the_definition(monkeypatch):
    own = texts(1)
    expected = [by_hand(t) for t in own]
    assert [simhash.fingerprint(t) for t in own] == expected
    monkeypatch.setattr(simhash, "_PART", 16)  # texts in many parts
    assert [simhash.fingerprint(t) for t in own] == expected
    monkeypatch.undo()
    long = " ".join(own[7].split() * 2000)  # over one part, of millions of characters
    assert len(long) > 4 * simhash._PART and simhash.fingerprint(long) == by_hand(long)


def test_shells_count_what_is_near():
    counts = np.random.default_rng(3).integers(0, 5, 1 << 7)
    near = simhash.shells(counts)
    apart = np.bitwise_count(np.arange(128)[:, None] ^ np.arange(128)[None, :])
    for k in range(4):
        assert np.array_equal(near[k], ((apart == k) * counts[None, :]).sum(axis=1))


@pytest.mark.parametrize("parts", [1, 2, 3, 4])
def test_thresholds_leave_no_pair_out(parts):
    """Of two fingerprints that differ in three bits one finds the other in a part, whichever the thresholds are."""
    draw = np.random.default_rng(parts)
    fps = draw.integers(0, 1 << 63, 300).astype(np.uint64)
    fps[:150] &= np.uint64(0xFFFF)  # values that many share
    other = fps.copy()
    for _ in range(3):
        other ^= np.uint64(1) << draw.integers(0, 64, len(fps)).astype(np.uint64)
    layout = simhash.grouped_bits(draw.random((64, 64)) * 100, 300, parts)
    assert sorted(b for bits in layout for b in bits) == list(range(64))
    near = [simhash.shells(np.bincount(simhash.values_of(fps, p), minlength=1 << len(p))) for bits in layout for p in simhash.pieces(bits)]
    allowed = simhash.thresholds(fps, layout, near, len(fps))
    assert (allowed.sum(axis=0) == 3 - parts + 1).all()
    found = np.zeros(len(fps), dtype=bool)
    for k, bits in enumerate(layout):
        found |= np.bitwise_count((simhash.values_of(fps, bits) ^ simhash.values_of(other, bits)).view(np.uint64)) <= allowed[k]
    assert found.all()


def test_a_value_that_many_share_is_not_probed():
    fps = np.random.default_rng(9).integers(0, 1 << 63, 20_000).astype(np.uint64)
    fps[:9000] &= ~np.uint64(0xFFFF)
    layout = [list(range(low, low + 16)) for low in range(0, 64, 16)]
    near = [simhash.shells(np.bincount(simhash.values_of(fps, bits), minlength=1 << 16)) for bits in layout]
    allowed = simhash.thresholds(fps, layout, near, len(fps))
    assert (allowed[0, :9000] == -1).all() and (allowed[:, 9000:] == 0).all() and (allowed.sum(axis=0) == 0).all()


def test_correlated_bits_are_in_one_part():
    draw = np.random.default_rng(5)
    bits = draw.integers(0, 2, (4000, 64))
    for k in range(16):
        bits[:, 4 * k] = bits[:, 0] ^ (draw.random(4000) < 0.1)
    assert [0, 4, 8, 12] == simhash.grouped_bits(bits.T @ bits, 4000, 4)[0][:4]


@pytest.mark.parametrize("parts", [None, 2])
def test_components_equal_all_pairs(spark, make_docs, parts):
    own = texts(2)
    found = {r.doc_id: r for r in simhash.near_duplicates(make_docs(enumerate(own)), parts).collect()}
    fps = [by_hand(t) for t in own]
    assert [found[k].fingerprint for k in range(len(own))] == [f"{x:016x}" for x in fps]
    expected = linked(fps)
    assert [found[k].component_id for k in range(len(own))] == expected
    assert 10 < len(set(expected)) < len(own) - 20


def test_a_dense_group_in_many_cells(spark, monkeypatch):
    """Fingerprints that share nearly all bits: every cell is one of many, and no row is made for each pair."""
    draw = random.Random(7)
    fps = sorted({draw.getrandbits(64) if k % 5 == 0 else sum(1 << b for b in draw.sample(range(24), 3)) for k in range(700)})
    table = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    pairs, n = simhash.bit_counts(table)
    assert n == len(fps) and pairs[5, 5] == sum(x >> 5 & 1 for x in fps) and pairs[5, 9] == sum(x >> 5 & x >> 9 & 1 for x in fps)
    layout = simhash.grouped_bits(pairs, n, 4)
    monkeypatch.setattr(simhash, "CELL", 50)
    rows = simhash.filed(table, layout, simhash.value_counts(table, layout), n)
    found = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.edges(rows.persist()).collect()]
    parent = {x: x for x in fps}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in found:
        parent[max(top(a), top(b))] = min(top(a), top(b))
    expected = [fps[k] for k in linked(fps)]
    assert [top(x) for x in fps] == expected and len(set(expected)) < n // 2


def test_edge_cases(spark, make_docs):
    rows = [(3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (1, None), (2, ""), (7, "A B  c\nd"), (None, "alone is this one")]
    found = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(make_docs(rows)).collect()), key=str)
    assert found == sorted([(3, 3), (3, 3), (None, 3), (1, 1), (2, 1), (7, 3), (None, None)], key=str)
    assert simhash.near_duplicates(make_docs([])).count() == 0
    clashing = make_docs([(4, "x"), (5, "x")]).selectExpr("*", "1 AS fp", "2 AS comp", "3 AS least", "4 AS n", "5 AS component_id", "6 AS fingerprint", "7 AS value")
    assert [r.component_id for r in simhash.near_duplicates(clashing).collect()] == [4, 4]
