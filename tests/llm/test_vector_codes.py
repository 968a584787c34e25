import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from skyfold.llm import vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int"


def by_hand(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(Fraction(x) * 4096) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[list(v[p]) for v in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        found = [[nearest(p, v[p])[1] for p in range(parts)] for v in cut]
        for p in range(parts):
            for k in range(len(books[p])):
                own = [v[p] for v, f in zip(cut, found, strict=True) if f[p] == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    ends = [[nearest(p, v[p]) for p in range(parts)] for v in cut]
    errors = [sum(d for d, _ in e) for e in ends]
    totals = {label: sum(e for e, (_, _, other) in zip(errors, kept, strict=True) if other == label) for _, _, label in kept}
    return sorted([(i, "".join(f"{k:02x}" for _, k in e), error, totals[label], digest) for (i, _, label), e, error in zip(kept, ends, errors, strict=True)], key=repr)


def found(spark, rows, **more):
    return sorted(map(tuple, vector_codes.product_codes(spark.createDataFrame(rows, SCHEMA), **more).collect()), key=repr)


def lattice(draw, n):
    """Few values a component, so that distances are often equal."""
    return [(k, [draw.randrange(-2, 3) / 4096 for _ in range(16)], draw.choice([None, 0, 1])) for k in range(n)]


def clustered(draw, n):
    centres = [[draw.gauss(0, 1) for _ in range(24)] for _ in range(40)]
    return [(k, [x + draw.gauss(0, 0.05) for x in draw.choice(centres)], k % 7) for k in draw.sample(range(9 * n), n)]


@pytest.mark.parametrize("make", [lattice, clustered])
def test_codes_equal_plain_rounds(spark, make):
    rows = make(random.Random(4), 400)
    assert found(spark, rows) == by_hand(rows)


def test_bounds_leave_most_distances_out(spark):
    rows = clustered(random.Random(5), 3000)
    vectors = vector_codes.kept_vectors(spark.createDataFrame(rows, SCHEMA)).withColumnRenamed("label", "_l").selectExpr("vec_id", "cast(_l as string) AS label", "x")
    done = vector_codes.fit(vectors)
    assert done.computed[0] == 3000 * 8 * 16 and sum(done.computed[3:]) < 0.35 * 3 * 3000 * 8 * 16


@pytest.mark.parametrize("scale", [1, 1 << 26, 1 << 45])
def test_bounds_and_ties_hold_at_any_size(scale):
    """One part, round after round, against all distances in numbers of any size."""
    draw = np.random.default_rng(scale % 97)
    x = draw.integers(-3, 4, (300, 5)) * scale
    books = x[:12].copy()
    groups = vector_codes.grouped(books)
    assert sorted(np.concatenate(groups).tolist()) == list(range(12)) and len(groups) > 1
    codes, upper, lower = np.full(300, -1), np.full(300, np.inf), np.full((300, len(groups)), -np.inf)
    for _ in range(6):
        vector_codes.assigned(x, books, groups, codes, upper, lower)
        apart = x.astype(object)[:, None] - books.astype(object)[None]
        squares = (apart * apart).sum(axis=2)
        assert codes.tolist() == [min(range(12), key=lambda k: (row[k], k)) for row in squares]
        after = books.copy()
        for k in range(12):
            if (codes == k).any():
                own = x[codes == k].astype(object)
                after[k] = [int(s) // len(own) for s in own.sum(axis=0)]
        drift = vector_codes.drifts(books, after)
        upper += drift[codes]
        lower -= np.array([drift[g].max() for g in groups])[None]
        books = after


def test_edge_cases(spark):
    draw = random.Random(6)
    vector = lambda: [draw.choice([-1.5, 0.25, 3.0, 1e-9, -1e-9]) for _ in range(8)]
    rows = [(k, vector(), None) for k in (9, 4, 4, 7)] + [(None, vector(), 2)]
    odd = [(1, None, 1), (2, [None, *vector()[1:]], 1), (3, [math.nan, *vector()[1:]], 1), (0, [-math.inf, *vector()[1:]], None)]
    assert found(spark, rows + odd) == by_hand(rows)  # fewer vectors than entries; equal and null ids; dropped ones
    assert found(spark, [*rows, (5, [1.0] * 16, 1), (6, [1.0] * 7, 1), (8, [], 1)]) == by_hand(rows)  # other lengths
    large = rows + [(k, [x * 10.0**k for x in vector()], 3) for k in range(10, 13)]
    assert [r[:2] + r[4:] for r in found(spark, large)] == [r[:2] + r[4:] for r in by_hand(large)]
    assert found(spark, odd) == [] and vector_codes.product_codes(spark.createDataFrame([], SCHEMA)).count() == 0
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS code", "2 AS error", "3 AS x", "4 AS codes", "5 AS part", "6 AS _label")
    assert sorted(map(tuple, vector_codes.product_codes(table).collect()), key=repr) == by_hand(rows)
