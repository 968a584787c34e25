import random

import pytest
from pyspark.sql import functions as F
from sequential import debounced

from skyfold.operators import state
from skyfold.operators.asof import asof_join


def by_hand(left, right, within, strict):
    found = []
    for k, key, t in left:
        near = [(o, n) for n, other, o in right if None not in (key, t, other, o) and other == key and (o < t if strict else o <= t)]
        best = max(near, default=None)
        found.append((k, best[1] if best and (within is None or t - best[0] <= within) else None))
    return sorted(found)


def drawn(seed, n):
    draw = random.Random(seed)
    key = lambda: draw.choice(["hot", "hot", "hot", "a", "b", None])
    return [(k, key(), draw.choice([None, *range(-50, 50)] + [draw.randrange(-400, 400) for _ in range(100)])) for k in range(n)]


@pytest.mark.parametrize(("within", "strict", "bucket"), [(None, False, 40), (7, False, 40), (7, True, 10_000), (None, True, 1)])
def test_asof_equals_all_pairs(spark, within, strict, bucket):
    left, right = drawn(1, 300), drawn(2, 200)
    table = [spark.createDataFrame(x, "n long, k string, t long") for x in (left, right)]
    found = asof_join(*table, ["k"], "t", bucket, within, strict, ties=["n"])
    assert sorted((r.n, r.other and r.other.n) for r in found.collect()) == by_hand(left, right, within, strict)


def test_asof_with_empty_sides_and_names_that_clash(spark):
    left = spark.createDataFrame([(1, "a", 5)], "n long, k string, t long").selectExpr("*", "1 AS _b", "2 AS _side", "3 AS _r", "4 AS _rank", "5 AS _o")
    none = left.limit(0)
    (row,) = asof_join(left, none, ["k"], "t", 10).collect()
    assert row.other is None and (row.n, row._b, row._o) == (1, 1, 5)
    assert asof_join(none, left, ["k"], "t", 10).count() == 0
    assert asof_join(left, left, ["k"], "t", 10).first().other._side == 2


@pytest.mark.parametrize(("n", "force"), [(1, False), (2, True), (3, False), (5, True)])
def test_split_debouncing_equals_the_windows_and_the_rule(spark, n, force):
    draw = random.Random(n)
    rows, at = [], 0
    while at < 900:  # runs that go over whole stretches, and stretches of one aircraft without a value
        for _ in range(draw.choice([1, 1, 2, 3, 40, 90])):
            rows.append((at, draw.choice([1, 1, 1, 2]), draw.choice(["a", "b", "c", None]) if draw.random() < 0.3 else "ab"[at // 120 % 2] if draw.random() < 0.9 else None))
            at += 1
    df = spark.createDataFrame(rows, "seq long, k int, v string").withColumn("b", F.expr("seq div 17")).withColumn("seed", F.when(F.col("k") == 2, "s"))
    at_once = F.col("v") == "c" if force else None
    found = [(r.seq, r.known) for r in state.debounce_split(df, "k", "b", ["seq"], "v", n, "known", at_once, "seed").orderBy("seq").collect()]
    windows = [(r.seq, r.known) for r in state.debounce(df, "k", ["seq"], "v", n, "known", at_once, "seed").orderBy("seq").collect()]
    assert found == windows
    for k in (1, 2):
        own = [(s, v) for s, x, v in rows if x == k]
        expected = debounced([v for _, v in own], n, {"c"} if force else set())
        assert [x for s, x in found if s in dict(own)] == [e if e is not None or k == 1 else "s" for e in expected]
