import hashlib
import random
import zlib

import pytest

from skyfold.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes):
    """The levels over some nodes."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k : k + 8]) for k in range(0, len(levels[-1]), 8)])
    return levels


def climb(levels, at, digest):
    """(siblings on the way up, what a digest folds to)"""
    proof = []
    for level in levels[:-1]:
        run = level[at // 8 * 8 : at // 8 * 8 + 8]
        proof += run[: at % 8] + run[at % 8 + 1 :]
        digest = h(*run[: at % 8], digest, *run[at % 8 + 1 :])
        at //= 8
    return proof, digest


def by_hand(rows):
    first = lambda v: (v is not None, v if v is not None else "")
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    own = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (first(r[0]) if r[0] is None else (True, r[0]), leaf(r))) for x in langs}
    trees = {x: tree([leaf(r) for r in own[x]]) for x in langs}
    top = tree([trees[x][-1][0] for x in langs])
    out = []
    for k, x in enumerate(langs):
        for at, r in enumerate(own[x]):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            text = None if r[4] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
            proof, end = climb(trees[x], at, leaf((*r[:4], text)) if bad else leaf(r))
            more, end = climb(top, k, end)
            out.append((r[0], leaf(r), trees[x][-1][0], top[-1][0], h(*proof, *more), end, end == top[-1][0]))
    return sorted(out, key=repr)


def drawn(seed, sizes):
    draw = random.Random(seed)
    rows = [(None, x, n) for x, n in sizes.items()]
    ids = iter(draw.sample(range(10**6), sum(sizes.values())))
    out = []
    for _, lang, n in rows:
        for _ in range(n):
            text = draw.choice([None, "", "no capitals", "Ünïcode ÄÖ Text 🙂", "A" * draw.randrange(5), f"Words {draw.random()}"])
            out.append((next(ids), draw.choice([None, "s", "a:b"]), lang, draw.choice([None, 0, 12345]), text))
    draw.shuffle(out)
    return out


SIZES = [
    {"en": 1},
    {"en": 8},
    {"en": 9, None: 1},
    {"en": 600, "de": 65, "fr": 64, None: 7, "": 1, "é": 2, "z": 8},
    {f"l{k}": 1 + k % 3 for k in range(75)},  # languages' roots make a tree of three levels
    {"en": 4100, "de": 513},
]


@pytest.mark.parametrize("sizes", SIZES)
def test_proofs_equal_the_definition(spark, sizes):
    rows = drawn(len(sizes), sizes)
    found = merkle.merkle_proofs(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, found), key=repr) == by_hand(rows)
    if sum(sizes.values()) > 100:
        assert {r.verified for r in found} == {True, False}


def test_store_has_every_level_once(spark):
    rows = drawn(3, {"en": 530, "de": 64})
    trees, tops = merkle.manifest(spark.createDataFrame(rows, SCHEMA))
    counts = [{r.tree: r["count"] for r in level.groupBy("tree").count().collect()} for level in trees.levels]
    assert counts == [{0: 64, 1: 530}, {0: 8, 1: 67}, {0: 1, 1: 9}, {1: 2}, {1: 1}]
    assert [level.count() for level in tops.levels] == [2, 1]
    own = sorted((r.tree, r.pos, r.digest) for r in trees.levels[1].collect())
    assert [d for t, _, d in own if t == 0] == tree([leaf(r) for r in sorted(x for x in rows if x[2] == "de")])[1]


def test_equal_rows_nulls_and_other_columns(spark):
    rows = [(5, "s", "en", 1, "A")] * 20 + [(5, "s", "en", 1, "B")] * 3 + [(None, None, None, None, None)] * 9 + [(None, "x", "en", None, "C")]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS tree", "'y' AS pos", "1 AS n", "2 AS digest", "3 AS leaf", "4 AS shown", "5 AS _tie", "6 AS _at")
    assert sorted(map(tuple, merkle.merkle_proofs(table).collect()), key=repr) == by_hand(rows)
    assert merkle.merkle_proofs(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_very_long_text(spark):
    rows = [(k, "s", "en", 1, "Ab ü " * 400_000 if k == 3 else "x") for k in range(5)]
    assert sorted(map(tuple, merkle.merkle_proofs(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr) == by_hand(rows)
