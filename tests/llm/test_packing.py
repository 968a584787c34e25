import zlib
from collections import defaultdict
from functools import cache

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skyfold.llm.packing import STRETCH, pack_documents, plan_cuts


@given(st.lists(st.tuples(st.integers(1, 16), st.integers(0, 5)), min_size=1, max_size=14), st.integers(0, 3))
@settings(max_examples=300, deadline=None)
def test_plan_is_the_cheapest(steps, per_sequence):
    places = np.concatenate([[0], np.cumsum([s for s, _ in steps])])
    penalties = np.array([0, *[p for _, p in steps]], dtype=float)

    def padding(n):
        return 0 if n & (n - 1) == 0 else 16 - n

    @cache
    def best(i):
        return 0 if i == 0 else min(best(j) + padding(int(places[i] - places[j])) + per_sequence + penalties[i] for j in range(i) if places[i] - places[j] <= 16)

    ends = plan_cuts(places, penalties, 16, per_sequence)
    where = {int(p): i for i, p in enumerate(places)}
    cost = sum(padding(e - b) + per_sequence + penalties[where[e]] for b, e in zip([0, *ends], ends))
    assert ends[-1] == places[-1] and cost == best(len(places) - 1)


def test_pieces(spark, make_docs, vocabulary):
    texts = {0: "One sentence here. Another one there.\n" * 900, 1: None, 2: "", 3: "word" * 9000, 4: "a b c", 5: "a b c", 400: "Ein Satz, und <|endoftext|> noch einer. " * 30_000, 401: "a<|endoftext|>语", 402: "语言。模型\n" * 40_000, 403: "x. " * 200_000, **{i: "Short and dull. " * (i % 37) for i in range(6, 300)}}
    rows = pack_documents(make_docs(texts), vocabulary).collect()
    t = Tokenizer.from_file(vocabulary)
    ids = {i: [*t.encode(x or "", add_special_tokens=False).ids, 1] for i, x in texts.items()}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        own = ids[r.doc_id][r.start : r.start + r.length]
        assert len(own) == r.length > 0 and r.doc_tokens == len(ids[r.doc_id])
        assert zlib.crc32(np.array(own, dtype="<u4").tobytes()) == r.ids_crc32
        by_doc[r.doc_id].append((r.start, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for i, x in ids.items():
        at = 0
        for start, length in sorted(by_doc[i]):
            assert start == at
            at += length
        assert at == len(x)
    padded = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
        padded += 0 if at & (at - 1) == 0 else 2048 - at
    assert sum(map(len, ids.values())) > 3 * STRETCH
    assert padded < 0.04 * sum(map(len, ids.values())) + 4 * 2048


def test_repeated_rows_and_empty_table(spark, make_docs, vocabulary):
    assert pack_documents(make_docs([]), vocabulary).count() == 0
    rows = pack_documents(make_docs([(7, "x y z"), (7, "x y z"), (None, None)]), vocabulary).collect()
    assert sorted((r.doc_id is None, r.length) for r in rows) == [(False, 4), (False, 4), (True, 1)]
