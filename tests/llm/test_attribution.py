import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skyfold.llm.attribution import RULES, attribute, section_tokens


@given(st.lists(st.integers(1, 5), min_size=1, max_size=20), st.lists(st.integers(0, 60), max_size=6), st.sampled_from(RULES))
@settings(max_examples=300, deadline=None)
def test_attribute_against_brute_force(sizes, cuts, rule):
    total = sum(sizes)
    ends = np.array(sorted(min(c, total) for c in cuts) + [total])
    held, crossing = [0] * len(ends), [0] * len(ends)
    at = 0
    for s in sizes:
        owners = [next(k for k, e in enumerate(ends) if b < e) for b in range(at, at + s)]
        own = owners[0] if rule == "first" else owners[-1] if rule == "last" else max(sorted(set(owners)), key=lambda k: owners.count(k))
        held[own] += 1
        crossing[own] += owners[0] != owners[-1]
        at += s
    found = attribute(np.array(sizes), ends, rule)
    assert found[0].tolist() == held and found[1].tolist() == crossing


def test_sections(spark, make_docs, vocabulary):
    texts = {1: "Ein Satz.\nçé ü\n\n\nende", 2: None, 3: "", 4: "a\n" * 500, 5: "\n\n  \n x", 6: "ohne Umbruch", 7: "语言😀\n模型", 8: "a <|endoftext|>\nb<|endoftext|>", 9: "语言<|endoftext|>。\n" * 300}
    rows = section_tokens(make_docs(texts), vocabulary, rule="first").collect()
    t = Tokenizer.from_file(vocabulary)
    for i, text in texts.items():
        own = sorted((r.section, r.char_start, r.char_end, r.n_tokens) for r in rows if r.doc_id == i)
        text = text or ""
        lines = text.splitlines(keepends=True) or [""]
        data = text.encode()
        ends = np.cumsum([len(x.encode()) for x in lines])
        sizes = [len(t.id_to_token(k)) for k in t.encode(text, add_special_tokens=False).ids]
        starts = np.cumsum([0, *sizes])[:-1]
        expected = [sum(1 for s in starts if (ends[k - 1] if k else 0) <= s < ends[k]) for k in range(len(lines))]
        assert [x[3] for x in own] == expected and sum(sizes) == len(data)
        assert "".join(text[a:b] for _, a, b, _ in own) == text
        assert all(r.doc_tokens == len(sizes) for r in rows if r.doc_id == i)
    assert section_tokens(make_docs([]), vocabulary).count() == 0
