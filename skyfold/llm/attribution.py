"""Operator 8: token counts of fields and sections by offset-mapped attribution.

Each document is encoded once, to the ids that training will see: it is cut only where the pre-tokenizer surely cuts, so
no token comes from the cut. A byte-level vocabulary loses nothing, so a token's span is where the bytes of the
tokens before it end; those spans are joined with the sections' spans as intervals. A token over a boundary
is allocated by `rule`:

    first    to the section of its first byte
    last     to the section of its last byte
    largest  to the section that holds most of its bytes, the earlier one of equals
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skyfold.llm.common import columns_of
from skyfold.llm.encoding import encoded, encoder

RULES = ("first", "last", "largest")
SECTIONS = "doc_id long, section long, char_start long, char_end long, n_tokens long, n_crossing long, doc_tokens long"


def line_spans(data: bytes) -> np.ndarray:
    """Ends of the sections of a text in bytes: its lines, each with the line break that ends it."""
    ends = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 10) + 1
    return ends if len(ends) and ends[-1] == len(data) else np.append(ends, len(data))


def attribute(token_sizes: np.ndarray, section_ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens allocated to each section, tokens of each that also reach into another one).

    token_sizes: bytes of each token, in order. section_ends: ascending, the last the end of the text; equal
    neighbours bound an empty section, which gets no token.
    """
    ends = np.cumsum(token_sizes)
    begins = ends - token_sizes
    head = np.searchsorted(section_ends, begins, side="right")
    tail = np.searchsorted(section_ends, ends - 1, side="right")
    owner = head if rule == "first" else tail.copy()
    if rule == "largest":
        for i in np.flatnonzero(head != tail):  # few: tokens that cross a boundary
            cut = np.concatenate([[begins[i]], section_ends[head[i] : tail[i]], [ends[i]]])
            owner[i] = head[i] + int(np.argmax(np.diff(cut)))
    n = len(section_ends)
    return np.bincount(owner, minlength=n), np.bincount(owner[head != tail], minlength=n)


def section_tokens(docs: DataFrame, vocabulary: str, rule: str = "largest", sections: Callable[[bytes], np.ndarray] = line_spans) -> DataFrame:
    """One row a section of each document: its place and span in code points, the tokens allocated to it, how
    many of those cross its boundary, and the tokens of the whole document.

    The sections' counts add up to the document's. A null or empty text is one empty section without tokens.
    Repeated rows and null doc_ids give their own rows; an empty table gives none. Other columns are not looked at.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {', '.join(RULES)}")

    names = [x.split()[0] for x in SECTIONS.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = encoder(vocabulary).sizes
        out: list[list[np.ndarray]] = [[] for _ in names]
        owners: list = []

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(owners, pa.int64()), *[pa.array(np.concatenate(x).astype(np.int64)) for x in out[1:]]], names=names)
            owners.clear()
            for column in out:
                column.clear()
            return batch

        for doc_id, text, ids in encoded(vocabulary, batches):
            data = text.as_buffer() if text.is_valid else b""
            ends = sections(data)
            n_tokens, n_crossing = attribute(sizes[ids], ends, rule)
            # code points before each byte: those bytes that don't continue one
            points = np.concatenate([[0], np.cumsum((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)])
            k = len(ends)
            owners += [doc_id] * k
            for column, value in zip(out[1:], (np.arange(k), points[np.concatenate([[0], ends[:-1]])], points[ends], n_tokens, n_crossing, np.full(k, len(ids))), strict=True):
                column.append(value)
            if len(owners) > 20_000:
                yield flush()
        if owners:
            yield flush()

    return columns_of(docs).mapInArrow(rows, SECTIONS)
