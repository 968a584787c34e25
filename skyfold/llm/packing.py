"""Operator 9: order-preserving packing by dynamic programming.

Documents stand in doc_id order in one stream a range partition. A sequence is a stretch of that stream, at
most `budget` tokens. Places to cut are document ends, sentence ends inside documents and, where neither comes
for `longest_gap` tokens, a grid of plain token positions. The plan minimises, over all choices of cuts,

    padding(length) + per_sequence, summed over the sequences, + the penalty of each cut,

where a sequence whose length is a power of two needs no padding and any other is padded to the budget.
The linear part of the padding makes best(i) = min over j in reach of best(j) + place(j), plus terms of i
alone: a sliding-window minimum, which a monotone queue gives in constant time a cut. The powers of two are
a handful of further transitions to exact places.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from skyfold.llm.common import columns_of, ranged
from skyfold.llm.encoding import encoded, encoder

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Sequences of one partition are numbered below this.
PER_PARTITION = 1 << 40
#: Tokens planned at once, besides one document; what the plan leaves open goes on to the next stretch.
STRETCH = 1 << 18


def plan_cuts(places: np.ndarray, penalties: np.ndarray, budget: int, per_sequence: int) -> list[int]:
    """Ends of the sequences of the best plan over a stretch, by the cost above.

    places: ascending, the first 0 and the last the stretch's end, no two neighbours over `budget` apart.
    penalties: of a cut at each place. Equal costs: the longest last sequence wins.
    """
    n = len(places)
    powers: dict[int, list[int]] = {}
    for k in range(budget.bit_length()):
        want = places - (1 << k)
        found = np.searchsorted(places, want)
        for i in np.flatnonzero((want >= 0) & (places[np.minimum(found, n - 1)] == want)).tolist():
            powers.setdefault(i, []).append(int(found[i]))
    place, penalty = places.tolist(), penalties.tolist()
    best, back = [0.0] * n, [0] * n
    window: deque[tuple[float, int]] = deque([(0.0, 0)])
    for i in range(1, n):
        here = place[i]
        while place[window[0][1]] < here - budget:
            window.popleft()
        low, j = window[0]
        low += budget - here
        for p in powers.get(i, ()):
            if best[p] < low:
                low, j = best[p], p
        best[i] = low + per_sequence + penalty[i]
        back[i] = j
        key = best[i] + here
        while window and window[-1][0] > key:
            window.pop()
        window.append((key, i))
    ends, i = [], n - 1
    while i:
        ends.append(place[i])
        i = back[i]
    return ends[::-1]


class _Boundaries:
    """Where sentences end, read off the token ids of one vocabulary."""

    def __init__(self, path: str):
        vocabulary = encoder(path).tokenizer.get_vocab()
        size = max(vocabulary.values()) + 1
        self.breaks, self.stops, self.opens = (np.zeros(size, dtype=bool) for _ in range(3))
        for token, i in vocabulary.items():  # Ċ and Ġ stand for the line break and the space
            self.breaks[i] = token.endswith("Ċ")
            self.stops[i] = token.endswith((".", "!", "?"))
            self.opens[i] = token.startswith(("Ġ", "Ċ"))

    def after(self, ids: np.ndarray) -> np.ndarray:
        """Places inside a document, counted in tokens, that follow a line break, or a stop before white space."""
        return np.flatnonzero(self.breaks[ids[:-1]] | self.stops[ids[:-1]] & self.opens[ids[1:]]) + 1


_boundaries: dict[str, _Boundaries] = {}


def cut_places(ids: np.ndarray, sentence_ends: np.ndarray, longest_gap: int, grid: int, sentence: float, hard: float) -> tuple[np.ndarray, np.ndarray]:
    """(places, penalties) inside and at the end of one document of these ids."""
    n = len(ids)
    marks = np.concatenate([[0], sentence_ends, [n]])
    wide = np.flatnonzero(np.diff(marks) > longest_gap)
    extra = [np.arange(marks[w] + grid, marks[w + 1], grid) for w in wide]
    places = np.concatenate([sentence_ends, *extra, [n]]).astype(np.int64)
    penalties = np.concatenate([np.full(len(sentence_ends), sentence), *[np.full(len(x), hard) for x in extra], [0.0]])
    order = np.argsort(places, kind="stable")
    return places[order], penalties[order]


def pack_documents(docs: DataFrame, vocabulary: str, budget: int = 2048, end_id: int = 1, longest_gap: int = 256, grid: int = 32, sentence: float = 12, hard: float = 48, per_sequence: float = 8, with_ids: bool = False) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids if asked for.

    A null or empty text is its end id alone. Null doc_ids come first; rows with the same doc_id or the same text
    are packed each on its own. An empty table gives no rows. A document longer than the budget is cut at sentence
    ends where it can be. Other columns are not looked at. Each task holds one stretch of STRETCH tokens and the
    document it ends in, never a partition.
    """
    names = [x.split()[0] for x in PIECES.split(", ")] + ["ids"] * with_ids
    types = [pa.int64()] * 7 + [pa.binary()] * with_ids

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _boundaries:
            _boundaries[vocabulary] = _Boundaries(vocabulary)
        sentences = _boundaries[vocabulary]
        sequence = TaskContext.get().partitionId() * PER_PARTITION
        held: list[tuple] = []  # (doc_id, ids, first id not yet packed)
        tokens = 0

        def stretch(last: bool) -> pa.RecordBatch:
            nonlocal sequence, held, tokens
            at, places, penalties = 0, [np.zeros(1, dtype=np.int64)], [np.zeros(1)]
            for _, ids, done in held:
                p, q = cut_places(ids[done:], sentences.after(ids[done:]), longest_gap, grid, sentence, hard)
                places.append(p + at)
                penalties.append(q)
                at += len(ids) - done
            plan = plan_cuts(np.concatenate(places), np.concatenate(penalties), budget, per_sequence)
            if not last:  # what comes next may change the last sequences
                keep = [x for x in plan if x <= at - 4 * budget]
                plan = keep or plan[:1]
            rows: list[list] = [[] for _ in names]
            k, begun = 0, 0
            for end in plan:
                offset = 0
                while begun < end:
                    doc_id, ids, done = held[k]
                    length = min(len(ids) - done, end - begun)
                    own = ids[done : done + length].tobytes()
                    for column, value in zip(rows, (doc_id, done, length, zlib.crc32(own), len(ids), sequence, offset, own), strict=False):
                        column.append(value)
                    held[k] = (doc_id, ids, done + length)
                    k += done + length == len(ids)
                    begun += length
                    offset += length
                sequence += 1
            held = held[k:]
            tokens -= begun
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, types, strict=True)], names=names)

        for doc_id, _, ids in encoded(vocabulary, batches, end_id):
            held.append((doc_id, ids, 0))
            tokens += len(ids)
            if tokens >= STRETCH:
                yield stretch(last=False)
        if held:
            yield stretch(last=True)

    return ranged(columns_of(docs)).mapInArrow(pieces, PIECES + ", ids binary" * with_ids)
