"""Whole texts to token ids with the tokenizers library, at a few million characters a second and core."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space twice running, white space other than spaces and line breaks, or the separator itself: such a
#: text is encoded in one piece.
_NO_CUT = r"[ \n][ \n]|[\x{0}\t\v\f\r\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: A stop or comma that doesn't follow a letter or digit belongs to the token before it.
_NO_STOP_CUT = r"(?:^|[^\pL\pN])[.,]"
#: Bytes of pieces and their ids that a worker remembers. Beyond them it forgets all but those just used.
KEPT_BYTES = 12_000_000
#: Longer pieces are encoded each time.
LONGEST_KEPT = 64
#: Bytes of text that are cut up and encoded at once, besides one document.
PART_BYTES = 3_500_000


def _bounds(pieces: pa.Array) -> np.ndarray:
    """Where each string of an array begins in its bytes, and the end."""
    return np.frombuffer(pieces.buffers()[1], dtype=np.int32)[pieces.offset : pieces.offset + len(pieces) + 1].astype(np.int64) if len(pieces) else np.zeros(1, dtype=np.int64)


class Encoder:
    """Encodes texts piece by piece, remembering the ids of pieces.

    The byte-level pre-tokenizer always cuts before a space or line break that follows something else, and
    between a letter or digit and a stop or comma, so texts cut there have the same ids as whole ones.
    Texts where that is not certain, and those with the name of an added token in them, are encoded whole.
    Pieces are cut, told apart and looked up as Arrow arrays; what is remembered is bounded in bytes.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.no_cut = "|".join([_NO_CUT, *map(re.escape, added)])
        vocabulary = self.tokenizer.get_vocab()
        self.sizes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, i in vocabulary.items():  # one character of a token stands for one byte
            self.sizes[i] = len(token)
        self.pieces = pa.array([], pa.string())
        self.ids = np.zeros(0, dtype="<u4")
        self.ends = np.zeros(1, dtype=np.int64)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; a few texts at a time, as the library holds more of a token than its id."""
        found = []
        for at in range(0, len(texts), 32):
            found += [np.frombuffer(array("I", e.ids), dtype="<u4") for e in self.tokenizer.encode_batch_fast(texts[at : at + 32], add_special_tokens=False)]
        return found

    def learn(self, fresh: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(pieces, their ids one after another, how many each has). Those of one white space and a word go through
        the library together: it cuts before each white space, and the bytes of the tokens tell where a piece ends."""
        at = _bounds(fresh)
        data = np.frombuffer(fresh.buffers()[2], dtype=np.uint8) if at[-1] else np.zeros(0, dtype=np.uint8)
        many = np.diff(at) > 1
        many[many] = np.isin(data[at[:-1][many]], (10, 32))
        words, rest = fresh.filter(pa.array(many)), fresh.filter(pa.array(~many))
        ids, counts = [], []
        if len(words):
            at, text = _bounds(words), words.buffers()[2].to_pybytes()
            # a thousand words a text: longer and shorter ones both take the library more time
            starts = [*range(0, len(words), 1000), len(words)]
            ids.append(np.concatenate(self._whole([text[at[a] : at[b]].decode() for a, b in zip(starts, starts[1:], strict=False)])))
            ends = np.searchsorted(np.cumsum(self.sizes[ids[0]]), at[1:] - at[0]) + 1
            counts.append(np.diff(ends, prepend=0))
        if len(rest):
            own = self._whole(rest.to_pylist())
            ids += own
            counts.append(np.fromiter(map(len, own), dtype=np.int64, count=len(own)))
        return pa.concat_arrays([words, rest]), np.concatenate([np.zeros(0, dtype="<u4"), *ids]), np.concatenate([np.zeros(0, dtype=np.int64), *counts])

    def _keep(self, used: np.ndarray) -> None:
        """Forgets pieces: long ones, and all that aren't `used` where there are too many bytes of them."""
        sizes, short = np.diff(self.ends), np.diff(_bounds(self.pieces)) <= LONGEST_KEPT
        if self.pieces.nbytes + self.ids.nbytes + self.ends.nbytes > KEPT_BYTES:
            short &= used
        if not short.all():
            self.pieces = pa.concat_arrays([self.pieces.filter(pa.array(short))])
            self.ids = self.ids[np.repeat(short, sizes)]
            self.ends = np.concatenate([[0], np.cumsum(sizes[short])])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all the texts, unsigned 32-bit; where each text's begin, and the end). A null has none."""
        texts = pc.fill_null(texts, "")
        whole = pc.match_substring_regex(texts, self.no_cut)
        easy = pc.if_else(whole, "", texts)
        cut = pc.replace_substring(pc.replace_substring(easy, " ", "\0 "), "\n", "\0\n")
        finer = pc.replace_substring(pc.replace_substring(cut, ".", "\0."), ",", "\0,")
        lists = pc.split_pattern(pc.if_else(pc.match_substring_regex(easy, _NO_STOP_CUT), cut, finer), "\0")
        del easy, cut, finer
        first = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        found = lists.flatten().dictionary_encode()
        del lists
        place = pc.index_in(found.dictionary, value_set=self.pieces)
        if place.null_count:
            new = place.is_null()
            fresh, ids, counts = self.learn(found.dictionary.filter(new))
            self.pieces = pa.concat_arrays([self.pieces, fresh])
            self.ids = np.concatenate([self.ids, ids])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])
            place = pc.index_in(found.dictionary, value_set=self.pieces)
        place = place.to_numpy()
        used = place[found.indices.to_numpy()]
        each = np.diff(self.ends)[used]
        ends = np.cumsum(each)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat((self.ends[1:][used] - ends).astype(np.int32), each) + np.arange(total, dtype=np.int32)]
        offsets = np.concatenate([[0], ends])[first]
        mark = np.zeros(len(self.pieces), dtype=bool)
        mark[place] = True
        self._keep(mark)
        rows = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        if not len(rows):
            return ids, offsets
        parts = [ids[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]
        for i in rows.tolist():
            (parts[i],) = self._whole([texts[i].as_py()])
        return np.concatenate(parts), np.cumsum([0, *map(len, parts)])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encoded(path: str, batches: Iterable[pa.RecordBatch], end_id: int | None = None) -> Iterator[tuple[int | None, pa.StringScalar, np.ndarray]]:
    """(doc_id, text, ids) of each row of batches with doc_id and text; end_id comes after the ids if given."""
    encode = encoder(path)
    for batch in batches:
        at = 0
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
        while at < batch.num_rows:
            done = size[at - 1] if at else 0
            part = batch.slice(at, max(1, int(np.searchsorted(size, done + PART_BYTES, side="right")) - at))
            at += part.num_rows
            ids, offsets = encode(part.column("text"))
            if end_id is not None:
                ids = np.insert(ids, offsets[1:], end_id)
                offsets = offsets + np.arange(len(offsets))
            for k, doc_id in enumerate(part.column("doc_id").to_pylist()):
                yield doc_id, part.column("text")[k], ids[offsets[k] : offsets[k + 1]]
