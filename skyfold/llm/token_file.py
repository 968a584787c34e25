"""Operator 1: token ids in a Simple-8b file.

The file is a Parquet table of chunks, so that writing and reading go through Spark's committers and any
file system. Chunks lie in ascending document order. A chunk's payload is

    header   magic, ids, blocks, words, escapes           five unsigned 64-bit integers
    offsets  first word of each block, and the end        unsigned 32-bit integers, blocks + 1
    escapes  words that hold an id whole                  unsigned 32-bit integers
    words    Simple-8b words                              unsigned 64-bit integers

all little-endian. A block is 256 ids (the last one fewer). A word has a selector in its upper four bits and
as many ids as the selector says below, the first in the lowest bits. Selector 0 is the escape: the next word
is one id as it is. Since every block begins with a word of its own and words of one selector unpack alike,
decoding runs on arrays.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.llm.common import bases, columns_of, ranged, scratch_dir
from skyfold.llm.encoding import encoded

# Ids a word and bits an id of selectors 1 to 15, as published for Simple-8b.
COUNTS = [120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1]
BITS = [0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60]

ESCAPE = 0
BLOCK = 256
MAGIC = 0x38625F534B594601
CHUNK_IDS = 1 << 18

CHUNK_SCHEMA = "shard int, chunk int, start long, n_ids long, doc_ids array<long>, doc_sizes array<long>, payload binary"


_SMALL_WIDTHS = np.array([i.bit_length() for i in range(1 << 16)], dtype=np.uint8)


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits that each id needs."""
    if len(ids) and int(ids.max()) < len(_SMALL_WIDTHS):
        return _SMALL_WIDTHS[ids]
    return np.searchsorted(np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64)), ids, side="right").astype(np.uint8)


def encode_ids(ids: np.ndarray) -> bytes:
    """One chunk's payload."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    n = len(ids)
    blocks = -(-n // BLOCK)
    table = np.zeros((blocks, BLOCK + max(COUNTS)), dtype=np.uint64)
    table[:, :BLOCK].flat[: n] = ids
    width = np.zeros(table.shape, dtype=np.uint8)
    width[:, :BLOCK].flat[: n] = _widths(ids)
    # selector of the word that would begin at each place: the most ids whose largest width fits
    chosen = np.zeros((blocks, BLOCK), dtype=np.uint8)
    largest, span = {1: width}, 1
    while span * 2 <= max(COUNTS):
        m = largest[span].copy()
        m[:, :-span] = np.maximum(m[:, :-span], largest[span][:, span:])
        span *= 2
        largest[span] = m
    for selector in range(len(COUNTS), 0, -1):
        count, bits = COUNTS[selector - 1], BITS[selector - 1]
        p = 1 << (count.bit_length() - 1)
        m = np.maximum(largest[p][:, :BLOCK], largest[p][:, count - p : count - p + BLOCK])
        np.copyto(chosen, selector, where=m <= bits)
    size = np.full(blocks, BLOCK, dtype=np.int64)
    if blocks:
        size[-1] = n - BLOCK * (blocks - 1)
    takes = np.array([1, *COUNTS], dtype=np.int64)
    at, used = np.zeros(blocks, dtype=np.int64), np.zeros(blocks, dtype=np.int64)
    steps: list[tuple[np.ndarray, ...]] = []
    live = np.flatnonzero(at < size)
    while len(live):
        s = chosen[live, at[live]]
        steps.append((live, at[live], used[live], s))
        at[live] += takes[s]
        used[live] += np.where(s == ESCAPE, 2, 1)
        live = live[at[live] < size[live]]
    offsets = np.concatenate([[0], np.cumsum(used)])
    words = np.zeros(int(offsets[-1]), dtype=np.uint64)
    escapes = np.zeros(0, dtype=np.int64)
    if steps:
        row, pos, word, sel = (np.concatenate(x) for x in zip(*steps, strict=True))
        place = offsets[row] + word
        for selector in np.unique(sel):
            own = sel == selector
            if selector == ESCAPE:
                escapes = np.sort(place[own])
                words[place[own] + 1] = table[row[own], pos[own]]
                continue
            count, bits = COUNTS[selector - 1], BITS[selector - 1]
            packed = np.full(int(own.sum()), np.uint64(selector) << np.uint64(60), dtype=np.uint64)
            if bits:
                values = table[row[own][:, None], pos[own][:, None] + np.arange(count)]
                packed |= np.bitwise_or.reduce(values << (np.arange(count, dtype=np.uint64) * np.uint64(bits)), axis=1)
            words[place[own]] = packed
    head = struct.pack("<5Q", MAGIC, n, blocks, len(words), len(escapes))
    return head + offsets.astype("<u4").tobytes() + escapes.astype("<u4").tobytes() + words.astype("<u8").tobytes()


def decode_ids(payload: bytes) -> np.ndarray:
    """The ids of one chunk, unsigned 64-bit."""
    magic, n, blocks, n_words, n_escapes = struct.unpack_from("<5Q", payload)
    if magic != MAGIC:
        raise ValueError("not a chunk of this format")
    offsets = np.frombuffer(payload, dtype="<u4", count=blocks + 1, offset=40).astype(np.int64)
    escapes = np.frombuffer(payload, dtype="<u4", count=n_escapes, offset=40 + 4 * (blocks + 1)).astype(np.int64)
    words = np.frombuffer(payload, dtype="<u8", count=n_words, offset=40 + 4 * (blocks + 1 + n_escapes))
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array([1, *COUNTS], dtype=np.int64)[selector]
    if n_escapes:
        selector[escapes + 1] = -1
        counts[escapes + 1] = 0
    block = np.repeat(np.arange(blocks), np.diff(offsets))
    before = np.cumsum(counts) - counts
    first = before - before[offsets[:-1]][block] + BLOCK * block if n_words else before
    end = np.minimum(BLOCK * (block + 1), n)
    ids = np.zeros(n, dtype=np.uint64)
    if n_escapes:
        ids[first[escapes]] = words[escapes + 1]
    for s in np.unique(selector[selector > 0]):
        count, bits = COUNTS[s - 1], BITS[s - 1]
        if not bits:
            continue
        own = np.flatnonzero(selector == s)
        place = first[own][:, None] + np.arange(count)
        values = (words[own][:, None] >> (np.arange(count, dtype=np.uint64) * np.uint64(bits))) & np.uint64((1 << bits) - 1)
        held = place < end[own][:, None]
        ids[place[held]] = values[held]
    return ids


def write_token_file(docs: DataFrame, path: str, vocabulary: str, end_id: int = 2) -> None:
    """Encodes each document's whole text, appends end_id, and writes the ids in ascending doc_id order.

    A null text is an empty one: the end id alone. A null doc_id comes first. Rows with the same doc_id stay
    beside one another, ordered by a hash of their text; repeated rows are all written. An empty table makes an
    empty file. Other columns are not looked at.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        start = chunk = 0
        names: list = []
        held: list[np.ndarray] = []
        ids = 0

        def flush() -> pa.RecordBatch:
            nonlocal start, chunk, ids
            row = [[shard], [chunk], [start], [ids], [list(names)], [[len(x) for x in held]], [encode_ids(np.concatenate(held))]]
            start, chunk, ids = start + ids, chunk + 1, 0
            names.clear()
            held.clear()
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types, strict=True)], names=["shard", "chunk", "start", "n_ids", "doc_ids", "doc_sizes", "payload"])

        for doc_id, _, own in encoded(vocabulary, batches, end_id):
            names.append(doc_id)
            held.append(own)
            ids += len(own)
            if ids >= CHUNK_IDS:
                yield flush()
        if held:
            yield flush()

    ranged(columns_of(docs)).mapInArrow(chunks, CHUNK_SCHEMA).write.parquet(path)


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian unsigned 32-bit, as binary) of each document of a file."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_ids(row["payload"]).astype("<u4")
                sizes = np.array(row["doc_sizes"], dtype=np.int64)
                ends = np.cumsum(sizes)
                blobs = [ids[e - s : e].tobytes() for s, e in zip(sizes, ends, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + row["base"] + ends - sizes), pa.array(sizes), pa.array(blobs, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])

    chunks = spark.read.schema(CHUNK_SCHEMA).parquet(path)
    base = bases(chunks.select("shard", "n_ids"), "shard", "n_ids", "base")
    return chunks.join(F.broadcast(base), "shard").select("start", "base", "doc_ids", "doc_sizes", "payload").mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary")


def token_digest(docs: DataFrame, vocabulary: str, end_id: int = 2) -> DataFrame:
    """Writes a file into the shared folder and returns, from the file: doc_id, start, n_tokens, ids_crc32."""

    spark = docs.sparkSession
    path = f"{scratch_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_token_file(docs, path, vocabulary, end_id)
    return read_token_file(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


