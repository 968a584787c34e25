"""Operator 7: quality rules with a hashed n-gram logistic regression.

The plain rules count what a text repeats and decorates. The method adds a logistic regression over hashed
word 1- and 2-grams and character 3- to 5-grams, trained on labelled quality rows, its score turned into a
probability on rows held out of the training, and compared with a fixed threshold. Texts are hashed and
scored in Arrow batches, as arrays of bytes.

Words are what white space (space, tab to carriage return) separates. A null text has no words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyfold.llm.common import bounded_batches, columns_of, text_key, written

SPACE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
_INNER = bytes(range(0x80, 0xC0))  # bytes that continue a code point
#: Bytes of a text whose n-grams are hashed at once.
PART = 1 << 16
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_UP = np.cumprod(np.full(PART, _BASE))
_DOWN = np.cumprod(np.full(PART, np.uint64(pow(int(_BASE), -1, 1 << 64))))

RESULT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, probability double, kept boolean"


def repeat_words(words: list[bytes], size: int = 5) -> int:
    """Words inside windows of `size` words that stand twice or more in the list."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    each = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int32, count=len(words))
    windows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(each, size)).view(f"V{4 * size}").ravel()
    _, which, seen = np.unique(windows, return_inverse=True, return_counts=True)
    twice = (seen[which] > 1).astype(np.int32)
    return int(np.count_nonzero(np.convolve(twice, np.ones(size, dtype=np.int32))))


def counts(data: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text in UTF-8."""
    words = data.split(None)
    bare = data.translate(None, SPACE)
    lines: set[bytes] = set()
    with_word = 0
    for line in data.split(b"\n"):
        if line.strip(SPACE):
            with_word += 1
            lines.add(line)
    return len(words), len(bare.translate(None, _INNER)), len(bare) - len(bare.translate(None, SYMBOLS)), with_word - len(lines), repeat_words(words)


@dataclass
class Hashing:
    """n-grams of a text as places in a weight vector; families lie one after another and weigh alike."""

    bits: int = 16
    chars: tuple[int, ...] = (3, 4, 5)

    @property
    def size(self) -> int:
        return (2 + len(self.chars)) << self.bits

    def parts(self, text: bytes) -> Iterator[list[np.ndarray]]:
        """For each family, the place of each of the text's n-grams; a long text in several parts, cut at white space.

        A word without white space in a whole part is cut like the text.
        """
        at, last = 0, np.zeros(0, dtype=np.uint64)
        while at < len(text):
            end = at + PART
            if end < len(text):
                end = max(text.rfind(c, at, end) for c in (b" ", b"\n", b"\t")) + 1 or end
            end = min(end, len(text))
            words = self._words(np.frombuffer(text, np.uint8, end - at, at))
            beside = np.concatenate([last, words])
            yield self._placed(words, beside[:-1] * _BASE + beside[1:], text[at : end + max(self.chars) - 1], end - at)
            at, last = end, beside[-1:]

    @staticmethod
    def _words(data: np.ndarray) -> np.ndarray:
        """A hash of each word: the sum of byte * base^-(place in word), from running sums over the data."""
        space = (data == 32) | ((data >= 9) & (data <= 13))
        edges = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).view(np.int8)))
        begins, ends = edges[::2], edges[1::2]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _UP[: len(data)])])
        return (sums[ends] - sums[begins]) * _DOWN[begins]

    def _placed(self, words: np.ndarray, pairs: np.ndarray, text: bytes, starts: int) -> list[np.ndarray]:
        """Places of word n-grams, given as hashes, and of the character n-grams that begin in the first `starts` bytes."""
        shift = np.uint64(64 - self.bits)
        found = [(words * _MIX) >> shift, (pairs * _MIX) >> shift]
        wide = np.frombuffer(text, dtype=np.uint8).astype(np.uint64)
        for k in self.chars:
            n = max(0, min(starts, len(wide) - k + 1))
            h = wide[:n].copy()
            for i in range(1, k):
                h = (h << np.uint64(8)) | wide[i : n + i]
            h ^= h >> np.uint64(17)
            found.append((h * _BASE * _MIX) >> shift)
        return [x.astype(np.int64) + (f << self.bits) for f, x in enumerate(found)]

    def places(self, text: bytes) -> list[np.ndarray]:
        """For each family, the place of each of the text's n-grams."""
        every = list(self.parts(text)) or [[np.zeros(0, dtype=np.int64)] * (2 + len(self.chars))]
        return [np.concatenate(x) for x in zip(*every, strict=True)]

    def shares(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(places, ascending; the share of its family's n-grams that each has)."""
        total = np.zeros(self.size, dtype=np.int64)
        for part in self.parts(text):
            for x in part:
                total += np.bincount(x, minlength=self.size)
        families = total.reshape(-1, 1 << self.bits)
        at = np.flatnonzero(total)
        return at, (families / np.maximum(families.sum(axis=1, keepdims=True), 1)).ravel()[at]


@dataclass
class QualityModel:
    """Weights of the n-grams, the bias, and the line from a score to log odds."""

    hashing: Hashing
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0
    held_out: dict = field(default_factory=dict)

    def score(self, text: bytes) -> float:
        """The bias plus the mean weight of each family's n-grams."""
        sums, n = np.zeros(2 + len(self.hashing.chars)), np.zeros(2 + len(self.hashing.chars))
        for part in self.hashing.parts(text):
            for f, x in enumerate(part):
                sums[f] += self.weights[x].sum(dtype=np.float64)
                n[f] += len(x)
        return self.bias + float((sums / np.maximum(n, 1)).sum())

    def probability(self, text: bytes) -> float:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.score(text) + self.shift, -500, 500)))


def _descent(fit: list[tuple[int, np.ndarray, np.ndarray]], size: int, epochs: int, rate: float) -> tuple[np.ndarray, float]:
    """(weights, bias) by stochastic descent with a rate of its own for each weight."""
    # rarer labels weigh as much as frequent ones; calibration puts the prior back
    share = np.mean([r[0] for r in fit])
    balance = (0.5 / (1 - share), 0.5 / share)
    weights, squares, bias, bias_squares = np.zeros(size), np.full(size, 1e-8), 0.0, 1e-8
    for _ in range(epochs):
        for label, at, value in fit:
            z = bias + weights[at] @ value
            slip = balance[label] * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - label)
            g = slip * value
            squares[at] += g * g
            weights[at] -= rate * g / np.sqrt(squares[at])
            bias_squares += slip * slip
            bias -= rate * slip / np.sqrt(bias_squares) / 10
    return weights, float(bias)


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, most_rows: int, most_bytes: int) -> DataFrame:
    """(label, text) of labelled documents: at most most_rows of them and most_bytes of text, those of the least hashes.

    Both bounds are taken after labels have met documents, so a doc_id on very many rows counts each different text.
    """
    wanted = (
        labels.where(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull())
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(most_rows)
    )
    key = ["doc_id", "label", "key"]
    met = columns_of(docs).where("text is not null").join(F.broadcast(wanted), "doc_id").select("doc_id", "label", text_key().alias("key"), "text")
    met = written(met.groupBy(*key).agg(F.first("text").alias("text")), "labelled")
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("label"), F.col("key")]
    few = met.select(*key, F.octet_length("text").alias("size")).orderBy(*order).limit(most_rows)
    sums = few.withColumn("_sum", F.sum("size").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return met.join(F.broadcast(sums.where(F.col("_sum") <= most_bytes).select(*key)), key).select("label", "text")


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", most_rows: int = 3000, most_bytes: int = 16_000_000, epochs: int = 12, rate: float = 4.0, seed: int = 7) -> QualityModel | None:
    """Fits the regression on labelled rows and calibrates it on every fifth of them, held out.

    most_rows and most_bytes bound the sample, whatever the tables' size. The bounded sample is fitted in one task,
    and the weights alone come to the driver. None if no row has either label; rows with a null label or text don't
    count, and equal rows of a doc_id and label count once.
    """
    labelled = labelled_sample(docs, labels, label_col, most_rows, most_bytes)
    hashing = Hashing()

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for k, label in enumerate(batch.column("label").to_pylist()):
                at, value = hashing.shares(batch.column("text")[k].as_py().encode())
                rows.append((label, at.astype("<i4"), value.astype("<f4")))
        rows.sort(key=lambda r: (r[0], hashlib.blake2b(r[1].tobytes() + r[2].tobytes()).digest()))  # whatever order the tasks ended in
        np.random.default_rng(seed).shuffle(rows)
        fit, held = [r for k, r in enumerate(rows) if k % 5], rows[::5]
        if len({r[0] for r in fit}) < 2:
            return
        weights, bias = _descent(fit, hashing.size, epochs, rate)
        scores = np.array([bias + weights[at] @ value for _, at, value in held])
        truth = np.array([r[0] for r in held])
        slope, shift = _calibrated(scores, truth)
        right = float(((slope * scores + shift > 0) == (truth > 0)).mean()) if len(held) else 1.0
        found = (weights.astype("<f4").tobytes(), bias, slope, shift, len(held), right)
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in found], names=["weights", "bias", "slope", "shift", "n_held", "accuracy"])

    found = labelled.repartition(1).mapInArrow(fitted, "weights binary, bias double, slope double, shift double, n_held long, accuracy double").collect()
    if not found:
        return None
    (m,) = found
    return QualityModel(hashing, np.frombuffer(bytes(m.weights), dtype="<f4"), m.bias, m.slope, m.shift, {"rows": m.n_held, "accuracy": m.accuracy})


def _calibrated(scores: np.ndarray, truth: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Platt's line: log odds = slope * score + shift, fitted to softened labels so that it stays finite."""
    up = int(truth.sum())
    down = len(truth) - up
    if not up or not down:
        return 1.0, 0.0
    goal = np.where(truth > 0, (up + 1) / (up + 2), 1 / (down + 2))
    scale = max(float(np.std(scores)), 1e-9)
    x = np.stack([scores / scale, np.ones(len(scores))])
    line = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(line @ x, -500, 500)))
        line -= np.clip(np.linalg.solve((x * (p * (1 - p) + 1e-9)) @ x.T + 1e-6 * np.eye(2), x @ (p - goal)), -2, 2)
    return float(line[0] / scale), float(line[1])


#: Production thresholds: words, share of repeated words, and probability of good quality.
LEAST_WORDS, MOST_REPEATED, LEAST_PROBABILITY = 10, 0.2, 0.35


def _verdict(text: bytes, model: QualityModel | None, least_words: int, hundredths: int, least_probability: float) -> tuple:
    found = counts(text)
    failed = found[0] < least_words or 100 * found[4] > hundredths * found[0]
    p = model.probability(text) if model else None
    return *found, failed, p, not failed and (p is None or p >= least_probability)


def filter_kept(docs: DataFrame, model: QualityModel | None, least_words: int = LEAST_WORDS, most_repeated: float = MOST_REPEATED, least_probability: float = LEAST_PROBABILITY) -> DataFrame:
    """The rows of docs, with all their columns, that judge() keeps: null and empty texts go, repeated rows stay or go
    together, an empty table gives no rows, and no column is added."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    hundredths = round(100 * most_repeated)

    @F.pandas_udf("boolean")
    def kept(texts: pd.Series) -> pd.Series:
        return pd.Series([_verdict((t or "").encode(), shared.value, least_words, hundredths, least_probability)[-1] for t in texts], dtype=bool)

    return docs.where(kept(F.col("text").cast("string")))


def judge(docs: DataFrame, model: QualityModel | None, least_words: int = LEAST_WORDS, most_repeated: float = MOST_REPEATED, least_probability: float = LEAST_PROBABILITY) -> DataFrame:
    """One row a document: the counts, base_failed, the model's probability of good quality, and kept.

    base_failed: fewer than least_words words, or more than most_repeated of them repeated. kept: not base_failed
    and a probability of least_probability or more; without a model only the counts decide and the probability is
    null. A null or empty text has no words and fails. Repeated rows are judged alike, an empty table gives no
    rows, other columns are not looked at.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    hundredths = round(100 * most_repeated)
    kinds = [pa.int64()] * 6 + [pa.bool_(), pa.float64(), pa.bool_()]
    names = [x.split()[0] for x in RESULT.split(", ")]

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            rows = []
            for k, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                text = (batch.column("text")[k].as_py() or "").encode()
                rows.append((doc_id, *_verdict(text, own, least_words, hundredths, least_probability)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return columns_of(docs).mapInArrow(judged, RESULT)
