"""Operator 13: product codes of vectors, their codebooks fitted by Yinyang Lloyd rounds in whole numbers.

Vectors become whole numbers and are cut into parts; each part has a codebook, and its code is the nearest entry's
place there. A round gives every part its nearest entry and every entry the mean of its parts, both exactly.

Yinyang: the entries of a codebook are clustered into groups. Of each part of each vector an upper bound of the distance
to its own entry is kept, and of each group a lower bound of the distance to all others there. Entries move by a known
drift, the bounds with them, and a round looks into those groups alone whose lower bound doesn't stay above the upper
one. Bounds are floats rounded outwards; whatever they leave open, ties above all, whole numbers decide.

A round is one pass over a Parquet table of vectors, codes and bounds, which writes the next one: each task adds what
its vectors bring to the sums of entries and what they take from others. Only those sums, a row an entry, are gathered.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.llm.common import bounded_batches, bounded_broadcast, removed, scratch_dir, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Entries of a group.
GROUP = 4
#: Whole numbers are held to this size; the contract's sums would not fit into 64 bits far below it.
LIMIT = 1 << 61
#: What bounds are rounded outwards by, as a share: far beyond the errors of a root and a sum.
SLACK = 1e-9
BROADCAST_LABELS = 100_000


def kept_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, x) of vectors without null or non-finite components; x is floor(SCALE * component)."""
    bounded_batches(rows.sparkSession)

    def sound(v: Column) -> Column:
        return v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))

    def whole(v: Column) -> Column:
        return F.floor(F.least(F.greatest(v.cast("double") * SCALE, F.lit(-float(LIMIT))), F.lit(float(LIMIT)))).cast("long")

    v = F.col(vector_col)
    return rows.where(v.isNotNull() & F.forall(v, sound)).select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.transform(v, whole).alias("x"))


@dataclass
class Codebooks:
    """entries: whole numbers of any size, [part][entry][component]. groups: places of entries, [part][group]."""

    entries: np.ndarray
    groups: list[list[np.ndarray]]

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(v) for v in self.entries.ravel().tolist()).encode()).hexdigest()


def grouped(entries: np.ndarray) -> list[np.ndarray]:
    """The places of a codebook's entries in groups of about GROUP, by a few rounds of clustering; empty groups go."""
    points = entries.astype(np.float64)
    k = max(1, len(points) // GROUP)
    centres = points[np.linspace(0, len(points) - 1, k).astype(int)]
    for _ in range(5):
        own = ((points[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.stack([points[own == g].mean(axis=0) if (own == g).any() else centres[g] for g in range(k)])
    return [np.flatnonzero(own == g) for g in range(k) if (own == g).any()]


def _numbers(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as 64-bit numbers where no squared distance can leave them, else as numbers of any size."""
    most = max((abs(int(f(a))) for a in (x, entries) if a.size for f in (np.min, np.max)), default=0)
    kind = np.int64 if x.shape[-1] * (2 * most) ** 2 < 1 << 63 else object
    return x.astype(kind), entries.astype(kind)


def _root(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


def _outward(value: np.ndarray, up: bool) -> np.ndarray:
    """As 32-bit floats, none of them on the wrong side."""
    with np.errstate(over="ignore"):
        return np.nextafter((value * (1 + SLACK if up else 1 - SLACK)).astype(np.float32), np.float32(np.inf if up else -np.inf))


def drifts(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """How far each entry of a codebook has moved, at least."""
    moved = after.astype(object) - before.astype(object)
    return _root((moved * moved).sum(axis=1)) * (1 + SLACK)


def assigned(x: np.ndarray, entries: np.ndarray, groups: list[np.ndarray], codes: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> int:
    """Brings codes and bounds of one part of some vectors up to date, in place; how many distances were computed.

    codes: -1 where none is known. upper: beyond the distance to the own entry; lower: [vector][group], short of the
    distances to a group's entries but the own one.
    """
    x, entries = _numbers(x, entries)
    open_ = np.flatnonzero((lower <= upper[:, None]).any(axis=1))
    if not len(open_):
        return 0
    p = x[open_]
    old = codes[open_]
    fresh = old < 0
    offset = p - entries[np.maximum(old, 0)]
    best = (offset * offset).sum(axis=1)
    first = best.copy()
    exact = np.where(fresh, np.inf, _root(best) * (1 + SLACK))
    best = np.where(fresh, np.iinfo(np.int64).max if best.dtype != object else 1 << 200, best)
    entry, looked = np.where(fresh, len(entries), old), lower[open_] <= exact[:, None]
    computed = int((~fresh).sum())
    seen = []
    for g, members in enumerate(groups):
        rows = np.flatnonzero(looked[:, g])
        apart = p[rows][:, None] - entries[members][None]
        d = (apart * apart).sum(axis=2)
        computed += d.size
        at = d.argmin(axis=1) if len(rows) else np.zeros(0, dtype=np.int64)
        least, which = d[np.arange(len(rows)), at], members[at]
        better = (least < best[rows]) | ((least == best[rows]) & (which < entry[rows]))
        best[rows[better]], entry[rows[better]] = least[better], which[better]
        seen.append((rows, members, d))
    bounds = lower[open_]
    for g, (rows, members, d) in enumerate(seen):
        distance = _root(d)
        distance[members[None] == entry[rows][:, None]] = np.inf
        bounds[rows, g] = distance.min(axis=1, initial=np.inf) * (1 - SLACK)
        left = np.flatnonzero(~looked[:, g] & ~fresh & (entry != old) & np.isin(old, members))
        bounds[left, g] = np.minimum(bounds[left, g], _root(first[left]) * (1 - SLACK))
    codes[open_], upper[open_], lower[open_] = entry, _root(best) * (1 + SLACK), bounds
    return computed


def sums_of(x: np.ndarray, codes: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """(componentwise sums, counts) of the vectors of each entry."""
    kind = np.int64 if not x.size or max(abs(int(x.min())), abs(int(x.max()))) * len(x) < 1 << 62 else object
    total = np.zeros((entries, x.shape[1]), dtype=kind)
    np.add.at(total, codes, x.astype(kind))
    return total.astype(object), np.bincount(codes, minlength=entries)


class _State:
    """Codes and bounds of a batch's vectors: [vector][part], and [part][vector] with a number a group."""

    def __init__(self, batch: pa.RecordBatch, books: Codebooks, drift: list[np.ndarray] | None):
        n, parts = batch.num_rows, len(books.entries)
        self.codes = np.full((n, parts), -1, dtype=np.int64)
        sizes = [1 + len(g) for g in books.groups]
        if drift is None:
            self.bounds = [np.concatenate([np.full((n, 1), np.inf), np.full((n, s - 1), -np.inf)], axis=1) for s in sizes]
            return
        self.codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(n, parts).astype(np.int64)
        whole = np.frombuffer(b"".join(batch.column("bounds").to_pylist()), "<f4").reshape(n, sum(sizes)).astype(np.float64)
        self.bounds = np.split(whole, np.cumsum(sizes)[:-1], axis=1)
        for p, bound in enumerate(self.bounds):
            bound[:, 0] += drift[p][self.codes[:, p]]
            bound[:, 1:] -= np.array([drift[p][members].max() for members in books.groups[p]])[None]

    def columns(self) -> tuple[pa.Array, pa.Array]:
        whole = np.concatenate([np.concatenate([_outward(b[:, :1], True), np.where(b[:, 1:] > 0, _outward(b[:, 1:], False), np.float32(-1))], axis=1) for b in self.bounds], axis=1).astype("<f4")
        return pa.array([r.tobytes() for r in self.codes.astype(np.uint8)], pa.binary()), pa.array([r.tobytes() for r in whole], pa.binary())


def _cut(batch: pa.RecordBatch, parts: int) -> np.ndarray:
    """[vector][part][component]"""
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return x.reshape(batch.num_rows, parts, -1)


_ROUND = "vec_id long, label string, x array<long>, codes binary, bounds binary, part int, entry int, sums array<decimal(38,0)>, n long, computed long"


def lloyd_round(books: Codebooks, drift: list[np.ndarray] | None):
    """Vectors with codes and bounds after a round; at a task's end, what it changes of each entry's sums and count."""
    parts, entries = books.entries.shape[:2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, computed = np.zeros(books.entries.shape, dtype=object), np.zeros((parts, entries), dtype=np.int64), 0
        for batch in batches:
            for low in range(0, batch.num_rows, 4000):
                own = batch.slice(low, 4000)
                state, x = _State(own, books, drift), _cut(own, parts)
                before = state.codes.copy()
                for p in range(parts):
                    computed += assigned(x[:, p], books.entries[p], books.groups[p], state.codes[:, p], state.bounds[p][:, 0], state.bounds[p][:, 1:])
                    moved = state.codes[:, p] != before[:, p]
                    for codes, sign in ((state.codes[moved, p], 1), (before[moved, p], -1)):
                        known = codes >= 0
                        s, c = sums_of(x[moved, p][known], codes[known], entries)
                        sums[p] += sign * s
                        counts[p] += sign * c
                codes, bounds = state.columns()
                none = [pa.nulls(own.num_rows, t) for t in (pa.int32(), pa.int32(), pa.list_(pa.decimal128(38, 0)), pa.int64(), pa.int64())]
                yield pa.RecordBatch.from_arrays([*[own.column(c) for c in ("vec_id", "label", "x")], codes, bounds, *none], names=names)
        changed = [(p, e) for p in range(parts) for e in range(entries) if counts[p, e] or any(sums[p, e])]
        kinds = (pa.int64(), pa.string(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.list_(pa.decimal128(38, 0)), pa.int64(), pa.int64())
        rows = [(None, None, None, None, None, p, e, [_decimal(v) for v in sums[p, e]], int(counts[p, e]), 0) for p, e in changed]
        rows.append((None, None, None, None, None, -1, -1, [], 0, computed))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    names = [c.split()[0] for c in _ROUND.split(", ")]
    return run


def _decimal(value: int):
    from decimal import Context, Decimal

    return Context(prec=60).create_decimal(Decimal(int(value)))


def coded(books: Codebooks, drift: list[np.ndarray] | None):
    """(vec_id, label, code, error) of vectors that have codes and bounds."""
    parts = len(books.entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 4000):
                own = batch.slice(low, 4000)
                state, x = _State(own, books, drift), _cut(own, parts)
                error = np.zeros(own.num_rows, dtype=object)
                for p in range(parts):
                    assigned(x[:, p], books.entries[p], books.groups[p], state.codes[:, p], state.bounds[p][:, 0], state.bounds[p][:, 1:])
                    a, b = _numbers(x[:, p], books.entries[p])
                    apart = a - b[state.codes[:, p]]
                    error += (apart * apart).sum(axis=1).astype(object)
                codes = [r.tobytes().hex() for r in state.codes.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays([own.column("vec_id"), own.column("label"), pa.array(codes), pa.array([min(int(e), (1 << 63) - 1) for e in error], pa.int64())], names=["vec_id", "label", "code", "error"])

    return run


@dataclass
class Fit:
    """books: the codebooks after all rounds; drift: what the last round moved. table: vectors with their codes and bounds
    before that. computed: distances of each round."""

    books: Codebooks
    drift: list[np.ndarray] | None
    table: DataFrame
    computed: list[int]


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Fit | None:
    """Codebooks of vectors (vec_id, label, x), all of one length; None without vectors."""
    spark = vectors.sparkSession
    first = [r.x for r in vectors.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()]
    if not first:
        return None
    start = np.array(first, dtype=object).reshape(len(first), parts, -1).transpose(1, 0, 2)
    books, drift = Codebooks(start, [grouped(e) for e in start]), None
    sums, counts = np.zeros(start.shape, dtype=object), np.zeros(start.shape[:2], dtype=object)
    folder = f"{scratch_dir(spark)}/vectors-{uuid.uuid4().hex}"
    table, computed, own = vectors, [], ""
    for k in range(rounds):
        path = f"{folder}/round={k}"
        table.mapInArrow(lloyd_round(books, drift), _ROUND).write.parquet(path)
        whole = spark.read.schema(_ROUND).parquet(path)
        told = whole.where("part is not null")
        totals = told.where("part >= 0").select("part", "entry", "n", F.posexplode("sums").alias("at", "s")).groupBy("part", "entry", "at").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        for r in totals.collect():  # a number a component of each entry
            sums[r.part, r.entry, r.at] += int(r.s)
            counts[r.part, r.entry] += r.n if r.at == 0 else 0
        computed.append(told.agg(F.sum("computed")).head()[0] or 0)
        after = books.entries.copy()
        for p, e in zip(*np.nonzero(counts > 0), strict=True):
            after[p, e] = [int(s) // int(counts[p, e]) for s in sums[p, e]]
        drift = [drifts(a, b) for a, b in zip(books.entries, after, strict=True)]
        books = Codebooks(after, books.groups)
        table = whole.where("part is null").select("vec_id", "label", "x", "codes", "bounds")
        if own:
            removed(spark, own)  # nothing reads the round before any more
        own = path
    return Fit(books, drift, table, computed)


def product_codes(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """One row a kept vector: vec_id, code, error, label_error and codebooks_sha256.

    A vector that is null, or has null or non-finite components, is dropped; so is one whose length isn't that of the
    first kept vector, or can't be cut into equal parts. The first are those of the least vec_ids, then of the least
    components where vec_ids are equal, null vec_ids last; with fewer vectors than entries, codebooks are smaller. Equal
    rows count each. Whole numbers and sums of errors beyond 64 bits stay at its bounds. An empty table gives no rows;
    other columns are not looked at.
    """
    vectors = kept_vectors(rows).withColumn("label", F.col("label").cast("string"))
    vectors = vectors.where((F.size("x") > 0) & (F.size("x") % parts == 0))
    head = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "x").select(F.size("x").alias("n")).head()
    done = fit(written(vectors.where(F.size("x") == head.n), "vectors"), parts, entries, rounds) if head else None
    if done is None:
        return rows.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    own = written(done.table.mapInArrow(coded(done.books, done.drift), "vec_id long, label string, code string, error long"), "codes")
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    totals = own.groupBy(F.col("label").alias("_label")).agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), most).cast("long").alias("label_error"))
    joined = own.join(bounded_broadcast(totals, BROADCAST_LABELS), F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(done.books.digest()).alias("codebooks_sha256"))
