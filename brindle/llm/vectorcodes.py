"""Vector code compression: vectors become a few codes, each the nearest of up to 64 entries of a part's codebook.

Vectors are whole numbers after scaling, so every sum is exact and every run gives the same codebooks. A part's nearest
entry is found by slices of its codebook: per dimension the entries' coordinates are sorted, and the mask of the first
``i`` of them is kept for each ``i``. The distance to a first guess is a radius that the nearest entry cannot exceed; per
dimension it selects a range of the sorted coordinates, whose entries are one exclusive-or of two masks. The masks of all
dimensions, ANDed, leave the entries in the box around the vector, and only these are compared.

Each round of fitting is one pass over the vectors in parallel; a task sends sums and counts of its entries, so what is
shuffled and what goes to the driver is a codebook's size, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.llm.common import join_by_slices, packed

#: Scaled components beyond this count as this; so do errors and their sums beyond a long's range as its end.
MOST = 1 << 40
MOST_LONG = (1 << 63) - 1
#: Components below this keep squared distances of 2048 dimensions within 64 bits; others are computed as Python integers.
PLAIN = 1 << 25
ROWS = 1 << 15
U = np.uint64
_root = np.frompyfunc(math.isqrt, 1, 1)


@dataclass(frozen=True)
class Codebooks:
    """``entries[p]`` holds the entries of part ``p``, a row each; ``scale`` is what components were multiplied by."""

    entries: list[np.ndarray]
    scale: int

    @property
    def width(self) -> int:
        return self.entries[0].shape[1] if self.entries else 0

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position."""
        return hashlib.sha256(",".join(str(int(x)) for e in self.entries for x in e.ravel()).encode()).hexdigest()


class Slices:
    """One part's codebook, sorted by each dimension, with the masks of its first entries."""

    def __init__(self, entries: np.ndarray):
        if len(entries) > 64:
            raise ValueError("a mask holds 64 entries")
        self.entries, self.sorted, self.masks = entries, [], []
        for column in entries.T:
            order = np.argsort(column, kind="stable")
            bits = U(1) << order.astype(U)
            self.sorted.append(column[order])
            self.masks.append(np.concatenate([np.zeros(1, U), np.bitwise_or.accumulate(bits)]))

    def candidates(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries that differ from ``x`` by at most ``radius`` in every dimension."""
        found = np.full(len(x), ~U(0))
        for column, edge, masks in zip(x.T, self.sorted, self.masks, strict=True):
            found &= masks[np.searchsorted(edge, column + radius, "right")] ^ masks[np.searchsorted(edge, column - radius, "left")]
        return found

    def guess(self, x: np.ndarray) -> np.ndarray:
        """An entry that is near in the dimension in which entries lie furthest apart."""
        if not x.shape[1]:
            return np.zeros(len(x), np.int64)
        d = int(np.argmax([edge[-1] - edge[0] for edge in self.sorted]))
        order = np.argsort(self.entries[:, d], kind="stable")
        return order[np.minimum(np.searchsorted(self.sorted[d], x[:, d]), len(order) - 1)]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each row of ``x``, the first of several, and its squared distance."""
        first = self.guess(x)
        best, least = first.copy(), distance(x, self.entries[first])
        left = self.candidates(x, roots(least))
        for e in range(len(self.entries)):
            at = np.flatnonzero((left >> U(e)) & U(1))
            far = distance(x[at], self.entries[e])
            nearer = (far < least[at]) | ((far == least[at]) & (e < best[at]))
            best[at[nearer]], least[at[nearer]] = e, far[nearer]
        return best, least


def distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = x - y
    return (d * d).sum(axis=1) if d.shape[1] else np.zeros(len(d), d.dtype)


def roots(squares: np.ndarray) -> np.ndarray:
    """Whole square roots, rounded up or down by less than one, never too small for a difference of whole numbers."""
    if squares.dtype == object:
        return _root(squares)
    r = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    return r + (np.square(r + 1) <= squares)


def whole(vectors: pa.Array, scale: int, width: int) -> np.ndarray:
    """Vectors as rows of ``floor(scale * x)``, followed by zeros up to ``width``; 64-bit integers where they suffice."""
    size, flat = vectors.value_lengths().to_numpy(zero_copy_only=False), vectors.flatten().to_numpy(zero_copy_only=False)
    rows = np.zeros((len(vectors), width))
    at = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    rows[np.repeat(np.arange(len(vectors)), size), at] = flat
    with np.errstate(over="ignore"):
        x = np.clip(np.floor(rows * scale), -MOST, MOST).astype(np.int64)
    return x.astype(object) if x.size and np.abs(x).max() >= PLAIN else x


def _parts(x: np.ndarray, books: Codebooks) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Part, its columns and codebook, of one kind of numbers."""
    for p, entries in enumerate(books.entries):
        part = x[:, p * books.width : (p + 1) * books.width]
        if part.dtype != object and entries.size and np.abs(entries).max() >= PLAIN:
            part = part.astype(object)
        yield p, part, entries.astype(object) if part.dtype == object else entries.astype(np.int64)


def _batches(batch: pa.RecordBatch, books: Codebooks, column: str) -> Iterator[tuple[int, np.ndarray]]:
    total = books.width * len(books.entries)
    for i in range(0, batch.num_rows, ROWS):
        yield i, whole(batch.column(column).slice(i, ROWS), books.scale, total)


def kept_vectors(vectors: DataFrame, embedding: str = "embedding") -> DataFrame:
    """Rows whose vector is not null and holds finite components alone."""
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
    return vectors.where(F.col(embedding).isNotNull() & F.coalesce(F.forall(embedding, fine), F.lit(False)))


def first_codebooks(vectors: DataFrame, parts: int = 8, entries: int = 16, scale: int = 4096, id: str = "vec_id", embedding: str = "embedding") -> Codebooks:
    """Codebooks of the parts of the vectors with the smallest ids (null last; those of one id by their components)."""
    size = vectors.agg(F.coalesce(F.max(F.size(embedding)), F.lit(0))).first()[0]
    chosen = vectors.select(id, embedding).orderBy(F.asc_nulls_last(id), embedding).limit(entries).collect()
    width = -(-size // parts)
    x = whole(pa.array([r[1] for r in chosen], pa.list_(pa.float64())), scale, width * parts)
    return Codebooks([x[:, p * width : (p + 1) * width] for p in range(parts)], scale)


def improved(vectors: DataFrame, books: Codebooks, embedding: str = "embedding") -> Codebooks:
    """Each entry replaced by the mean, rounded down, of the parts nearest to it; an unused one stays."""
    parts, entries, width = len(books.entries), len(books.entries[0]), books.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of a task's parts by entry and position, and at position -1 their number."""
        sums, counts = np.zeros((parts, entries, width), object), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for _, x in _batches(batch, books, "v"):
                for p, part, book in _parts(x, books):
                    near, _ = Slices(book).nearest(part)
                    counts[p] += np.bincount(near, minlength=entries)
                    order = np.argsort(near, kind="stable")
                    used, start = np.unique(near[order], return_index=True)
                    if width and len(used):
                        sums[p, used] += np.add.reduceat(part[order], start, axis=0)
        at = [(p, e, j) for p in range(parts) for e in np.flatnonzero(counts[p]) for j in range(-1, width)]
        value = [Decimal(int(counts[p, e] if j < 0 else sums[p, e, j])) for p, e, j in at]
        columns = [pa.array([int(a[i]) for a in at], pa.int32()) for i in range(3)]
        yield pa.record_batch([*columns, pa.array(value, pa.decimal128(38, 0))], ["part", "entry", "at", "value"])

    told = vectors.select(F.col(embedding).alias("v")).mapInArrow(run, "part int, entry int, at int, value decimal(38,0)")
    total = {(r.part, r.entry, r["at"]): int(r.value) for r in told.groupBy("part", "entry", "at").agg(F.sum("value").cast("decimal(38,0)").alias("value")).collect()}
    new = [e.copy() for e in books.entries]
    for (p, e, j), value in total.items():
        if j >= 0:
            new[p][e, j] = value // total[p, e, -1]
    return Codebooks(new, books.scale)


def fit(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, id: str = "vec_id", embedding: str = "embedding") -> Codebooks:
    """Codebooks after ``rounds`` rounds over all kept vectors (``kept_vectors``); without any they have no entries.

    Shorter vectors count as if zeros followed, up to the longest one's length and that up to a multiple of ``parts``.
    With fewer vectors than ``entries`` there are as many entries as vectors.
    """
    books = first_codebooks(vectors, parts, entries, scale, id, embedding)
    for _ in range(rounds if len(books.entries[0]) else 0):
        books = improved(vectors, books, embedding)
    return books


def encode(vectors: DataFrame, books: Codebooks, embedding: str = "embedding") -> DataFrame:
    """Rows with ``codes`` (array<int>, an entry for each part) and ``error``, the squared distance to what they stand for;
    the vector goes, and columns with these names are replaced. ``vectors`` are kept ones (``kept_vectors``), none longer
    than those of which ``books`` are made."""
    row = packed(vectors, embedding, "codes", "error")
    own = [c for c in vectors.columns if c not in (embedding, "codes", "error")]
    rows = vectors.select(F.col(embedding).alias("v"), row.alias("row"))
    schema = T.StructType([rows.schema["row"], T.StructField("codes", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, x in _batches(batch, books, "v"):
                codes, error = np.zeros((len(x), len(books.entries)), np.int32), np.zeros(len(x), object)
                for p, part, book in _parts(x, books):
                    codes[:, p], far = Slices(book).nearest(part)
                    error += far
                codes = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * codes.shape[1], pa.int32()), pa.array(codes.ravel()))
                yield pa.record_batch([batch.column("row").slice(i, len(x)), codes, pa.array([min(int(e), MOST_LONG) for e in error], pa.int64())], ["row", "codes", "error"])

    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col("row")[c].alias(c) for c in own], "codes", "error")


def decode(codes: DataFrame, books: Codebooks, column: str = "codes") -> DataFrame:
    """Rows with ``vector`` (array<double>), what their codes stand for: exact components of the entries over the scale."""
    book = F.array(*[F.array(*[F.array(*[F.lit(float(x) / books.scale) for x in e]) for e in part]) for part in books.entries])
    whole_vector = F.flatten(F.transform(F.col(column), lambda code, part: F.get(F.get(book, part), code)))
    return codes.withColumn("vector", whole_vector)


def with_label_error(coded: DataFrame, label: str = "label", id: str = "vec_id") -> DataFrame:
    """``label_error``: the errors summed over rows of an equal label, those without one together."""
    key = {"_none": F.col(label).isNull(), "_label": F.coalesce(F.col(label).cast("string"), F.lit(""))}
    coded = coded.withColumns(key)
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST_LONG).cast("decimal(38,0)")).cast("long")
    return join_by_slices(coded, coded.groupBy(*key).agg(total.alias("label_error")), list(key), id).drop(*key)
