"""Quality rules: counted features with fixed limits, and a logistic regression over hashed n-grams.

The regression reads hashed words, pairs of words and four characters in a row, each as a share of its document. It is
fitted on a bounded sample of labelled rows (``Training.rows``, ``Training.chars``) in one task, calibrated by Platt's
method on held-out rows, and then scores every document in Arrow batches against a fixed probability. The model is two
arrays of ``2**BITS`` numbers, 2 MB, whatever the input. Nothing but the labelled sample leaves its task.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.llm import textkernel as k
from brindle.llm.common import replace_columns, slices, utf8, with_fields

BITS = 18
#: A document goes below this many words, or if more than this percentage of its words stand in repeated windows.
LEAST_WORDS, MOST_REPEATED = 50, 50
WINDOW = 3
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
STARTS_CHARACTER = (np.arange(256) & 0xC0) != 0x80
WHITE_BYTES = bytes(np.flatnonzero(k.WHITE).tolist())
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


MOST_SHARE = 64


@dataclass(frozen=True)
class Training:
    """How the regression is fitted; ``rows`` and ``chars`` (of all their texts) bound the labelled sample.

    Good and bad rows have one half of ``chars`` each, and a text of more than a ``MOST_SHARE``-th of ``chars`` fits nothing, so
    no long text takes the place of all others.
    """

    rows: int = 3000
    chars: int = 32_000_000
    epochs: int = 12
    rate: float = 1.0
    held_out: int = 5
    threshold: float = 0.5


@dataclass(frozen=True)
class Model:
    words: np.ndarray
    grams: np.ndarray
    bias: float
    #: Platt's line from the raw score to log odds.
    slope: float
    offset: float


def _sums(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[end] - total[start]


class Batch:
    """Documents as bytes, with what both the features and the regression need."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self.buf, self.at = k.join(texts)
        self.start, self.end = self.at[:-1], self.at[1:] - 1
        w0, w1 = k.words(self.buf)
        self.first = np.searchsorted(w0, self.at)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.hash = k.Substrings(self.buf).hashes(w0, w1)

    def features(self) -> dict[str, np.ndarray]:
        n = np.diff(self.first)
        key, at = k.windows(self.hash, self.doc, WINDOW)
        key = key ^ k.mix(self.doc[at].astype(k.U) + k.U(1))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(self.hash), bool)
        twice[at[order[1:][same]]] = True
        twice[at[order[:-1][same]]] = True
        inside = twice.copy()
        for i in range(1, WINDOW):
            inside[i:] |= twice[:-i]
        dark = STARTS_CHARACTER[self.buf] & ~k.WHITE[self.buf]
        return {
            "n_words": n,
            "word_chars": _sums(dark, self.start, self.end),
            "n_symbols": _sums(SYMBOLS[self.buf], self.start, self.end),
            "n_dup_lines": np.array([repeated_lines(t) for t in self.texts], np.int64),
            "n_repeat_words": np.bincount(self.doc[inside], minlength=len(self.texts)),
        }

    def slots(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of words, pairs of words and four characters in a row: slots, and each document's range of them."""
        words, first, last = self.hash, self.first[:-1], self.first[1:]
        pairs = k.mix(words[:-1] * k.U(k.BASE) + words[1:])
        points = np.frombuffer(self.buf.tobytes().decode().encode("utf-32-le"), np.uint32)
        grams = points[:-3].astype(k.U)
        for i in range(1, 4):
            grams *= k.U(k.BASE)
            grams += points[i : len(points) - 3 + i]
        before = np.concatenate([[0], np.cumsum(STARTS_CHARACTER[self.buf])])
        start, end = before[self.start], before[self.end]
        slot = lambda h: (h >> k.U(64 - BITS)).astype(np.int64)
        return [(slot(words), first, last), (slot(pairs), first, np.maximum(last - 1, first)), (slot(k.mix(grams)), start, np.maximum(end - 3, start))]

    def raw(self, model: Model) -> np.ndarray:
        """Scores before calibration."""
        score = np.full(len(self.texts), model.bias)
        for weights, (slots, a, z) in zip((model.words, model.words, model.grams), self.slots(), strict=True):
            if len(slots):
                score += _sums(weights[slots], a, z) / np.maximum(z - a, 1)
        return score


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(WHITE_BYTES)]
    return len(lines) - len(set(lines))


def sample(docs: DataFrame, labels: DataFrame, how: Training, id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """``y``, ``text`` of the labelled rows that fit the regression, in order and in one partition: at most ``how.rows``
    rows of at most ``how.chars`` characters (see ``Training``), those of the smallest hashed ids.

    Null ids and labels are left out, an id's labels count as their least and of its texts one is read (the least by hash).
    """
    order = F.xxhash64(F.col(id))
    known = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull()).groupBy(id).agg(F.min(label).alias("y")).withColumn("order", order)
    chosen = known.orderBy("order", id).limit(how.rows)
    rows = docs.select(F.col(id), F.col(text).alias("text")).join(F.broadcast(chosen), id)
    rows = rows.groupBy("order", id, "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    size = F.coalesce(F.length("text"), F.lit(0))
    so_far = F.sum("size").over(Window.partitionBy(F.col("y") > 0).orderBy("order", id))  # of how.rows rows at most
    rows = rows.withColumn("size", size).where(F.col("size") <= how.chars // MOST_SHARE).withColumn("so_far", so_far).where(F.col("so_far") <= how.chars // 2)
    return rows.coalesce(1).sortWithinPartitions("order", id).select(F.col("y").cast("double").alias("y"), "text")


def _fitted(how: Training):
    """The model of all rows of a partition, as one row; none with fewer than two classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y, at, share = [], [], []
        for batch in batches:
            y += [float(v > 0) for v in batch.column("y").to_pylist()]
            for text in utf8(batch.column("text")):
                parts = [(np.unique(part[a[0] : z[0]], return_counts=True), max(z[0] - a[0], 1)) for part, a, z in Batch([text]).slots()]
                at.append(np.concatenate([slots + shift for ((slots, _), _), shift in zip(parts, (0, 0, 1 << BITS), strict=True)]).astype(np.int32))
                share.append(np.concatenate([n / size for (_, n), size in parts]).astype(np.float32))
        if len(set(y)) == 2:
            m = fit(at, share, np.array(y), how)
            yield pa.RecordBatch.from_pylist([{"words": m.words.tobytes(), "grams": m.grams.tobytes(), "bias": m.bias, "slope": m.slope, "shift": m.offset}])

    return run


def train(docs: DataFrame, labels: DataFrame, how: Training = Training(), id: str = "doc_id", text: str = "text", label: str = "quality") -> Model | None:
    """Fit and calibrate on ``sample``, in one task; the model alone, 2 MB, goes to the driver.

    With fewer than two classes among the sample, there is no model, and a warning is logged. Null texts are empty ones,
    long ones are left out (``Training``), and empty tables give no model.
    """
    got = sample(docs, labels, how, id, text, label).mapInArrow(_fitted(how), "words binary, grams binary, bias double, slope double, shift double").first()
    if got is None:
        logging.getLogger(__name__).warning("the labelled sample does not hold both good and bad rows: no regression is fitted")
    return got and Model(np.frombuffer(got.words, np.float32), np.frombuffer(got.grams, np.float32), got.bias, got.slope, got.shift)


def fit(at: list[np.ndarray], share: list[np.ndarray], y: np.ndarray, how: Training) -> Model:
    """Adagrad over small groups of rows in a fixed order; every ``how.held_out``-th row calibrates."""
    held = np.arange(len(y)) % how.held_out == 0
    weights, seen = np.zeros(2 << BITS), np.full(2 << BITS, 1e-8)
    bias, rng = 0.0, np.random.default_rng(7)
    even = np.where(y > 0, 0.5 / max(y[~held].mean(), 1e-9), 0.5 / max(1 - y[~held].mean(), 1e-9))
    for _ in range(how.epochs):
        for part in np.array_split(rng.permutation(np.flatnonzero(~held)), max(1, int((~held).sum()) // 16)):
            if not len(part):
                continue
            slots, values = np.concatenate([at[i] for i in part]), np.concatenate([share[i] for i in part])
            row = np.repeat(np.arange(len(part)), [len(at[i]) for i in part])
            score = np.bincount(row, weights[slots] * values, minlength=len(part)) + bias
            error = (1 / (1 + np.exp(-score)) - y[part]) * even[part] / len(part)
            touched, where = np.unique(slots, return_inverse=True)
            slope = np.bincount(where, error[row] * values)
            seen[touched] += slope**2
            weights[touched] -= how.rate * slope / np.sqrt(seen[touched])
            bias -= 0.05 * error.sum()
    raw = np.array([weights[at[i]] @ share[i] for i in np.flatnonzero(held)]) + bias
    slope, offset = platt(raw, y[held])
    return Model(weights[: 1 << BITS].astype(np.float32), weights[1 << BITS :].astype(np.float32), float(bias), slope, offset)


def platt(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """The line from raw scores to log odds, by Newton's method on Platt's smoothed targets."""
    good, bad = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([raw, np.ones(len(raw))])
    line = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(line @ x, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2), x @ (p - target))
        line = line - step
        if np.abs(step).max() < 1e-9:
            break
    return (float(line[0]), float(line[1])) if line[0] > 0 else (1.0, 0.0)


def judge(df: DataFrame, model: Model | None, threshold: float = Training.threshold, text: str = "text") -> DataFrame:
    """Every row of ``df`` with the five features, ``quality`` (the calibrated probability), ``base_failed``, ``kept``.

    Null and empty texts have no words and fail the base rules. Without a model ``quality`` is null and the base rules
    decide alone. Whole texts are read; repeated rows repeat; input columns with these names are replaced; an empty table
    gives an empty one.
    """
    names = {**{f: T.LongType() for f in FEATURES}, "quality": T.DoubleType(), "base_failed": T.BooleanType(), "kept": T.BooleanType()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(batch.schema.get_field_index(text)))
            parts = []
            for i, j in slices([len(t) for t in texts]):
                b = Batch(texts[i:j])
                x = b.features()
                x["raw"] = b.raw(model) if model else np.zeros(j - i)
                parts.append(x)
            x = {n: np.concatenate([p[n] for p in parts]) for n in (*FEATURES, "raw")} if parts else {n: np.zeros(0) for n in (*FEATURES, "raw")}
            failed = (x["n_words"] < LEAST_WORDS) | (100 * x["n_repeat_words"] > MOST_REPEATED * x["n_words"])
            if model:
                odds = np.clip(model.slope * x.pop("raw") + model.offset, -30, 30)
                quality = 1 / (1 + np.exp(-odds))
                kept, quality = ~failed & (quality >= threshold), pa.array(quality, pa.float64())
            else:
                kept, quality = ~failed, pa.nulls(len(failed), pa.float64())
            columns = {f: pa.array(x[f], pa.int64()) for f in FEATURES}
            yield replace_columns(batch, **columns, quality=quality, base_failed=pa.array(failed), kept=pa.array(kept))

    return df.mapInArrow(run, with_fields(df.schema, **names))
