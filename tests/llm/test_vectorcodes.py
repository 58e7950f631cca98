from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from brindle.llm import vectorcodes

VECTORS = "vec_id long, embedding array<double>, label int, error string, codes string"


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Plain Python integers throughout."""
    kept = [(i, v, label) for i, v, label, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    size = max((len(v) for _, v, _ in kept), default=0)
    width = -(-size // parts)
    clip = lambda x: max(-vectorcodes.MOST, min(vectorcodes.MOST, x))
    whole = [[clip(math.floor(scale * x)) if abs(x) < 1e300 else clip(int(x)) for x in v] + [0] * (width * parts - len(v)) for _, v, _ in kept]
    cut = [[w[p * width : (p + 1) * width] for p in range(parts)] for w in whole]
    order = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, kept[r][1]))[:entries]
    books = [[cut[r][p] for r in order] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda x, book: min((far(x, e), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            groups: dict[int, list] = {}
            for c in cut:
                groups.setdefault(near(c[p], books[p])[1], []).append(c[p])
            books[p] = [[sum(x) // len(groups[e]) for x in zip(*groups[e], strict=True)] if e in groups else books[p][e] for e in range(len(books[p]))]
    told = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    sums: dict = {}
    errors = [sum(d for d, _ in t) for t in told]
    for (_, _, label), e in zip(kept, errors, strict=True):
        sums[label] = sums.get(label, 0) + e
    most = vectorcodes.MOST_LONG
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    out = [(i, [c for _, c in t], min(e, most), min(sums[label], most)) for (i, _, label), t, e in zip(kept, told, errors, strict=True)]
    return sorted(out, key=repr), digest


def got(df, **how):
    vectors = vectorcodes.kept_vectors(df)
    books = vectorcodes.fit(vectors, **how)
    coded = vectorcodes.with_label_error(vectorcodes.encode(vectors, books))
    return sorted(((r.vec_id, list(r.codes), r.error, r.label_error) for r in coded.collect()), key=repr), books.digest()


def made(seed, n=200, size=16):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(20, size))
    rows = [(int(i), [float(x) for x in centers[i % 20] + rng.normal(size=size) * 0.2], None if i % 5 == 0 else int(i % 3)) for i in rng.permutation(n)]
    rows += [(3, rows[0][1], 1), (3, rows[1][1], 1), (None, rows[2][1], None), (n, None, 1), (n + 1, [math.nan] * size, 1), (n + 2, [None] + [1.0] * (size - 1), 1), (n + 3, [math.inf] + [0.0] * (size - 1), 1), (n + 4, [0.0] * size, 1)]
    return [(*r, "x", "y") for r in rows]


@pytest.mark.parametrize("more", [[], [(500, [0.5] * 11, 1, "", ""), (501, [], None, "", "")], [(500, [1e30] + [-3e9] * 15, 1, "", ""), (501, [20000.0] * 16, 2, "", "")]])
def test_brute_force(spark, more):
    rows = made(len(more)) + more
    assert got(spark.createDataFrame(rows, VECTORS).repartition(4)) == brute(rows)


def test_other_sizes_and_ties(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.integers(0, 3, 10)], i % 2, "", "") for i in range(120)]
    how = dict(parts=3, entries=64, rounds=3, scale=1)
    assert got(spark.createDataFrame(rows, VECTORS), **how) == brute(rows, **how)
    assert got(spark.createDataFrame(rows[:5], VECTORS)) == brute(rows[:5])


def test_no_vectors(spark):
    assert got(spark.createDataFrame([], VECTORS))[0] == []
    assert got(spark.createDataFrame([(1, None, 1, "", "")], VECTORS))[0] == []


def test_masks_give_the_entries_of_the_box_and_the_nearest():
    rng = np.random.default_rng(3)
    entries, x = rng.integers(-50, 50, (64, 5)), rng.integers(-60, 60, (2000, 5))
    s = vectorcodes.Slices(entries)
    radius = rng.integers(0, 60, 2000)
    inside = (np.abs(x[:, None] - entries) <= radius[:, None, None]).all(axis=2)
    assert np.array_equal(s.candidates(x, radius), (inside * (np.uint64(1) << np.arange(64, dtype=np.uint64))).sum(axis=1, dtype=np.uint64))
    far = ((x[:, None] - entries) ** 2).sum(axis=2)
    best, least = s.nearest(x)
    assert np.array_equal(best, far.argmin(axis=1)) and np.array_equal(least, far.min(axis=1))
    with pytest.raises(ValueError):
        vectorcodes.Slices(np.zeros((65, 2), int))


def test_decoded_vectors_lie_as_far_as_the_error_says(spark):
    rows = made(5)
    vectors = vectorcodes.kept_vectors(spark.createDataFrame(rows, VECTORS))
    books = vectorcodes.fit(vectors)
    out = vectorcodes.decode(vectorcodes.encode(vectors.withColumn("v", vectors.embedding), books), books).collect()
    for r in out:
        assert sum((math.floor(4096 * a) - round(4096 * b)) ** 2 for a, b in zip(r.v, r.vector, strict=True)) == r.error
