from __future__ import annotations

import math

import numpy as np
import pyarrow as pa

from brindle.llm import embeddings


def brute(rows, threshold):
    def fine(v, label):
        return v is not None and label is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    ok = [(i, np.array(v, float), label) for i, v, label in rows if i is not None and fine(v, label)]
    links, root = {i: 0 for i, _, _ in rows}, {i: i for i, _, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for p, (a, x, lx) in enumerate(ok):
        for b, y, ly in ok[p + 1 :]:
            if lx == ly and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                links[a] += 1
                links[b] += 1
                p_, q_ = sorted((find(a), find(b)))
                root[q_] = p_
    return {i: (links[i], find(i)) for i, _, _ in rows}


def rows_for(seed, n=300, d=16):
    rng = np.random.default_rng(seed)
    rows, centers = [], rng.normal(size=(12, d))
    for i in range(n):
        v = centers[i % 12] + rng.normal(size=d) * rng.choice([0.05, 0.3, 0.5])
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(i % 12 // 4)))
    rows += [(n, rows[0][1], 0), (n + 1, rows[0][1], 0), (n + 2, None, 0), (n + 3, [0.0] * d, 0), (n + 4, [math.nan] + [1.0] * (d - 1), 0), (n + 5, [None] + [1.0] * (d - 1), 0), (n + 6, rows[0][1], None), (n + 7, [], 0), (n + 8, rows[0][1][:8], 0), (n + 9, [math.inf] + [1.0] * (d - 1), 0)]
    return rows


def test_brute_force_over_several_blocks(spark):
    rows = rows_for(1)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    for block in (2048, 20):
        got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(df, 0.93, block=block).collect()}
        assert got == brute(rows, 0.93)


def test_null_ids_and_empty(spark):
    schema = "vec_id long, embedding array<float>, label int"
    df = spark.createDataFrame([(None, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (1, [2.0, 0.0], 1)], schema)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_vectors(df).collect()}
    assert got == {None: (0, None, True), 2: (1, 1, False), 1: (1, 1, True)}
    assert embeddings.near_vectors(spark.createDataFrame([], schema)).count() == 0


def test_bounds_lose_no_pair():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(700, 24)) * np.exp(rng.normal(size=(700, 1)) * 5)
    y = np.concatenate([x[:300] + rng.normal(size=(300, 24)) * np.abs(x[:300]).mean(axis=1, keepdims=True) * 0.4, rng.normal(size=(300, 24))])
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    want = set(zip(*np.nonzero(unit(x) @ unit(y).T >= 0.9), strict=True))
    got = {(i, j) for a, b in embeddings.tile_links(x, y, 0.9) for i, j in zip(a, b, strict=True)}
    assert {(int(a), int(b)) for a, b in got} == {(int(a), int(b)) for a, b in want}


def test_one_id_with_several_vectors(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [1.0, 0.01], 0), (3, [1.0, 0.02], 0), (4, [0.01, 1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.near_vectors(df).collect())
    assert got == [(1, 1, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 1, 1, False)]


def test_very_large_and_very_small_vectors(spark):
    rows = [(1, [1e200, 0.0], 0), (2, [1e200, 1e190], 0), (3, [1e-200, 0.0], 0), (4, [0.0, 5e-324], 0), (5, [0.0, 1.7e308], 0), (6, [1e308, -1e308], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(df).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (1, 4), 5: (1, 4), 6: (0, 6)}


def test_vectors_go_only_to_tiles_in_which_they_may_link():
    rng = np.random.default_rng(4)
    v = rng.normal(size=(60, 64))
    v[40] = v[3] * 2 + 0.01
    codes = embeddings.quantised(v / np.linalg.norm(v, axis=1)[:, None])
    batch = pa.record_batch([pa.array([list(x) for x in v]), pa.array([64] * 60, pa.int32()), pa.array(range(60))], ["v", "dim", "h1"])
    coded = embeddings._code_batch(batch)
    assert coded.column("q").to_pylist() == [x.tobytes() for x in codes[0]]
    sides = pa.array([0] * 30 + [1] * 30, pa.int32())
    for high, own, want in ((1, sides, [3, 40]), (0, pa.array([0] * 60, pa.int32()), [3, 40])):
        table = pa.Table.from_batches([coded]).append_column("own", own)
        table = table.append_column("low", pa.array([0] * 60)).append_column("high", pa.array([high] * 60))
        assert embeddings._open(0.93, ["h1"])(table).column("h1").to_pylist() == want


def test_lengths_that_differ_within_a_batch():
    rows = [[1.0, 2.0], [3.0], [0.5, -1e300], [1e-310] * 5]
    batch = pa.record_batch([pa.array([len(r) for r in rows], pa.int32()), pa.array(rows)], ["dim", "v"])
    coded = embeddings._code_batch(batch).to_pydict()
    assert [np.frombuffer(q, np.int8).tolist() for q in coded["q"]] == [[64, 127], [127], [0, -127], [127] * 5]
    assert all(np.isfinite(coded[c]).all() for c in ("s", "a", "e"))
