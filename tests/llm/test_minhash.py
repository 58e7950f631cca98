from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from brindle.llm import components, minhash


def shingles(text, n):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def brute(rows, n, percent):
    sets = [(i, shingles(t, n)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x in sets:
        for b, y in sets:
            if a < b and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: (len(s), find(i)) for i, s in sets}


def check(spark, docs, n, percent=80):
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None]
    expected = brute(rows, n, percent)
    for r in minhash.near_duplicates(docs, n, percent).collect():
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == expected[r.doc_id], r
            assert r.kept == (r.doc_id == r.component_id)


def test_brute_force(spark, docs):
    check(spark, docs, 4)
    check(spark, docs, 5)


def test_small_blocks_and_slices(spark, docs, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 3)
    monkeypatch.setattr(minhash, "STAR_ROWS", 2)
    monkeypatch.setattr(minhash, "TRIED", 1)
    check(spark, docs, 4)


def crowd(spark, size=60):
    """Copies of one text that are half alike, chains of close ones among them."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(size):
        copy = list(base)
        for at in rng.sample(range(120), rng.choice([1, 1, 2, 3])):
            copy[at] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_a_crowd_of_half_alike_copies(spark, monkeypatch):
    df = crowd(spark)
    check(spark, df, 4)
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 7)
    check(spark, df, 4, 85)


def test_tiles_do_not_grow_with_the_square_of_a_crowd(spark, monkeypatch):
    """A hot key's rows in tiles: those that share too little, and those in one large component, do not all meet."""
    made, real = [], minhash.by_tile
    rng, base = random.Random(12), [f"w{i}" for i in range(120)]

    def counted(df, tile, fn, schema):
        if "low" in tile and "wide" in df.columns and "shingles" not in df.columns:
            made.append((df.count(), df.select("key", "rep", "mark").distinct().count()))
        return real(df, tile, fn, schema)

    monkeypatch.setattr(minhash, "by_tile", counted)
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 6)
    rows = []
    for i in range(120):  # close copies, some far ones, and a few that are close to a far one alone
        copy = list(base)
        for at in rng.sample(range(120), 1 if i % 4 else 8):
            copy[at] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    rows += [(200 + i, f"y {rows[4 * i][1]}") for i in range(3)]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string"), 4)
    (tiles, classes), = made
    assert tiles <= 6 * classes, (tiles, classes)


def test_sketches_can_be_turned_off(spark):
    df = crowd(spark, 30)
    rows = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, 4, 80, sketch_bits=64, long_bits=1024).collect()}
    assert rows == {i: c for i, (_, c) in brute([(r.doc_id, r.text) for r in df.collect()], 4, 80).items()}


def test_columns_of_any_name_and_type(spark):
    rows = [(1, "a b c d e f", {"x": 1}), (1, "a b c d e f", {"x": 2}), (2, "a b c d e f", {}), (None, "q", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row map<string,int>").withColumn("_kept_id", F.lit(7)).withColumn("mark", F.lit("m"))
    out = minhash.dedup(df)
    assert out.dtypes == df.dtypes and sorted((r.doc_id or 0, r.mark) for r in out.collect()) == [(0, "m"), (1, "m")]


def test_null_ids_ties_and_empty(spark, docs, no_docs):
    extra = spark.createDataFrame([(None, "p q r s t u"), (None, None), (7001, "p q r s t u"), (7000, "P Q R S T U")], "doc_id long, text string")
    check(spark, docs.select("doc_id", "text").where("doc_id < 40").union(extra), 4)
    assert minhash.near_duplicates(no_docs).count() == 0
    assert minhash.dedup(no_docs).count() == 0


def test_rows_of_one_id_are_one_node(spark):
    a, b = " ".join("abcdefghijklmn"), " ".join("opqrstuvwxyz12")
    df = spark.createDataFrame([(5, a), (5, b), (1, a), (9, b)], "doc_id long, text string")
    assert {r.component_id for r in minhash.near_duplicates(df).collect()} == {1}
    assert [r.doc_id for r in minhash.dedup(df).collect()] == [1]


def test_dedup_keeps_one_of_each_group(spark, docs):
    kept = {r.doc_id for r in minhash.dedup(docs).collect()}
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], 5, 80)
    assert kept == {i for i, (_, c) in expected.items() if i == c}
    twice = minhash.dedup(docs.union(docs))
    assert twice.count() == len(kept) and twice.columns == docs.columns


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(10, 60)]
    star = [(100, i) for i in range(101, 400)] + [(5, 399)]
    found = components.connected_components(spark.createDataFrame([*path, *star, (3, 3), (None, 4), *path], "a long, b long"))
    got = {r.node: r.component for r in found.collect()}
    assert got == {i: 10 for i in range(11, 61)} | {i: 5 for i in range(100, 400)}


def test_signature_distance_of_similar_sets():
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(9, 300))
        both = rng.integers(0, 2**63, n).astype(np.uint64)
        extra = int(n // 8)
        x, y = np.unique(np.r_[both, rng.integers(0, 2**63, extra).astype(np.uint64)]), np.unique(np.r_[both, rng.integers(0, 2**63, extra).astype(np.uint64)])
        parts, sketch = minhash.signatures([x, y])
        keys = minhash.keys_of(parts)
        assert set(keys[0]) & set(keys[1])
        assert int(sketch[0] ^ sketch[1]).bit_count() <= minhash.SKETCH_BITS
        a, b = minhash.long_sketches([x, y])
        assert sum(int(w).bit_count() for w in a ^ b) <= minhash.LONG_BITS


def test_every_distance_up_to_the_threshold_shares_a_key():
    import numpy as np

    rng = np.random.default_rng(4)
    one = rng.integers(0, 2**16, minhash.CHUNKED).astype(np.uint16)
    for _ in range(300):
        other = one.copy()
        at = rng.permutation(minhash.CHUNKED)[: 2 * minhash.CHUNKS - 1]
        other[at] ^= np.uint16(1)
        a, b = minhash.keys_of(np.stack([one, other]))
        assert set(a) & set(b)
