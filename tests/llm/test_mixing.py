from __future__ import annotations

import re

import numpy as np
from pyspark.sql import functions as F

from brindle.llm import mixing


def expected_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, list(order), share * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = [s for s in open_ if weight[s] * level > most * sizes[s]]
        if not above:
            return target | {s: weight[s] * level for s in open_}
        for s in above:
            target[s] = most * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


def test_targets_and_taken(spark, docs):
    out = mixing.mix(docs).collect()
    source = {r.doc_id: r.source for r in docs.collect()}
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs.collect()}
    sizes = {}
    for i, s in source.items():
        sizes[s] = sizes.get(s, 0) + size[i]
    want, taken, largest = expected_targets(sizes), {}, {}
    assert sorted(r.doc_id for r in out) == sorted(source)
    for r in out:
        s = source[r.doc_id]
        assert r.size == size[r.doc_id] and r.source_size == sizes[s]
        assert abs(r.target - want[s]) < 1e-6 * max(1, want[s])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[s], largest[s] = taken.get(s, 0) + r.taken, max(largest.get(s, 0), r.size)
    for s, t in want.items():
        assert abs(taken[s] - t) <= largest[s]


def test_reruns_agree(spark, docs):
    a = sorted(map(tuple, mixing.mix(docs).collect()))
    assert a == sorted(map(tuple, mixing.mix(docs.repartition(11)).collect()))
    assert a != sorted(map(tuple, mixing.mix(docs, seed=1).collect()))


def test_tree_of_several_levels(spark, docs, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF_ROWS", 5)
    monkeypatch.setattr(mixing, "FAN_IN", 2)
    test_targets_and_taken(spark, docs)


def test_expectations_hold():
    rng = np.random.default_rng(1)
    sizes, part = np.array([10, 20, 5, 40, 7]), np.array([0.3, 0.9, 0.5, 0.2, 0.6])
    total = np.zeros(5)
    for _ in range(4000):
        out, held = mixing.pivotal(sizes, part, rng.random(5))
        assert abs((out * sizes).sum() - (part * sizes).sum()) < 1e-9
        assert sum(0 < x < 1 for x in out) <= 1 and (held < 0 or 0 < out[held] < 1)
        total += out
    assert np.abs(total / 4000 - part).max() < 0.03


def test_applied_mix(spark, docs, no_docs):
    counts = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    out = mixing.apply(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == {i: n for i, n in counts.items() if n}
    assert mixing.mix(no_docs).count() == 0 and mixing.apply(no_docs).count() == 0


def test_null_is_not_a_word(spark):
    rows = [(None, "a b c", "x"), ("null", "d e f g", "x"), ("1", "h", None), ("2", "i j", "null")]
    df = spark.createDataFrame(rows, "doc_id string, text string, source string")
    assert sorted((r.doc_id or "", r.size) for r in mixing.mix(df).collect()) == [("", 3), ("1", 1), ("2", 2), ("null", 4)]
    copies = {r.doc_id: r.copies for r in mixing.mix(df).collect()}
    assert {i: sum(r.doc_id == i for r in mixing.apply(df).collect()) for i in copies} == copies


def test_columns_of_any_name(spark, docs):
    df = docs.select("doc_id", "text", "source", *[F.lit(c).alias(c) for c in ("copies", "_copy", "_dn", "_i", "_row", "_taken_i", "_k", "a.b")])
    out = mixing.apply(df)
    assert out.columns == df.columns and out.count() == mixing.apply(docs).count()
    assert [tuple(r) for r in out.select("copies", "_copy", "_dn", "_i", "_row", "`a.b`").distinct().collect()] == [("copies", "_copy", "_dn", "_i", "_row", "a.b")]


def test_sources_are_ranked_over_partitions(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("source")).union(spark.createDataFrame([(None,)], "source string"))
    got = [r.source for r in mixing.numbered(df.repartition(7), F.col("source").asc_nulls_last()).orderBy("_rank").collect()]
    assert got == [*sorted(map(str, range(1000))), None]
    assert mixing.numbered(df, F.col("source").asc_nulls_last()).agg(F.max("_rank"), F.count_distinct("_rank")).first() == (1000, 1001)


def test_repeated_rows_and_null_ids(spark, docs):
    df = docs.where("doc_id < 30").union(docs.where("doc_id < 10")).union(docs.where("doc_id = 3").withColumn("doc_id", F.lit(None).cast("long")))
    total = mixing.mix(df).agg(F.sum("copies")).first()[0]
    assert mixing.apply(df).count() == total
