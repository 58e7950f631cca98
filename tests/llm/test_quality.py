from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from brindle.llm import qualityrules


def features(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


def test_features_by_brute_force(spark, docs):
    odd = spark.createDataFrame([(9000, "a b c a b c\u3000d # | <>\x0bx\n \nq\nq\nq "), (9001, "  \n"), (9002, "é" * 50 + " " + "é" * 3)], "doc_id long, text string")
    for r in qualityrules.judge(docs.select("doc_id", "text").union(odd), None).collect():
        assert tuple(r[f] for f in qualityrules.FEATURES) == features(r.text), r.doc_id
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed) and r.quality is None


def test_held_out_accuracy_and_calibration(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{d}/labels.parquet")
    model = qualityrules.train(docs, labels.where("doc_id % 3 <> 0"))
    held = qualityrules.judge(docs, model).join(labels.where("doc_id % 3 = 0").select("doc_id", F.col("quality").alias("label")), "doc_id").toPandas()
    judged = held[~held.base_failed]
    assert (judged.kept == (judged.label == 1)).mean() > 0.97
    assert held[(held.label == 1) & ~held.base_failed].kept.mean() > 0.98
    p = held.quality.clip(1e-6, 1 - 1e-6)
    assert -(held.label * np.log(p) + (1 - held.label) * np.log(1 - p)).mean() < 0.2


def test_training_is_bounded_and_repeatable(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    how = qualityrules.Training(rows=40)
    a, b = qualityrules.train(docs, labels, how), qualityrules.train(docs.repartition(7), labels, how)
    assert np.array_equal(a.words, b.words) and (a.slope, a.offset) == (b.slope, b.offset)
    assert qualityrules.train(docs, labels.where("quality = 1")) is None
    assert qualityrules.train(docs, labels.limit(0)) is None


def test_sample_is_bounded_whatever_repeats(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    known = labels.groupBy("quality").agg(F.min("doc_id").alias("doc_id"))
    many = docs.join(known, "doc_id").select("doc_id", "text")
    many = many.union(many.withColumn("text", F.concat("text", F.lit(" x")))).union(many)
    assert qualityrules.sample(many, known, qualityrules.Training(rows=2)).count() == 2
    some = qualityrules.sample(docs, labels, qualityrules.Training(chars=40_000))
    assert 0 < some.count() < 60 and some.agg(F.sum(F.length("text"))).first()[0] <= 40_000


def test_scores_by_brute_force(spark):
    rng = np.random.default_rng(3)
    model = qualityrules.Model(rng.random(1 << qualityrules.BITS).astype(np.float32), rng.random(1 << qualityrules.BITS).astype(np.float32), 0.25, 1.0, 0.0)
    texts = ["", "a", "ab cd", "日本語 の", "one two one two", "é" * 3, "abc", "x y z é"]
    together = qualityrules.Batch([t.encode() for t in texts]).raw(model)
    for text, score in zip(texts, together, strict=True):
        one = qualityrules.Batch([text.encode()])
        want = 0.25
        for weights, (slots, a, z), n in zip((model.words, model.words, model.grams), one.slots(), (len(text.split()), max(len(text.split()) - 1, 0), max(len(text) - 3, 0)), strict=True):
            assert z[0] - a[0] == n
            want += float(weights[slots[a[0] : z[0]]].astype(float).sum()) / max(n, 1)
        assert abs(score - want) < 1e-6


def test_quality_on_empty_and_clashing_tables(spark, no_docs, docs):
    assert qualityrules.judge(no_docs, None).count() == 0
    assert qualityrules.judge(docs.withColumn("kept", F.lit("x")).withColumn("n_words", F.lit("y")), None).schema["kept"].dataType.simpleString() == "boolean"
