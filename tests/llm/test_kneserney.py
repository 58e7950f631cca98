from __future__ import annotations

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from brindle.llm import kneserney, queries


def kneser_ney(texts):
    """Plain modified Kneser-Ney over characters, straight from the formulas."""
    K, edges = kneserney.ORDER, kneserney.EDGE * (kneserney.ORDER - 1)
    counts = {K: Counter((edges + t)[i : i + K] for t in texts if t for i in range(len(t)))}
    for k in range(K - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    tables = {}
    for k, c in counts.items():
        t = Counter(c.values())
        y = t[1] / (t[1] + 2 * t[2]) if t[1] + 2 * t[2] else 0.5
        d = [min(max(j - (j + 1) * y * t[j + 1] / t[j], 0.05 * j), 0.95 * j) if t[j] and t[j + 1] else 0.5 * j for j in (1, 2, 3)]
        total, left = Counter(), Counter()
        for g, n in c.items():
            total[g[:-1]] += n
            left[g[:-1]] += d[min(n, 3) - 1]
        tables[k] = (c, d, total, left)

    def p(g):
        if not g:
            return 1 / kneserney.POINTS
        c, d, total, left = tables[len(g)]
        if not total[g[:-1]]:
            return p(g[1:])
        own = c[g] - d[min(c[g], 3) - 1] if c[g] else 0
        return own / total[g[:-1]] + left[g[:-1]] / total[g[:-1]] * p(g[1:])

    return lambda text: math.exp(-sum(math.log(p((edges + text)[i : i + K])) for i in range(len(text))) / len(text))


def test_perplexity_by_brute_force(spark, docs, monkeypatch):
    some = docs.where("doc_id < 40 OR length(text) < 300")
    rows = some.withColumn("held", kneserney.held_out(F.col("doc_id"))).collect()
    trusted = {r.doc_id for r in rows if r.doc_id % 2 == 0 and r.doc_id % 3 != 1}
    labels = spark.createDataFrame([(i, 1, 0) for i in trusted] + [(1, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(kneserney, "PART", 100)  # texts in several parts, chunks of few
    monkeypatch.setattr(kneserney, "CHUNK", 700)
    monkeypatch.setattr(kneserney, "SECTION", 250)
    out = {r.doc_id: r for r in kneserney.judge(some, labels).collect()}
    assert len(out) == len(rows)
    models = {x: kneser_ney([r.text for r in rows if r.lang == x and not r.held and r.doc_id in trusted]) for x in ("en", None)}
    logs = {x: sorted(math.log(out[r.doc_id].perplexity) for r in rows if r.lang == x and r.held and r.doc_id in trusted and r.text) for x in ("en", None)}
    at = lambda xs, q: xs[max(0, math.ceil(q * len(xs)) - 1)]
    every = sorted(y - at(xs, 0.5) for xs in logs.values() for y in xs)
    above, limits = at(every, 0.99) * (1 + len(every) ** -0.5), {}
    for x, xs in logs.items():
        share, alone = len(xs) / (len(xs) + kneserney.DRAWN), (at(xs, 0.99) - at(xs, 0.5)) * (1 + len(xs) ** -0.5)
        limits[x] = math.exp(at(xs, 0.5) + share * alone + (1 - share) * above)
    for r in rows:
        got = out[r.doc_id]
        assert got.lang == r.lang
        if r.lang == "fr" or not r.text:  # no trusted text
            assert got.perplexity is None and got.kept == bool(r.text)
        else:
            assert abs(got.perplexity / models[r.lang](r.text) - 1) < 1e-4
            assert got.kept == (got.perplexity <= got.threshold)
            assert abs(got.threshold / limits[r.lang] - 1) < 1e-9


def test_scripts_keep_their_distinctions_and_models_grow(spark):
    rng, han = random.Random(3), [chr(0x4E00 + i) for i in range(600)]
    words = ["".join(rng.choices(han, k=3)) for _ in range(60)]
    rows = [(i, "，".join(rng.choices(words, k=60)), "zh") for i in range(60)]
    rows += [(100 + i, "".join(rng.sample(t, len(t))), "zh") for i, t, _ in rows[:10]]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in kneserney.judge(frame, spark.createDataFrame([(i, 1, 0) for i in range(50)], "doc_id long, quality int, toxic int")).collect()}
    assert all(out[i].kept for i in range(50)) and not any(out[100 + i].kept for i in range(10))
    # The others are as likely to lie above a limit of some 25 documents as each of these: that far, and no farther.
    assert all(out[i].perplexity < 1.05 * out[i].threshold for i in range(50, 60))
    # 64 classes have 64 single n-grams at most.
    known, _ = kneserney.train(spark.createDataFrame([("=zh", a + b + c + a, 1) for a, b, c in zip(han, han[1:], han[2:])], "name string, gram string, n long"))
    assert known[0].count() > 500


def test_no_rows_no_labels(spark, docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert kneserney.judge(no_docs, labels).count() == 0
    got = kneserney.judge(docs, labels.limit(0))
    assert got.count() == docs.count() and got.where("kept").count() == docs.where("length(text) > 0").count()


def test_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    out = kneserney.judge(docs, labels.where("doc_id % 3 <> 0")).join(labels.where("doc_id % 3 = 0"), "doc_id").toPandas()
    good, bad = out[out.quality == 1].kept.mean(), out[out.quality == 0].kept.mean()
    print("kept of good", good, "of bad", bad)
    assert good > 0.97 and bad < 0.4


def test_query_is_this_model(spark, sf_dir):
    out = queries.op8_kneser_ney(spark, sf_dir)
    assert out.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert out.where(F.col("perplexity").isNotNull()).count() > 0


def test_only_null_languages(spark, docs):
    some = docs.where("doc_id < 30").withColumn("lang", F.lit(None).cast("string"))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(10)], "doc_id long, quality int, toxic int")
    out = kneserney.judge(some, labels).collect()
    assert sorted(r.doc_id for r in out) == list(range(30))
    assert all(r.perplexity is not None for r in out)


def test_a_language_with_one_trusted_document(spark):
    rows = [(i, f"some words of text number {i} " * 5, f"l{i % 12}") for i in range(24)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = kneserney.judge(df, spark.createDataFrame([(i, 1, 0) for i in range(12)], "doc_id long, quality int, toxic int")).collect()
    assert all(r.perplexity is not None and r.threshold is not None for r in out)
    assert all(r.kept for r in out if r.doc_id < 12)


def test_more_characters_than_16_bits_tell_apart():
    many = [chr(c) for c in [*range(0x20, 0xD800), *range(0xE000, 0x20000)]]
    parts = [kneserney.EDGE * 3 + "".join(many[i : i + 30_000]) for i in range(0, len(many), 30_000)]
    blocks = kneserney.blocks_of([len(p) for p in parts], kneserney._zip("".join(parts).encode()))
    assert len(blocks) > 1 and sum(len(b.parts) for b in blocks) == len(parts)
    assert [s for b in blocks for s in b.strings()].count("".join(many[:4])) == 1


def test_null_and_text_ids(spark):
    rows = [(None, "abc def " * 9, "en"), ("x", "abc def " * 9, "en"), ("y", None, "en"), ("x", "abc def " * 9, "en")]
    df = spark.createDataFrame(rows, "doc_id string, text string, lang string")
    out = kneserney.judge(df, spark.createDataFrame([("x", 1, 0)], "doc_id string, quality int, toxic int")).collect()
    assert sorted((r.doc_id or "", r.kept) for r in out) == [("", True), ("x", True), ("x", True), ("y", False)]


def test_any_number_of_languages(spark, docs, monkeypatch):
    rows = docs.where("doc_id < 60").withColumn("lang", F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("dirty "), "doc_id")).otherwise("en"))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 60, 2)], "doc_id long, quality int, toxic int")
    rounded = lambda out: sorted((r.doc_id, r.lang, r.kept, r.perplexity and round(r.perplexity, 3), r.threshold and round(r.threshold, 3)) for r in out.collect())
    told = rounded(kneserney.judge(rows, labels))
    monkeypatch.setattr(kneserney, "MOST_LANGUAGES", 5)  # beyond it nothing with a row for each is broadcast
    monkeypatch.setattr(F, "broadcast", None)
    assert rounded(kneserney.judge(rows, labels)) == told and {r[3] is None for r in told} == {False, True}
