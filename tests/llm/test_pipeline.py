from __future__ import annotations

import re

import corpus_pipeline as p
import pytest
from pyspark.sql import functions as F
from test_linededup import brute as lines
from test_minhash import brute as groups
from test_quality import features
from tokenizers import Tokenizer

from brindle.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def folder(docs, texts, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{path}/documents.parquet")
    docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), F.lit(0).alias("toxic")).limit(0).write.parquet(f"{path}/labels.parquet")
    return path


def test_stage_names():
    assert [n for n, _ in p.STAGES] == ["quality_rules", "line_dedup", "minhash", "mixing", "bpe"]


def test_stages_by_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in p.STAGES[:-1]:
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        out = stage(spark, docs, folder)
        assert out.columns == columns
        got = sorted((r.doc_id, r.text) for r in out.collect())
        if name == "quality_rules":
            good = [f[0] >= 50 and 100 * f[4] <= 50 * f[0] for f in (features(t) for _, t in rows)]
            assert got == sorted(r for r, g in zip(rows, good, strict=True) if g)
        elif name == "line_dedup":
            assert got == sorted((i, t) for i, (_, _, t) in lines(rows, 10).items())
        elif name == "minhash":
            assert [i for i, _ in got] == sorted(i for i, (_, c) in groups(rows, 5, 80).items() if i == c)
        else:
            size = sum(len(re.findall(r"[^\x20\x09-\x0D]+", t)) for _, t in rows)
            taken = sum(len(re.findall(r"[^\x20\x09-\x0D]+", t)) for _, t in got)
            assert abs(taken - 1.5 * size) < 4 * 100 and set(got) <= set(rows)
        docs = out
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    out = p.STAGES[-1][1](spark, docs, folder).collect()
    assert len(out) == docs.count()
    for r in out:
        assert list(r.ids) == library.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_run(spark, sf_dir):
    out = p.run(spark, sf_dir)
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids"] and out.count() > 50


def test_stages_on_nulls_and_nothing(spark, folder):
    schema = spark.read.parquet(f"{folder}/documents.parquet").schema
    text = " ".join(f"w{i}" for i in range(60))
    odd = spark.createDataFrame([(None, text, None, None, None), (1, text, None, None, None), (1, text, "en", "a", 5), (2, None, "en", "a", 5), (3, "", "en", "a", 0)], schema)
    for rows in (odd, odd.limit(0)):
        for _, stage in p.STAGES:
            rows = stage(spark, rows, folder)
        rows.collect()


CLASHING = ["ids", "found", "kept", "quality", "base_failed", "n_words", "n_lines", "n_dropped", "n_shingles", "component_id", "size", "target", "copies", "taken", "mark", "_row", "_all", "_text", "_id", "_own"]


def test_stages_with_clashing_columns_and_a_very_long_text(spark, folder):
    schema = spark.read.parquet(f"{folder}/documents.parquet").schema
    words = lambda a, n: " ".join(f"w{i}" for i in range(a, a + n))
    shared = " ".join(f"s{i}" for i in range(12))  # a line of twelve documents
    rows = [(i, f"{shared}\n{words(100 * i, 80)}", "en", "ab"[i % 2], 5) for i in range(12)]
    rows += [(20, words(0, 100_000), "en", "a", 5), (20, words(0, 100_000), "en", "a", 5), (21, words(1, 100_000), "fr", "b", 5), (None, words(50_000, 60), None, None, None)]
    plain = spark.createDataFrame(rows, schema)
    clashing = plain.withColumns({c: F.struct(F.lit(i).alias("n")) if i % 3 == 0 else F.lit(c) for i, c in enumerate(CLASHING)})
    for name, stage in p.STAGES:
        out, more = stage(spark, plain, folder), stage(spark, clashing, folder)
        if name == "bpe":
            assert out.columns == more.columns
        else:
            assert out.columns == schema.names and more.columns == schema.names + CLASHING
        known = [c for c in out.columns if c != "ids"]
        count = lambda df: sorted(map(repr, df.select(*known, F.xxhash64("ids" if name == "bpe" else "text")).collect()))  # noqa: B023, E731
        assert count(out) == count(more) and len(out.head(1)) == 1
        if name == "line_dedup":
            assert not out.where(F.col("text").contains(shared)).count() and out.where("doc_id < 12").count() == 12
        if name == "minhash":
            assert sorted((r.doc_id for r in out.select("doc_id").collect()), key=repr) == sorted([*range(12), 20, None], key=repr)
        plain, clashing = out, more
