from __future__ import annotations

from pyspark.sql import functions as F

from brindle.llm import mixing


def test_rows_without_an_id_fall_into_many_leaves(spark, monkeypatch):
    largest = []

    def staged(df, name, keep=mixing.staged):
        out = keep(df, name)
        if name == "mix-level":
            largest.append(out.groupBy("source", "_leaf").count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(mixing, "staged", staged)
    monkeypatch.setattr(mixing, "LEAF_ROWS", 20)
    rows = [(None if i % 2 else 7, f"word{i} " * 5, "a" if i % 4 else "b") for i in range(800)]
    assert mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).count() == 800
    assert largest[0] < 60


def test_equal_rows_fall_into_many_leaves_and_share_out_their_copies(spark, monkeypatch):
    largest = []

    def staged(df, name, keep=mixing.staged):
        out = keep(df, name)
        if name == "mix-level":
            largest.append(out.groupBy("source", "_leaf").count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(mixing, "staged", staged)
    monkeypatch.setattr(mixing, "LEAF_ROWS", 500)
    same = spark.range(10_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("three equal words").alias("text"), F.lit("a").alias("source"))
    other = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.when(F.col("id") % 2 == 0, "b").alias("source"))
    df = same.union(other).union(other.limit(20)).repartition(5)
    mixed = mixing.mix(df)
    counts = {(r.doc_id, r.source): r.n for r in mixed.groupBy("doc_id", "source").agg(F.sum("copies").alias("n")).collect()}
    assert largest[0] < 1200 and mixed.count() == 10_320
    told = mixed.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) < 3.001 for r in told)
    out = mixing.apply(df)
    assert {(r.doc_id, r.source): r.n for r in out.groupBy("doc_id", "source").agg(F.count(F.lit(1)).alias("n")).collect()} == {k: n for k, n in counts.items() if n}
    again = mixing.mix(df.repartition(3))
    assert sorted(map(tuple, again.groupBy("doc_id", "copies").count().collect()), key=repr) == sorted(map(tuple, mixed.groupBy("doc_id", "copies").count().collect()), key=repr)
