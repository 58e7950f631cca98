"""Bounds of the labelled sample, and what scratch tables leave in the catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.llm import qualityrules
from brindle.llm.common import bucketed


def labelled(spark, long_ids, n=40):
    rows = [(i, "word " * (20000 if i in long_ids else 60) if i % 2 else "# $ " * 60) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, i % 2) for i in range(n)], "doc_id long, quality int")


def first_by_hash(spark, n=40):
    return [r.id for r in spark.range(n).where("id % 2 = 1").orderBy(F.xxhash64("id")).collect()]


def test_one_long_text_does_not_take_the_place_of_all(spark):
    for long_ids in (set(), set(first_by_hash(spark)[:1]), set(first_by_hash(spark)[:10])):
        docs, labels = labelled(spark, long_ids)
        how = qualityrules.Training(chars=64 * 400)
        rows = qualityrules.sample(docs, labels, how).collect()
        assert len(rows) == 40 - len(long_ids) and {r.y for r in rows} == {0.0, 1.0}
        assert qualityrules.train(docs, labels, how) is not None


def test_each_class_has_its_half(spark):
    docs, labels = labelled(spark, set())
    rows = qualityrules.sample(docs, labels, qualityrules.Training(chars=64 * 300)).collect()
    sizes = {y: sum(len(r.text) for r in rows if r.y == y) for y in (0.0, 1.0)}
    assert all(0 < size <= 64 * 150 for size in sizes.values())


def test_a_lost_class_is_told(spark, caplog):
    docs, labels = labelled(spark, set(range(40)))
    assert qualityrules.train(docs, labels, qualityrules.Training(chars=64 * 400)) is None
    assert "no regression is fitted" in caplog.text
    assert qualityrules.train(docs.limit(0), labels) is None and qualityrules.train(docs, labels.limit(0)) is None


def test_buckets_leave_no_table(spark):
    before = {t.name for t in spark.catalog.listTables()}
    df = bucketed(spark.range(100).withColumn("v", F.col("id") * 2), "numbers", "id")
    assert {t.name for t in spark.catalog.listTables()} == before
    assert df.groupBy("id").agg(F.sum("v")).count() == 100 and "Exchange" not in df.groupBy("id").count()._jdf.queryExecution().sparkPlan().toString()
