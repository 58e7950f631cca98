"""Forms of loads and checks for one hot key, small differences and growing schemas, against their plain forms."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from brindle.operators import checks, loads


def sorted_rows(df):
    return sorted(repr(tuple(r)).replace("-0.0", "0.0") for r in df.collect())  # as text, for NaN


def test_checksums_find_what_compare_finds(spark):
    rng = random.Random(2)
    schema = "k long, v double, s string, a array<int>"
    row = lambda: (rng.choice([None, 1, 2, 3]), rng.choice([None, 0.0, -0.0, float("nan"), 1.5]), rng.choice([None, "", "x"]), rng.choice([None, [], [1, None]]))
    a, b = ([row() for _ in range(n)] for n in (300, 320))
    a, b = (spark.createDataFrame(rows, schema).repartition(4) for rows in (a + a[:5], b + a[:100]))
    for how in ({}, {"leaves": 3, "levels": 1}, {"leaves": 1}, {"levels": 0}):
        assert sorted_rows(loads.compare_by_checksums(a, b, **how)) == sorted_rows(loads.compare(a, b))
    assert loads.compare_by_checksums(a, a.repartition(3)).count() == 0
    assert sorted_rows(loads.compare_by_checksums(a, b.limit(0))) == sorted_rows(loads.compare(a, b.limit(0)))


def test_few_rows_are_left_where_few_differ(spark):
    a = spark.range(200_000).select("id", (F.col("id") % 7).alias("v"))
    b = a.withColumn("v", F.when(F.col("id").isin(5, 77_777), -1).otherwise(F.col("v")))
    left, right = loads.differing(a, b, leaves=1024)
    assert left.count() + right.count() < 20 and loads.compare_by_checksums(a, b, leaves=1024).count() == 4


def test_snapshot_in_ranges_equals_snapshot(spark):
    rng = random.Random(3)
    rows = [("hot" if i % 3 else rng.choice(["a", "b", None]), rng.choice([None, *range(40)]), i) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, t long, tie long").repartition(6)
    assert sorted_rows(loads.snapshot_in_ranges(df, "k", "t", "tie")) == sorted_rows(loads.snapshot(df, "k", "t", "tie"))
    few = spark.createDataFrame([("a", 1, 1), ("a", 3, 1), ("b", None, 1)], "k string, t long, tie long")
    assert sorted_rows(loads.snapshot_in_ranges(few, "k", "t")) == sorted_rows(loads.snapshot(few, "k", "t"))
    assert loads.snapshot_in_ranges(few.limit(0), "k", "t").count() == 0


def test_a_hot_key_spans_tasks(spark):
    df = spark.range(40_000).select(F.lit("hot").alias("k"), F.col("id").alias("t")).repartition(4)
    out = loads.snapshot_in_ranges(df, "k", "t")
    assert out.where("is_current").count() == 1 and out.where("valid_to <> t + 1").count() == 0
    assert max(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()) < 20_000


@pytest.mark.parametrize("keys", [range(5000), range(-70_000, 70_000, 3), [2**40 * i for i in range(300)], []])
def test_bitmaps_fail_the_rows_without_a_parent(spark, keys):
    parents = [k for k in keys if k % 11]
    child = spark.createDataFrame([(k, i) for i, k in enumerate([*keys, *list(keys)[:50], None])], "fk long, i long").repartition(3)
    parent = spark.createDataFrame([(k,) for k in [*parents, *parents[:5], None]], "id int" if max([0, *parents]) < 2**31 else "id long")
    assert sorted_rows(checks.relationships_by_bitmaps(child, "fk", parent, "id")) == sorted_rows(checks.relationships(child, "fk", parent, "id"))
    assert checks.relationships_by_bitmaps(child, "fk", parent.limit(0), "id").first().failures == child.where("fk IS NOT NULL").count()


def test_appends_know_the_schema_without_reading_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    loads.write_appended(spark.createDataFrame([(1, "a")], "id long, x string"), path)
    loads.write_appended(spark.createDataFrame([(2, 5)], "id int, y int"), path)
    (told,) = (tmp_path / "t" / "_schema").glob("part-*")
    assert [f["name"] for f in json.loads(told.read_text())["fields"]] == ["id", "x", "y"]
    assert sorted_rows(loads.read_evolved(spark, path).select("id", "x", "y")) == ["(1, 'a', None)", "(2, None, 5)"]
    assert spark.read.parquet(path).count() == 2  # readers pass over the schema


def test_appends_to_a_folder_of_others(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a")], "id long, x string").write.parquet(path)
    loads.write_appended(spark.createDataFrame([(2, 5)], "id int, y int"), path)
    assert sorted_rows(loads.read_evolved(spark, path).select("id", "x", "y")) == ["(1, 'a', None)", "(2, None, 5)"]


def test_append_tells_types_that_do_not_fit(spark):
    a, b = spark.createDataFrame([(1,)], "id long"), spark.createDataFrame([("x",)], "id string")
    with pytest.raises(TypeError, match="column id"):
        loads.append(a, b)


def test_report_is_bounded(spark):
    results = spark.range(50).select(F.concat(F.lit("test.dw.n"), "id", F.lit(".x")).alias("unique_id"), F.lit("fail").alias("status"), F.lit("Got 1 result, x").alias("message"))
    told = checks.test_report(results, most_lines=3).first()
    assert (told.total, told.failed) == (50, 50) and told.report.count("\n") == 4 and told.report.endswith("… and 47 more")
