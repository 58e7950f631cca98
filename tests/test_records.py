"""Inferred schemas, nested lists as tables, generators as tables."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from brindle.sources import generated, inferred, ledger


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string").repartition(3)


def test_inferred_schema_holds_all_records(spark):
    df = lines(spark, '{"a": 1, "b": {"c": 2.5}}', '{"a": 2.5, "d": [{"e": null}, {"e": "x"}]}', '{"b": {"c": 1, "f": true}, "g": null, "d": []}', "no json", None, "[1]", "7")
    got = inferred.infer_schema(df)
    assert got == T.StructType.fromDDL("a double, b struct<c: double, f: boolean>, d array<struct<e: string>>, g string")
    rows = {tuple(map(str, r)) for r in inferred.parsed(df.where("value LIKE '{%'"), got).collect()}
    assert ("2.5", "None", "[Row(e=None), Row(e='x')]", "None") in rows and len(rows) == 3
    assert inferred.infer_schema(df.limit(0)) == T.StructType() == inferred.infer_schema(lines(spark, "x", "[]"))


def test_nested_lists_become_tables(spark):
    df = lines(spark, '{"id": 1, "p": {"q": 5, "tags": ["a", "b"]}, "items": [{"n": 1, "subs": [{"m": 7}, {"m": 8}]}, {"n": 2}]}', '{"id": 2, "items": []}')
    tables = inferred.normalised(inferred.parsed(df, inferred.infer_schema(df)), "t", "id")
    rows = {name: sorted(tuple(r) for r in out.collect()) for name, out in tables.items()}
    assert set(tables) == {"t", "t__items", "t__p__tags", "t__items__subs"}
    assert sorted(tables["t"].columns) == ["id", "p__q"] and len(rows["t"]) == 2
    assert rows["t__items"] == [(1, "0", 1), (1, "1", 2)]
    assert rows["t__p__tags"] == [(1, "0", "a"), (1, "1", "b")]
    assert rows["t__items__subs"] == [(1, "0.0", 7), (1, "0.1", 8)]


def test_loads_evolve_the_tables(spark, tmp_path):
    inferred.load_records(spark, lines(spark, '{"id": 1, "xs": [1]}'), str(tmp_path), "t", "id")
    places = inferred.load_records(spark, lines(spark, '{"id": 2, "new": "n", "xs": [2, 3]}'), str(tmp_path), "t", "id")
    assert sorted(map(tuple, ledger.read(spark, places["t"]).collect())) == [(1, None), (2, "n")]
    assert sorted(map(tuple, ledger.read(spark, places["t__xs"]).collect())) == [(1, "0", 1), (2, "0", 2), (2, "1", 3)]
    with pytest.raises(TypeError):
        inferred.load_records(spark, lines(spark, '{"id": "text"}'), str(tmp_path), "t", "id")


def test_load_that_dies_between_two_tables(spark, tmp_path, monkeypatch):
    record, real = lines(spark, '{"id": 1, "xs": [1, 2]}'), ledger.append

    def dies(df, path, *more):
        if path.endswith("__xs"):
            raise RuntimeError("lost power")
        return real(df, path, *more)

    load = lambda batch: inferred.load_records(spark, record, str(tmp_path), "t", "id", writer="w", batch=batch)
    monkeypatch.setattr(ledger, "append", dies)
    with pytest.raises(RuntimeError):
        load(0)
    monkeypatch.setattr(ledger, "append", real)
    for batch, times in ((0, 1), (0, 1), (1, 2)):
        places = load(batch)
        assert [ledger.read(spark, places[t]).count() for t in ("t", "t__xs")] == [times, 2 * times]


def test_shares_cover_all_items():
    for first, last, n in ((0, 10, 3), (5, 5, 4), (0, 2, 8), (7, 107, 7)):
        parts = generated.shares(first, last, n)
        assert [i for p in parts for i in range(p.first, p.last)] == list(range(first, last)) and len(parts) <= n


def test_generator_is_read_by_many_tasks(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    what = {"make": "brindle.sources.generated:table_items", "size": "brindle.sources.generated:table_rows", "path": f"{sf_dir}/nation.parquet", "columns": "n_nationkey,n_name"}
    df = generated.read_generator(spark, rows.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), tasks=4, **what)
    assert df.rdd.getNumPartitions() == 4 and sorted(map(tuple, df.collect())) == sorted(map(tuple, rows.collect()))
    assert generated.read_generator(spark, "a int, b string", upto=0, **what).count() == 0


def test_stream_goes_on_where_it_stopped(spark, sf_dir, tmp_path):
    what = {"make": "brindle.sources.generated:table_items", "size": "brindle.sources.generated:table_rows", "path": f"{sf_dir}/orders.parquet", "columns": "o_orderkey"}
    seen = []
    for upto in (10, 10, 35):
        stream = generated.stream_generator(spark, "o_orderkey bigint", tasks=3, upto=upto, **what)
        run = lambda df, n: seen.append(df.count())
        stream.writeStream.foreachBatch(run).option("checkpointLocation", str(tmp_path)).trigger(availableNow=True).start().awaitTermination(60)
    assert sum(seen) == 35 and [n for n in seen if n] == [10, 25]
