from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from brindle.operators import stored
from brindle.sources import ledger


def keyed(spark, rows, schema="k long, v string"):
    return spark.createDataFrame(rows, schema)


def rows_of(spark, path):
    return sorted((tuple(r) for r in ledger.read(spark, path).collect()), key=repr)


def test_commits_and_earlier_versions(spark, tmp_path):
    path = str(tmp_path)
    assert ledger.version(spark, path) == ledger.Version()
    with pytest.raises(FileNotFoundError):
        ledger.read(spark, path)
    ledger.append(keyed(spark, [(1, "a")]), path, {"x": 1})
    ledger.append(spark.createDataFrame([(2, 5)], "k int, w long"), path)
    assert rows_of(spark, path) == [(1, "a", None), (2, None, 5)]
    assert ledger.version(spark, path).state == {"x": 1}
    assert [tuple(r) for r in ledger.read(spark, path, ledger.version(spark, path, 1)).collect()] == [(1, "a")]
    ledger.append(keyed(spark, [], "k long, v string"), path)
    assert ledger.version(spark, path).number == 3 and len(rows_of(spark, path)) == 2
    ledger.append(keyed(spark, [(9, "z")]), path, replace=True)
    assert rows_of(spark, path) == [(9, "z")]


def test_types_that_do_not_fit_are_told_up_front(spark, tmp_path):
    ledger.append(keyed(spark, [(1, "a")]), str(tmp_path))
    with pytest.raises(TypeError, match="column k holds bigint, not string"):
        ledger.append(keyed(spark, [("x", "a")], "k string, v string"), str(tmp_path))
    assert ledger.version(spark, str(tmp_path)).number == 1


def test_writers_take_turns(spark, tmp_path):
    path = str(tmp_path)
    base = ledger.append(keyed(spark, [(1, "a")]), path)
    ledger.commit(spark, path, base, base.files, base.schema, {"who": "first"})
    with pytest.raises(AnalysisException):
        ledger.commit(spark, path, base, base.files, base.schema, {"who": "second"})
    assert ledger.version(spark, path).state == {"who": "first"}


def test_what_a_crashed_writer_left_is_in_no_version(spark, tmp_path):
    path = str(tmp_path)
    ledger.append(keyed(spark, [(1, "a")]), path)
    ledger.add_files(keyed(spark, [(2, "b")]), path)  # and no commit
    assert rows_of(spark, path) == [(1, "a")]


def test_append_once(spark, tmp_path):
    path = str(tmp_path)
    for batch in (0, 1, 1, 0, 2):
        ledger.append_once(keyed(spark, [(batch, "s")]), path, "s", batch)
    assert ledger.append_once(keyed(spark, [(7, "t")]), path, "t", 0)
    assert [r[0] for r in rows_of(spark, path)] == [0, 1, 2, 7]


def test_upsert_writes_only_files_with_keys(spark, tmp_path):
    path = str(tmp_path)
    before = stored.create(spark.range(1000).select(F.col("id").alias("k"), F.lit("old").alias("v")), path, ["k"], 10)
    assert len(before.files) == 10
    batch = keyed(spark, [(5, "first"), (5, "second"), (None, "lost"), (5000, "new")])
    after = stored.upsert(batch, path, [F.desc("v")], target=1 << 30)
    assert len(before.files.keys() - after.files.keys()) == 1  # 5000 lies above all files
    want = {k: "old" for k in range(1000)} | {5: "second", 5000: "new"}
    assert dict(rows_of(spark, path)) == want
    again = stored.upsert(batch, path, [F.desc("v")])
    assert dict(rows_of(spark, path)) == want and again.number == after.number + 1


def test_filters_tell_files_apart_that_ranges_do_not(spark, tmp_path):
    path = str(tmp_path)
    evens, odds = (spark.range(2000).where(f"id % 2 = {r}").select(F.col("id").alias("k"), F.lit("x").alias("v")) for r in (0, 1))
    at = stored.create(evens, path, ["k"], 1)
    files = {**at.files, **stored._add_indexed(odds.coalesce(1), path, ["k"])}
    at = ledger.commit(spark, path, at, files, at.schema, at.state)
    index = spark.read.parquet(*[f"{path}/index/{n.split('/')[0]}" for n in at.files])
    keys = keyed(spark, [(11, ""), (501, "")]).select("k")
    import numpy as np

    probe = stored._probe(np.array([list(r) for r in keys.select(*stored._slots(["k"])).collect()]))
    assert index.select("file", "bloom").mapInArrow(probe, "file string").count() == 1
    assert stored.files_with_keys(spark, path, at, keys, ["k"]) == list(files.keys() - at.files.keys()) or len(stored.files_with_keys(spark, path, at, keys, ["k"])) == 1


def test_an_index_sorts_no_more_than_slots(spark, tmp_path, monkeypatch):
    """A task that indexes a file sorts distinct slots, not a row for each key and slot."""
    from pyspark.sql.readwriter import DataFrameWriter

    plans, real = [], DataFrameWriter.parquet

    def planned(writer, path, *args, **options):
        if "/index/" in path:
            plans.append(writer._df._jdf.queryExecution().executedPlan().toString())
        return real(writer, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", planned)
    stored.create(spark.range(5000).select(F.col("id").alias("k"), (-F.col("id")).alias("j")), str(tmp_path), ["k", "j"], 2)
    index = spark.read.parquet(f"{tmp_path}/index/*")
    (plan,) = plans
    for line in plan.splitlines():  # what is sorted comes from an aggregate that is hashed
        assert "SortAggregate" not in line or "bitmap_construct_agg" in line, line
    assert plan.count("keys=[file#") >= 2 and "slot" in plan.split("partial_bitmap_construct_agg")[1].split("HashAggregate")[1]
    assert sorted((r.low.k, r.high.k, r.low.j, r.high.j) for r in index.collect())[0][0] == 0


@pytest.mark.parametrize("probed", [20_000, 0])
def test_upsert_by_two_keys_equals_a_dictionary(spark, tmp_path, monkeypatch, probed):
    monkeypatch.setattr(stored, "MOST_PROBED", probed)
    rng, path, want = random.Random(probed), str(tmp_path), {}
    schema = "a long, b string, v long"
    first = [(i % 30, str(i // 30), i) for i in range(300)]
    want = {(a, b): v for a, b, v in first}
    stored.create(keyed(spark, first, schema), path, ["a", "b"], 5)
    for _ in range(3):
        batch = [(rng.randrange(40), str(rng.randrange(12)), rng.randrange(1000, 2000)) for _ in range(20)]
        for a, b, v in sorted(batch, key=lambda r: r[2]):
            want[a, b] = v
        stored.upsert(keyed(spark, batch, schema), path, [F.desc("v")])
    assert {(a, b): v for a, b, v in rows_of(spark, path)} == want


def test_upsert_of_nothing_and_into_nothing(spark, tmp_path):
    path = str(tmp_path)
    stored.create(keyed(spark, []), path, ["k"], 3)
    stored.upsert(keyed(spark, []), path, [F.col("v")])
    assert rows_of(spark, path) == []
    stored.upsert(keyed(spark, [(1, "a")]), path, [F.col("v")])
    assert rows_of(spark, path) == [(1, "a")]


@pytest.mark.parametrize("probed", [20_000, 0])
def test_upsert_of_keys_in_appended_files(spark, tmp_path, monkeypatch, probed):
    monkeypatch.setattr(stored, "MOST_PROBED", probed)
    path = str(tmp_path)
    stored.create(keyed(spark, [(i, "old") for i in range(10)]), path, ["k"], 2)
    ledger.append(keyed(spark, [(100, "appended"), (101, "appended"), (None, "appended")]).coalesce(1), path)  # no index
    at = stored.upsert(keyed(spark, [(101, "new"), (3, "new")]), path, [F.col("v")])
    want = {i: "old" for i in range(10)} | {100: "appended", 101: "new", None: "appended", 3: "new"}
    assert dict(rows_of(spark, path)) == want and len(rows_of(spark, path)) == len(want)
    assert all(name.split("/")[0].endswith(stored.INDEXED) for name in at.files)
    ledger.append(keyed(spark, [(200, "appended")]), path)
    stored.compact(spark, path, small=1 << 30)
    stored.upsert(keyed(spark, [(200, "new")]), path, [F.col("v")])
    assert dict(rows_of(spark, path)) == want | {200: "new"}


def test_increment_that_dies_between_data_and_state(spark, tmp_path, monkeypatch):
    path, source = str(tmp_path), keyed(spark, [(1, 10), (2, 20), (3, None)], "k long, t long")
    real = ledger.commit

    def dies(*args):
        raise RuntimeError("lost power")

    monkeypatch.setattr(ledger, "commit", dies)
    with pytest.raises(RuntimeError):
        stored.load_increment(source, path, "t", ["k"])
    monkeypatch.setattr(ledger, "commit", real)
    stored.load_increment(source, path, "t", ["k"])
    assert rows_of(spark, path) == [(1, 10), (2, 20)]
    monkeypatch.setattr(ledger, "commit", dies)
    more = source.union(keyed(spark, [(4, 30)], "k long, t long"))
    with pytest.raises(RuntimeError):
        stored.load_increment(more, path, "t", ["k"])
    monkeypatch.setattr(ledger, "commit", real)
    for _ in range(2):
        stored.load_increment(more, path, "t", ["k"])
    assert rows_of(spark, path) == [(1, 10), (2, 20), (4, 30)] and ledger.version(spark, path).state["cursor"] == "30"


def test_look_back_finds_what_came_late(spark, tmp_path):
    path, day = str(tmp_path), lambda d: datetime(2024, 1, d)
    schema = "k long, t timestamp_ntz"
    stored.load_increment(keyed(spark, [(1, day(1)), (2, day(10)), (None, day(10))], schema), path, "t", ["k"], "3 days")
    source = keyed(spark, [(1, day(1)), (2, day(10)), (None, day(10)), (3, day(8)), (4, day(2)), (5, day(11)), (5, day(12))], schema)
    stored.load_increment(source, path, "t", ["k"], "3 days")
    assert {(r[0], r[1].day) for r in rows_of(spark, path)} == {(1, 1), (2, 10), (None, 10), (3, 8), (5, 12)}
    stored.load_increment(source.limit(0), path, "t", ["k"], "3 days")
    assert len(rows_of(spark, path)) == 5 and ledger.version(spark, path).state["cursor"].startswith("2024-01-12")


def test_packing():
    f = {str(i): ledger.File(1, size) for i, size in enumerate([90, 50, 40, 30, 10, 5, 200])}
    assert stored.packed(f, 100, 100) == [["0", "4"], ["1", "2", "5"]]
    assert stored.packed(f, 6, 100) == [] and stored.packed({}, 10, 10) == []


def test_compaction_leaves_large_files_alone(spark, tmp_path):
    path = str(tmp_path)
    at = stored.create(spark.range(20000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v")), path, ["k"], 1)
    large, (size,) = set(at.files), [f.bytes for f in at.files.values()]
    for i in range(5):
        at = ledger.commit(spark, path, at, {**at.files, **stored._add_indexed(spark.range(30000 + i, 30100, 7).select(F.col("id").alias("k"), F.lit("s").alias("v")).coalesce(1), path, ["k"])}, at.schema, at.state)
    before, told = rows_of(spark, path), stored.health(spark, {"t": path}, size).first()
    assert (told.n_files, told.n_small, told.n_rows) == (6, 5, len(before))
    assert stored.maintain(spark, {"t": path}, small=size) == ["t"] and stored.maintain(spark, {"t": path}, small=size) == []
    after = ledger.version(spark, path)
    assert rows_of(spark, path) == before and len(after.files) == 2 and large < set(after.files)
    stored.upsert(keyed(spark, [(30007, "new")]), path, [F.col("v")])  # the index came along
    assert large < set(ledger.version(spark, path).files) and ("new" in {r[1] for r in rows_of(spark, path)})
