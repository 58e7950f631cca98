"""Tables that the maintenance queries make have more files where there are more rows, not larger ones."""

from __future__ import annotations

from brindle.operators import loads, shaping, stored
from brindle.plans import roundtrips


def test_compacted_table_is_created_by_several_tasks(spark, sf_dir, monkeypatch):
    asked, real = [], stored.create

    def create(df, path, keys, files):
        asked.append(files)
        return real(df, path, keys, files)

    monkeypatch.setattr(stored, "create", create)
    monkeypatch.setattr(roundtrips, "FILE_ROWS", 2500, raising=False)
    told = {tuple(r) for r in roundtrips.compacted_in_place(spark, sf_dir).collect()}
    assert told == {("before", False, True, True), ("after", True, True, True)}
    assert asked[0] > 1


def test_tidy_table_is_written_by_several_tasks(spark, sf_dir, monkeypatch):
    tasks, real = {}, loads.materialize_table

    def materialize(df, name, path=None):
        tasks[name.split(".")[1].split("_")[0]] = df.rdd.getNumPartitions()
        return real(df, name, path)

    monkeypatch.setattr(loads, "materialize_table", materialize)
    monkeypatch.setattr(shaping, "stored_bytes", lambda df: 1 << 30)
    roundtrips.unhealthy_tables(spark, sf_dir)
    assert tasks["tidy"] > 1 and tasks["wide"] > 6
