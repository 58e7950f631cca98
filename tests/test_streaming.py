from __future__ import annotations

import os
import shutil
import threading
import time

import pytest

from brindle.sources import ledger
from brindle.streaming.arrivals import file_stream, into, poll_files, process_files, read_log


def land(folder, name, rows):
    (folder / f".{name}").write_text("".join(f"{r}\n" for r in rows))
    (folder / f".{name}").rename(folder / name)


def stream_of(spark, tmp_path):
    return file_stream(spark, str(tmp_path / "in"), "x long", "csv")


def run(spark, tmp_path, strict=False, write=None):
    q = process_files(stream_of(spark, tmp_path), write or into(str(tmp_path / "out")), str(tmp_path / "log"), str(tmp_path / "check"), strict)
    q.awaitTermination(120)
    return rows_of(spark, tmp_path)


def rows_of(spark, tmp_path):
    log = [(os.path.basename(r.key), r.status) for r in read_log(spark, str(tmp_path / "log")).orderBy("batch_id", "key").collect()]
    return log, sorted(r.x for r in ledger.read(spark, str(tmp_path / "out")).collect())


def test_each_file_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    land(tmp_path / "in", "b.csv", [1, 2])
    assert run(spark, tmp_path) == ([("b.csv", "processed")], [1, 2])
    land(tmp_path / "in", "c.csv", [3])
    land(tmp_path / "in", "a.csv", [4])  # late by name
    log, rows = run(spark, tmp_path)
    assert log == [("b.csv", "processed"), ("a.csv", "processed"), ("c.csv", "processed")] and rows == [1, 2, 3, 4]
    assert run(spark, tmp_path)[1] == [1, 2, 3, 4]


def test_strict_mode_skips_late_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    land(tmp_path / "in", "b.csv", [1])
    run(spark, tmp_path, strict=True)
    land(tmp_path / "in", "a.csv", [2])
    land(tmp_path / "in", "c.csv", [3])
    log, rows = run(spark, tmp_path, strict=True)
    assert ("a.csv", "late") in log and rows == [1, 3]


def test_a_batch_that_is_run_again_adds_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n in (0, 1):
        land(tmp_path / "in", f"{n}.csv", range(10 * n, 10 * n + 10))
        before = run(spark, tmp_path)
    commits = tmp_path / "check" / "commits"
    for name in ("1", ".1.crc"):  # as if the query had died before it noted that the batch was done
        (commits / name).unlink(missing_ok=True)
    number = ledger.version(spark, str(tmp_path / "out")).number
    assert run(spark, tmp_path) == before and before[1] == list(range(20))
    assert ledger.version(spark, str(tmp_path / "out")).number == number


def test_a_crash_after_the_data_is_written(spark, tmp_path):
    (tmp_path / "in").mkdir()
    land(tmp_path / "in", "a.csv", [1, 2, 3])

    def dies(records, stream, number):
        into(str(tmp_path / "out"))(records, stream, number)
        raise RuntimeError("lost power")

    with pytest.raises(Exception, match="lost power"):
        run(spark, tmp_path, write=dies)
    assert run(spark, tmp_path) == ([("a.csv", "processed")], [1, 2, 3])


def test_a_stream_from_a_new_checkpoint_is_another_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    land(tmp_path / "in", "a.csv", [1])
    run(spark, tmp_path)
    shutil.rmtree(tmp_path / "check")
    assert run(spark, tmp_path)[1] == [1, 1]


def polled(spark, tmp_path, **how):
    return poll_files(stream_of(spark, tmp_path), into(str(tmp_path / "out")), str(tmp_path / "log"), str(tmp_path / "check"), poll_seconds=1, **how)


def test_polls_are_bounded(spark, tmp_path):
    (tmp_path / "in").mkdir()
    began = time.time()
    told = polled(spark, tmp_path, most_polls=3)
    assert told.polls == 3 and told.batches == 0 and 1.5 < time.time() - began < 60
    assert not spark.streams.active and spark.conf.get("spark.sql.streaming.noDataProgressEventInterval") != "0"


def test_polling_stops_after_the_first_batch_with_records(spark, tmp_path):
    (tmp_path / "in").mkdir()
    late = threading.Timer(3, land, (tmp_path / "in", "a.csv", [7]))
    late.start()
    told = polled(spark, tmp_path, most_polls=200)
    assert told.batches == 1 and 2 <= told.polls < 200 and rows_of(spark, tmp_path) == ([("a.csv", "processed")], [7])
    land(tmp_path / "in", "b.csv", [8])
    assert polled(spark, tmp_path, most_polls=3, stop_at_first=False).batches == 1
    assert rows_of(spark, tmp_path)[1] == [7, 8]


def test_a_failing_sink_ends_polling(spark, tmp_path):
    (tmp_path / "in").mkdir()
    land(tmp_path / "in", "a.csv", [7])

    def fails(records, stream, number):
        raise RuntimeError("no room")

    with pytest.raises(Exception, match="no room"):
        poll_files(stream_of(spark, tmp_path), fails, str(tmp_path / "log"), str(tmp_path / "check"), poll_seconds=1)
