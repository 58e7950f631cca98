"""Data-quality, schema and freshness checks, each a row ``check, failures, passed`` of a result table."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.functions.columns import all_matches, at, first_match, hours_between, seconds_between, short_message, test_name, without_escapes
from brindle.operators.loads import compare

HOURS = 25.0

# Parts of a test runner's log lines: a decimal number, how long a run took, its counts.
DECIMAL = r"\d+(?:\.\d+)?"
TOOK = rf"(?:\d+ hours? )?(?:\d+ minutes? and )?{DECIMAL} seconds?"
ENDED = rf"Finished running [^\n]*?tests? in {TOOK}(?: \({DECIMAL}s\))?\."
TOTALS = r"Done\.(?: [A-Z-]+=\d+)+"
NOTABLE = r"(?:Failure|Warning) in test \w+"
RESULTS = r"Got \d+ results?"
# What stands for a line that a log does not have.
NO_SUMMARY = "<NO SUMMARY LOG FOUND/>"
NO_STATUS = "<NO STATUS LOG FOUND/>"


def _result(failures: DataFrame, name: str) -> DataFrame:
    return failures.select(F.lit(name).alias("check"), F.col("failures").cast("long").alias("failures"), (F.col("failures") == 0).alias("passed"))


def unique(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Failures are the values, null aside, that occur more than once."""
    repeated = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return _result(repeated.agg(F.count(F.lit(1)).alias("failures")), name or f"unique_{column}")


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """A row per column, from one pass over all of them."""
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])
    long = counts.select(F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in columns]), F.array(*columns))).alias("c", "failures"))
    return long.select(F.concat(F.lit("not_null_"), "c").alias("check"), "failures", (F.col("failures") == 0).alias("passed"))


def not_empty(df: DataFrame, name: str = "not_empty") -> DataFrame:
    """One failure if there are no rows."""
    return _result(df.agg(F.count(F.lit(1)).alias("n")).select(F.when(F.col("n") == 0, 1).otherwise(0).alias("failures")), name)


def row_checks(df: DataFrame, failing: dict[str, Column], not_empty: str | None = None) -> DataFrame:
    """A row per named condition, its failures the rows that meet it, and one for an empty table: all from one pass."""
    counts = [F.count(F.when(condition, 1)).alias(f"c{i}") for i, condition in enumerate(failing.values())]
    names = list(failing)
    if not_empty:
        counts.append(F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("long").alias(f"c{len(names)}"))
        names.append(not_empty)
    one = df.agg(*counts)
    rows = one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"c{i}").alias("failures")) for i, n in enumerate(names)])))
    return rows.withColumn("passed", F.col("failures") == 0)


def no_rows(failing: DataFrame, name: str) -> DataFrame:
    """A custom test: every row of ``failing`` is a failure."""
    return _result(failing.agg(F.count(F.lit(1)).alias("failures")), name)


def accepted_values(df: DataFrame, column: str, values: list, name: str | None = None) -> DataFrame:
    """Failures are the rows, null aside, with another value."""
    return no_rows(df.where(F.col(column).isNotNull() & ~F.col(column).isin(values)), name or f"accepted_values_{column}")


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str, name: str | None = None) -> DataFrame:
    """Failures are the child's rows, null keys aside, without a parent."""
    keys = parent.select(F.col(parent_column).alias("_parent"))
    return no_rows(child.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_parent"), "left_anti"), name or f"relationships_{column}")


#: Values of one bitmap, and bytes that it takes.
SPAN, SPAN_BYTES = 1 << 15, 1 << 12


def relationships_by_bitmaps(child: DataFrame, column: str, parent: DataFrame, parent_column: str, name: str | None = None) -> DataFrame:
    """``relationships`` for whole-number keys, where few or no rows fail: the same failures, without a join of all child rows.

    Both sides' keys become exact bitmaps of ``SPAN`` values, built before the shuffle; bits that only the child has are its
    keys without a parent, and the rows with these keys alone are counted. (A Bloom filter could not do that: all rows that it
    lets pass would have to be looked up.) Keys too sparse for bitmaps meet in ``relationships``.
    """
    name = name or f"relationships_{column}"
    keys = {"child": child.select(F.col(column).cast("long").alias("k")), "parent": parent.select(F.col(parent_column).cast("long").alias("k"))}
    keys = {side: df.where(F.col("k").isNotNull()) for side, df in keys.items()}
    span = F.shiftright("k", 15)
    size = keys["child"].agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(span).alias("spans")).first()
    if size.spans * SPAN_BYTES > 8 * size.rows + (1 << 20):  # bitmaps would take more than the keys
        return relationships(child, column, parent, parent_column, name)
    bits = F.bitmap_construct_agg(F.col("k").bitwiseAND(SPAN - 1))
    child_bits, parent_bits = (df.groupBy(span.alias("span")).agg(bits.alias(side)) for side, df in keys.items())
    orphans = child_bits.join(parent_bits, "span", "left").mapInArrow(_only_left, "k long")
    failing = child.join(orphans, F.col(column).cast("long") == F.col("k"), "left_semi")
    return no_rows(failing, name)


def _only_left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The values that ``child`` has and ``parent`` has not."""
    for batch in batches:
        for span, child, parent in zip(*[batch.column(c).to_pylist() for c in ("span", "child", "parent")], strict=True):
            left = np.frombuffer(child, np.uint8)
            if parent is not None:
                left = left & ~np.frombuffer(parent, np.uint8)
            if left.any():
                yield pa.record_batch([pa.array(span * SPAN + np.flatnonzero(np.unpackbits(left, bitorder="little")))], ["k"])


def matches(actual: DataFrame, expected: DataFrame, name: str = "matches") -> DataFrame:
    """A model's unit test: failures are the rows that only one side has; only the expected columns are compared."""
    return no_rows(compare(actual.select(*expected.columns), expected), name)


def column_count(df: DataFrame, n: int, name: str = "column_count") -> DataFrame:
    return _result(df.limit(0).agg(F.count(F.lit(1))).select(F.lit(0 if len(df.columns) == n else 1).alias("failures")), name)


def column_type(df: DataFrame, column: str, kind: str) -> DataFrame:
    failed = 0 if column in df.columns and df.schema[column].dataType.simpleString() == kind else 1
    return _result(df.limit(0).agg(F.count(F.lit(1))).select(F.lit(failed).alias("failures")), f"type_{column}")


def report(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def freshness(log: DataFrame, expected: DataFrame, asset: str = "asset", loaded_at: str = "loaded_at", hours: float = HOURS, as_of: datetime | None = None) -> DataFrame:
    """Per expected asset: its last load, its age, whether that is at most ``hours`` (inclusive), else why not.

    The severity is a warning: nothing is raised.
    """
    last = log.groupBy(F.col(asset).alias("asset")).agg(F.max(loaded_at).alias("last_loaded"))
    out = expected.select(F.col(asset).alias("asset")).distinct().join(last, "asset", "left")
    age = seconds_between(at(as_of), F.col("last_loaded")) / 3600
    passed = F.coalesce(age <= hours, F.lit(False))
    reason = F.when(F.col("last_loaded").isNull(), "Asset has never been loaded.").when(~passed, "Last load is too old.")
    return out.select("asset", "last_loaded", hours_between(at(as_of), F.col("last_loaded")).alias("age_hours"), F.lit(float(hours)).alias("threshold_hours"), passed.alias("passed"), reason.alias("reason"), F.lit("WARN").alias("severity"))


def run_duration(runs: DataFrame, started_at: str = "pipeline_start", hours: float = HOURS, as_of: datetime | None = None) -> DataFrame:
    """Every run with ``elapsed_hours`` and whether it is within the threshold."""
    elapsed = seconds_between(at(as_of), F.col(started_at)) / 3600
    return runs.withColumns({"elapsed_hours": hours_between(at(as_of), F.col(started_at)), "threshold_hours": F.lit(float(hours)), "passed": F.coalesce(elapsed <= hours, F.lit(False))})


def raise_if_exceeded(judged: DataFrame) -> DataFrame:
    """``judged`` itself, or ``ValueError`` if any of its runs has not passed."""
    if not judged.where(~F.col("passed")).isEmpty():
        raise ValueError("Run duration exceeded the threshold")
    return judged


def test_report(results: DataFrame, most_lines: int = 1000) -> DataFrame:
    """``total``, ``failed`` and ``report`` of test results (``unique_id``, ``status``, ``message``).

    The report lists the first ``most_lines`` failing lines in order and says how many more there are.
    """
    failed = F.col("status") == "fail"
    line = F.concat(test_name(F.col("unique_id")), F.lit(" - "), short_message(F.col("message")))
    counts = results.agg(F.count(F.lit(1)).alias("total"), F.count(F.when(failed, 1)).alias("failed"))
    lines = results.where(failed).select(line.alias("line")).where(F.col("line").isNotNull()).orderBy("line").limit(most_lines)  # the limit is kept by each task
    listed = lines.agg(F.sort_array(F.collect_list("line")).alias("lines"))
    out = counts.withColumn("_one", F.lit(1)).join(listed.withColumn("_one", F.lit(1)), "_one")
    more = F.when(F.col("failed") > most_lines, F.concat(F.lit("\n… and "), (F.col("failed") - most_lines).cast("string"), F.lit(" more"))).otherwise("")
    words = F.concat(F.col("failed").cast("string"), F.lit(" of "), F.col("total").cast("string"), F.lit(" tests failed in last run:\n"), F.array_join("lines", "\n"), more)
    fine = F.concat(F.lit("All "), F.col("total").cast("string"), F.lit(" tests passed in last run."))
    return out.select("total", "failed", F.when(F.col("failed") > 0, words).otherwise(fine).alias("report"))


def mine_test_logs(logs: DataFrame, text: str = "log") -> DataFrame:
    """Every log's ``summary``, ``status``, ``notable`` (failures and warnings with their counts) and ``n_failures``."""
    clean = without_escapes(F.col(text))
    notable = all_matches(clean, f"({NOTABLE})")
    counted = all_matches(clean, rf"({NOTABLE}[\s\S]*?{RESULTS})")
    short = F.transform(counted, lambda s: F.concat(F.regexp_extract(s, NOTABLE, 0), F.lit(" "), F.regexp_extract(s, f"{RESULTS}$", 0)))
    return logs.withColumns(
        {
            "summary": first_match(clean, ENDED, NO_SUMMARY, 0),
            "status": first_match(clean, TOTALS, NO_STATUS, 0),
            "notable": notable,
            "counts": short,
            "n_failures": F.size(F.filter(notable, lambda s: s.startswith("Failure"))).cast("long"),
        }
    )
