"""Smaller shapes: enrichment, summaries, pivots, maintenance candidates."""

from __future__ import annotations

import math
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.functions.columns import maintenance_command

#: Most bytes of a file that maintenance writes, a task each; the half of it is more than a small file has.
#: What the task reads, not encoded by columns, is several times a file's size.
TARGET_BYTES = 160 << 20


def enrich(df: DataFrame) -> DataFrame:
    """All fields, ``value`` in upper case, ``transformed`` true; a null value stays null."""
    return df.withColumns({"value": F.upper("value"), "transformed": F.lit(True)})


def load_summary(df: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return df.agg(n.alias("records"), F.format_string("Loaded %d records successfully", n).alias("summary"))


def pivot_counts(df: DataFrame, rows: str, column: str, values: list[str]) -> DataFrame:
    """A row per ``rows`` and a count per value; 0 where a row has none."""
    return df.groupBy(rows).pivot(column, values).agg(F.count(F.lit(1))).fillna(0, values)


def maintenance_candidates(stats: DataFrame, schemas: list[str]) -> DataFrame:
    """Tables of these schemas with dead rows, most first, each with its command."""
    dead = stats.where(F.col("schemaname").isin(schemas) & (F.col("n_dead") > 0))
    return dead.withColumn("command", maintenance_command(F.col("schemaname"), F.col("relname"))).orderBy(F.desc("n_dead"), "schemaname", "relname")


def table_health(spark: SparkSession, tables: list[str], small: int = 64 << 20) -> DataFrame:
    """Per table of the catalog: ``schemaname``, ``relname``, ``n_files``, ``n_small`` (files below ``small`` bytes),
    ``n_rows``, ``n_known`` (rows by its statistics, null without any).

    Files are counted from each row's file of origin, so nothing but metadata columns is read.
    """
    out = None
    for name in tables:  # a list of names, not data
        schema, _, table = name.rpartition(".")
        told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        known = re.search(r"(\d+) rows", told.get("Statistics") or "")
        files = spark.table(name).groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).agg(F.count(F.lit(1)).alias("n"))
        one = files.agg(F.count(F.lit(1)).alias("n_files"), F.count(F.when(F.col("size") < small, 1)).alias("n_small"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))
        one = one.select(F.lit(schema or "default").alias("schemaname"), F.lit(table).alias("relname"), "*", F.lit(int(known[1]) if known else None).cast("long").alias("n_known"))
        out = one if out is None else out.union(one)
    return out


def unhealthy(health: DataFrame, most_small: int = 1) -> DataFrame:
    """Tables of ``table_health`` with more than ``most_small`` small files or stale statistics, most small files first."""
    stale = ~F.col("n_rows").eqNullSafe(F.col("n_known"))
    found = health.withColumn("stale", stale).where((F.col("n_small") > most_small) | stale)
    return found.withColumn("command", maintenance_command(F.col("schemaname"), F.col("relname"))).orderBy(F.desc("n_small"), "schemaname", "relname")


def compact(df: DataFrame, path: str, files: int) -> None:
    """Write a table again as ``files`` files of about equal size, to a new folder."""
    df.repartition(files).write.mode("overwrite").parquet(path)


def analyze(spark: SparkSession, table: str) -> None:
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")


def stored_bytes(df: DataFrame) -> int:
    """Size of the files that a table's rows lie in; of a file nothing but its metadata is read."""
    files = df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).distinct()
    return files.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]


def files_for(df: DataFrame, target: int = TARGET_BYTES) -> int:
    """How many files of about ``target`` bytes hold the rows of ``df``."""
    return max(1, math.ceil(stored_bytes(df) / target))


def maintain(candidates: DataFrame, folder: str, target: int = TARGET_BYTES) -> list[str]:
    """Work off maintenance candidates, the worst first; what was done.

    Each table is written as files of about ``target`` bytes below ``folder``, the catalog's entry is pointed there in one change, and statistics are
    made of the new files; readers see the old files or the new ones. The old files stay where they are. A candidate that
    is no table of the session's catalog is left out; one with partitions is only analyzed, as it has a place for each.
    The candidates are a list of tables, not data, and are walked on the driver. ``stored.maintain`` mends tables with a
    ledger and leaves their large files alone.
    """
    spark, done = candidates.sparkSession, []
    for schema, table in candidates.select("schemaname", "relname").collect():
        name = f"`{schema}`.`{table}`"
        if spark.catalog.tableExists(name):
            if not any(c.isPartition for c in spark.catalog.listColumns(name)):
                place = f"{folder.rstrip('/')}/{schema}.{table}-{uuid.uuid4().hex}"
                compact(spark.table(name), place, files_for(spark.table(name), target))
                spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
                spark.catalog.refreshTable(name)
            analyze(spark, name)
            done.append(name)
    return done
