"""Scans: declared tables, JSON and CSV landings, seeds, SQL over JDBC, files newer than a cursor."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DIALECTS = {"redshift": "jdbc:redshift://", "bigquery": "jdbc:bigquery://"}


def source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A declared raw table, as a Parquet scan that filters and column lists reach."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def import_as(df: DataFrame, alias: str) -> DataFrame:
    """``df`` under a name that SQL can use; the columns pass through."""
    df.createOrReplaceTempView(alias)
    return df.alias(alias)


def register_tables(spark: SparkSession, folder: str, name: str, tables: list[str], prefix: str | None = None) -> list[str]:
    """Views ``{prefix}__{table}`` over landed tables; the prefix is ``landed_{name}`` unless given."""
    prefix = prefix or f"landed_{name}"
    for t in tables:
        source(spark, folder, t).createOrReplaceTempView(f"{prefix}__{t}")
    return [f"{prefix}__{t}" for t in tables]


def read_json_landing(spark: SparkSession, path: str, schema: StructType | str | None = None, array: bool = True) -> DataFrame:
    """Records of landed JSON files: one array to a file, or with ``array=False`` a record to a line."""
    reader = spark.read.option("multiLine", array)
    return (reader.schema(schema) if schema else reader).json(path)


def read_resources(spark: SparkSession, folder: str, resources: dict[str, StructType | str | None]) -> dict[str, DataFrame]:
    """A source's resources, each a folder of landed JSON, under their names."""
    return {name: read_json_landing(spark, f"{folder}/{name}", schema) for name, schema in resources.items()}


def read_test_results(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """``unique_id``, ``status``, ``message`` of JSON documents that each hold a list ``results``: a file each, or with ``lines`` a
    line each, so that many share a file and a file is read by many tasks."""
    schema = "results array<struct<unique_id: string, status: string, message: string>>"
    return spark.read.option("multiLine", not lines).schema(schema).json(path).select(F.inline("results"))


def read_seed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Reference data as CSV with a header."""
    return spark.read.option("header", True).option("escape", '"').schema(schema).csv(path)


def jdbc_url(warehouse: str, rest: str = "") -> str:
    """The URL of a warehouse that JDBC scans know; ``ValueError`` for any other."""
    if warehouse not in DIALECTS:
        raise ValueError(f"no JDBC scan for {warehouse!r}, only for {', '.join(sorted(DIALECTS))}")
    return DIALECTS[warehouse] + rest


def read_jdbc(spark: SparkSession, sql: str, url: str, **options) -> DataFrame:
    """Rows of a query that a database runs; ``options`` may name how tasks share it (``partitionColumn`` and bounds)."""
    what = {"dbtable": f"({sql}) q"} if "partitionColumn" in options else {"query": sql}  # Spark shares out tables alone
    return spark.read.format("jdbc").options(url=url, **what, **options).load()


def make_resources(spark: SparkSession, makers: dict[str, Callable[[SparkSession], DataFrame]]) -> dict[str, DataFrame]:
    """Tables that functions of the session make, by name, as ``loads.load`` takes them.

    A maker's columns must have names of their own: a load writes all of them.
    """
    made = {name: make(spark) for name, make in makers.items()}
    for name, df in made.items():
        if len({c.lower() for c in df.columns}) < len(df.columns):
            raise ValueError(f"resource {name} repeats a column: {df.columns}")
    return made


def sample_records(spark: SparkSession, source_name: str, n: int = 3) -> DataFrame:
    """``id``, ``value``, ``source``: generated records to try a pipeline with."""
    return spark.range(1, n + 1).select("id", F.concat(F.lit("raw_record_"), F.col("id").cast("string")).alias("value"), F.lit(source_name).alias("source"))


def new_files(spark: SparkSession, path: str, last_key: str = "") -> DataFrame:
    """``key``, ``size``, ``mtime`` of the files below ``path`` that come after the cursor, in order; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    keyed = files.select(F.col("path").alias("key"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))
    return after_cursor(keyed, last_key)


def after_cursor(listing: DataFrame, last_key: str = "") -> DataFrame:
    """Rows of a listing with ``key`` above the cursor, by key."""
    return listing.where(F.col("key") > F.lit(last_key)).orderBy("key")


def next_cursor(listing: DataFrame, last_key: str = "") -> str:
    """The greatest key, or the old cursor if there is none."""
    return listing.agg(F.max("key")).first()[0] or last_key
