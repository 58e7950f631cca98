"""Tables of Parquet files with a ledger, for loads that must not be seen half done.

``{path}/files`` holds the data, each write in a folder of its own; ``{path}/ledger/n=…`` holds a commit each: one Parquet file
that lists the files the table consists of since, with its schema and what else is true since then (``state``). A commit
appears with the rename of one file, so readers see the table before or after it, and files that a crashed writer left are
in no commit. Everything goes through Spark's readers and writers. The driver holds a table's list of files, nothing of
their content. Writers take turns: of two that commit the same number one fails.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "file string, rows long, bytes long, schema string, state string"
#: A type's columns take values of these others without loss.
WIDENS = {
    "smallint": {"tinyint"},
    "int": {"tinyint", "smallint"},
    "bigint": {"tinyint", "smallint", "int"},
    "double": {"tinyint", "smallint", "int", "float"},
    "timestamp": {"date"},
    "timestamp_ntz": {"date"},
}


@dataclass(frozen=True)
class File:
    rows: int
    bytes: int


@dataclass(frozen=True)
class Version:
    """A commit: its number, the files by name below ``{path}/files``, schema and state."""

    number: int = 0
    files: dict[str, File] = field(default_factory=dict)
    schema: T.StructType | None = None
    state: dict = field(default_factory=dict)


def absent(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """The last commit, or that of a number; number 0, without files, if there is none."""
    try:
        commits = spark.read.schema(f"{MANIFEST}, n long").parquet(f"{path}/ledger")
        number = number or commits.agg(F.max("n")).first()[0]
    except AnalysisException as error:
        if not absent(error):
            raise
        number = None
    if number is None:
        return Version()
    rows = commits.where(F.col("n") == number).collect()  # names of files, not data
    heads = [r for r in rows if r.file is None]
    if len(heads) != 1:
        raise RuntimeError(f"{len(heads)} writers made commit {number} of {path}")
    files = {r.file: File(r.rows, r.bytes) for r in rows if r.file is not None}
    return Version(number, files, T.StructType.fromJson(json.loads(heads[0].schema)), json.loads(heads[0].state))


def commit(spark: SparkSession, path: str, base: Version, files: dict[str, File], schema: T.StructType, state: dict) -> Version:
    """Make these files the table, if ``base`` is still its last commit."""
    new = Version(base.number + 1, files, schema, state)
    rows = [(None, None, None, schema.json(), json.dumps(state)), *[(name, f.rows, f.bytes, None, None) for name, f in files.items()]]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("error").parquet(f"{path}/ledger/n={new.number:012d}")
    return version(spark, path, new.number)


def read(spark: SparkSession, path: str, at: Version | None = None, names: list[str] | None = None) -> DataFrame:
    """The table, or that of an earlier commit, or only its files of these ``names``; columns that a file lacks are null."""
    at = at or version(spark, path)
    if at.schema is None:
        raise FileNotFoundError(f"no table at {path}")
    names = list(at.files) if names is None else names
    if not names:
        return spark.createDataFrame([], at.schema)
    return spark.read.schema(at.schema).parquet(*[f"{path}/files/{name}" for name in names])


def add_files(df: DataFrame, path: str, mark: str = "") -> dict[str, File]:
    """Write files that belong to no commit yet; their names. Rows and sizes come from the files' metadata.

    The name of the folder that they share ends with ``mark``.
    """
    spark, folder = df.sparkSession, uuid.uuid4().hex + mark
    df.write.parquet(f"{path}/files/{folder}")
    told = spark.read.schema(df.schema).parquet(f"{path}/files/{folder}").groupBy(F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_size").alias("bytes")).agg(F.count(F.lit(1)).alias("rows"))
    return {f"{folder}/{r.name}": File(r.rows, r.bytes) for r in told.collect()}


def evolved(stored: T.StructType | None, new: T.StructType) -> T.StructType:
    """The stored columns with their types, then those that are new. ``TypeError`` where a column's values would not fit."""
    if stored is None:
        return T.StructType([T.StructField(f.name, f.dataType, True) for f in new])
    kinds = {f.name: f.dataType for f in stored}
    for f in new:
        have = kinds.get(f.name)
        if have is not None and have != f.dataType and f.dataType.simpleString() not in WIDENS.get(have.simpleString(), ()) and not isinstance(f.dataType, T.NullType):
            raise TypeError(f"column {f.name} holds {have.simpleString()}, not {f.dataType.simpleString()}")
    return T.StructType([*stored, *[T.StructField(f.name, f.dataType, True) for f in new if f.name not in kinds]])


def fitted(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``df`` in the types that ``schema`` has for them."""
    kinds = {f.name: f.dataType for f in schema}
    return df.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in df.columns])


def append(df: DataFrame, path: str, state: dict | None = None, replace: bool = False) -> Version:
    """Add the rows (or with ``replace`` put them in place of all) and merge ``state`` into the table's, in one commit."""
    spark = df.sparkSession
    base = version(spark, path)
    schema = evolved(None if replace else base.schema, df.schema)
    files = add_files(fitted(df, schema), path)
    return commit(spark, path, base, files if replace else {**base.files, **files}, schema, {**base.state, **(state or {})})


def append_once(df: DataFrame, path: str, writer: str, batch: int) -> bool:
    """Add the rows of a writer's numbered batch unless that batch, or a later one, is in already; whether they were added.

    The batch's number is part of the commit, so a batch that is run again after any crash changes nothing.
    """
    done = version(df.sparkSession, path).state.get("batches", {})
    if done.get(writer, -1) >= batch:
        return False
    append(df, path, {"batches": {**done, writer: batch}})
    return True
