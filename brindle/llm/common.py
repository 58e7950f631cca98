"""What the operators share: scratch tables in the cluster's shared folder, and Arrow helpers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.sources.scratch import scratch_folder

#: Bytes of text that a numpy kernel takes at a time: its 8-byte arrays then stay near the CPU.
CHUNK_BYTES = 1 << 18


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it again: lineage ends there, and a lost executor
    costs only the tasks that it ran."""
    path = scratch_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, column: str) -> DataFrame:
    """``df`` in the shared folder, in as many buckets of ``column`` as a shuffle has partitions.

    A task writes a file for each bucket that it has rows of; joins on ``column`` then leave these rows where they are.
    The catalog's entry goes at once, whatever comes of the query: the DataFrame knows the files and their buckets.
    """
    spark, table = df.sparkSession, f"brindle_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        df.write.format("parquet").option("path", scratch_folder(spark, name)).option("compression", "zstd").bucketBy(buckets, column).saveAsTable(table)
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def join_by_slices(rows: DataFrame, told: DataFrame, on: list[str], by: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``told``, which has one row for each key, whatever share of ``rows`` one key has.

    Rows of a key are dealt into as many slices (by column ``by``) as a shuffle has partitions, and ``told`` goes to the
    slices that a key has rows in: at most one row for each, told apart before the shuffle. Keys must not be null.
    """
    slices = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = rows.withColumn("_slice", F.pmod(F.xxhash64(by), F.lit(slices)))
    spread = told.join(cut.select(*on, "_slice").distinct(), on)
    return cut.join(spread, [*on, "_slice"], how).drop("_slice")


def packed(df: DataFrame, *without: str) -> Column:
    """The columns of ``df`` but these as one struct, so that no name among them meets one of an operator's own."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in without]
    return F.struct(*kept or [F.lit(None).cast("int").alias("_")])


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return df.mapInArrow(run, schema)


def slices(sizes, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Cut a list of sizes into runs ``[i, j)`` of about ``limit`` in total, one item at least."""
    i, total = 0, 0
    for j, size in enumerate(sizes):
        if j > i and total + size > limit:
            yield i, j
            i, total = j, 0
        total += size
    if i < len(sizes):
        yield i, len(sizes)


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null is empty."""
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    else:
        column = column.cast(pa.binary())
    return [x or b"" for x in column.to_pylist()]


def replace_columns(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """``batch`` with these columns last; a column that had such a name goes."""
    names = [n for n in batch.schema.names if n not in columns]
    arrays = [batch.column(batch.schema.get_field_index(n)) for n in names]
    return pa.RecordBatch.from_arrays([*arrays, *columns.values()], names=[*names, *columns])


def with_fields(schema: T.StructType, **types: T.DataType) -> T.StructType:
    """The schema that ``replace_columns`` gives."""
    return T.StructType([f for f in schema.fields if f.name not in types] + [T.StructField(n, t) for n, t in types.items()])
