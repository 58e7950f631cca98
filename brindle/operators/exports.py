"""Delimited and text exports: one file, or one per group, with templated names and a manifest."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from datetime import datetime
from functools import reduce

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.functions.columns import file_name
from brindle.operators.loads import put_in_place
from brindle.sources.scratch import scratch_folder

#: Bytes that a task copies at a time.
BLOCK = 8 << 20


def rename_columns(df: DataFrame, mapping: dict[str, str] | None) -> DataFrame:
    """Headers by mapping; names that are not there are ignored."""
    return df.withColumnsRenamed(mapping or {})


def export_one(df: DataFrame, path: str, sep: str = ",") -> None:
    """One delimited file with a header in folder ``path``; for reports that one task can write."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("sep", sep).option("emptyValue", "").csv(path)


def export_text(df: DataFrame, path: str) -> None:
    """A text column, one line a row."""
    df.write.mode("overwrite").text(path)


def with_file(frames: DataFrame | list[DataFrame], columns: str | list[str], pattern: str | None = None, functions: dict[str, Callable[[Column], Column]] | None = None, as_of: datetime | None = None, extension: str = "csv") -> DataFrame:
    """Rows of all frames with ``_file``, their group's file; rows with a null in the group's columns go."""
    columns = [columns] if isinstance(columns, str) else columns
    rows = reduce(DataFrame.unionByName, frames) if isinstance(frames, list) else frames
    return rows.dropna(subset=columns).withColumn("_file", file_name(columns, pattern, functions, as_of, extension))


def export_groups(rows: DataFrame, path: str, sep: str = ",", salt: int = 1) -> None:
    """A folder ``_file=…`` for each file of ``with_file``; the group's columns stay in it.

    A group's rows come together but for one that is large, which adaptive execution splits at its partition size. With
    ``salt`` over 1 every group is dealt to as many tasks by a hash of its rows, which a task that is run again repeats.
    """
    salted = F.pmod(F.xxhash64(*rows.columns), F.lit(salt))
    dealt = rows.repartition("_file", salted) if salt > 1 else rows.hint("rebalance", "_file")
    dealt.write.mode("overwrite").option("header", True).option("sep", sep).option("emptyValue", "").partitionBy("_file").csv(path)


def export_files(rows: DataFrame, path: str, sep: str = ",", salt: int = 1) -> DataFrame:
    """One file in folder ``path`` for each file of ``with_file``, under its very name; ``file``, ``parts``, ``bytes`` of each.

    A group's rows are written as parts by as many tasks as they need (``export_groups``) in the shared scratch folder. Then
    a task for each file copies its parts one after the other, some bytes at a time, the header only once; so one file
    passes through one task, but never through its memory. Files take their names when they are whole, and the folder
    takes the place of what ``path`` held when all of them are. Without rows it is an empty folder.

    ``path`` is a URI that pyarrow can open, or an absolute path. In names ``/``, ``:`` (which Hadoop cannot read) and
    ``%`` are written ``%2F``, ``%3A`` and ``%25``; rows without a name are left out.
    """
    spark, rows = rows.sparkSession, rows.where(F.col("_file").isNotNull())
    parts, head, told = (scratch_folder(spark, f"export-{x}") for x in ("parts", "header", "told"))
    export_groups(rows, parts, sep, salt)
    export_one(spark.createDataFrame([], rows.drop("_file").schema), head, sep)
    listed = lambda folder: spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    header = listed(head).agg(F.max("length")).first()[0]
    beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    files, root = FileSystem.from_uri(beside)
    files.create_dir(root)
    files.create_dir(f"{root}.open")
    written = listed(parts)
    if any_rows := "_file" in written.columns:  # a folder for each group
        part = F.struct(F.regexp_extract("path", "([^/]+/[^/]+)$", 1).alias("name"), F.col("length").alias("bytes"))
        groups = written.groupBy(F.col("_file").cast("string").alias("file")).agg(F.sort_array(F.collect_list(part)).alias("parts"))
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))  # a number of its own, so few bytes of names are not one task
        groups.repartition(tasks, "file").mapInArrow(_joined(parts, beside, header), TOLD).write.parquet(told)
    files.delete_dir(f"{root}.open")
    put_in_place(spark, beside, path)
    return spark.read.schema(TOLD).parquet(told) if any_rows else spark.createDataFrame([], TOLD)


TOLD = "file string, parts long, bytes long"


def _joined(parts: str, target: str, header: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Make one file of a group's parts, which all begin with a header of as many bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (source, at), (files, root) = FileSystem.from_uri(parts), FileSystem.from_uri(target)
        for batch in batches:
            for name, of in zip(batch.column("file").to_pylist(), batch.column("parts").to_pylist(), strict=True):
                name = name.replace("%", "%25").replace("/", "%2F").replace(":", "%3A")
                unnamed, size = f"{root}.open/{uuid.uuid4().hex}", 0
                with files.open_output_stream(unnamed) as out:
                    for i, part in enumerate(of):
                        with source.open_input_file(f"{at}/{part['name']}") as f:
                            f.seek(header if i else 0)
                            while block := f.read(BLOCK):
                                out.write(block)
                                size += len(block)
                files.move(unnamed, f"{root}/{name}")
                yield pa.record_batch([[name], pa.array([len(of)]), pa.array([size])], ["file", "parts", "bytes"])

    return run


def manifest(rows: DataFrame) -> DataFrame:
    """``file``, ``rows`` of a grouped export, before it is written."""
    return rows.groupBy(F.col("_file").alias("file")).agg(F.count(F.lit(1)).alias("rows"))


def written_manifest(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """``file``, ``path``, ``rows``, ``bytes`` of what an export has written."""
    read = spark.read.option("header", True).option("sep", sep).csv(path)
    return read.groupBy(F.col("_file").alias("file"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")).agg(F.count(F.lit(1)).alias("rows"))
