"""A Python generator as a table: read by many tasks at once, or as a stream that goes on where it stopped."""

from __future__ import annotations

import glob
import importlib
import os
from collections.abc import Callable, Iterator

import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

NAME = "brindle_generator"


def _named(path: str) -> Callable:
    """The function ``module:name``."""
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


class Items(InputPartition):
    """The items from ``first`` up to ``last``."""

    def __init__(self, first: int, last: int):
        super().__init__((first, last))
        self.first, self.last = first, last


def shares(first: int, last: int, n: int) -> list[Items]:
    """Items cut into at most ``n`` runs of about equal length, none empty."""
    n = max(1, min(n, last - first))
    cuts = [first + (last - first) * i // n for i in range(n + 1)]
    return [Items(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


class _Made:
    """Options: ``make`` (``module:function`` of first item, last item and the options, that yields rows as tuples), ``size``
    (``module:function`` of the options: how many items there are now), ``tasks``, ``per_batch`` (items of a stream's batch)."""

    def __init__(self, options: dict):
        self.options = dict(options)
        self.tasks = int(self.options.get("tasks", 8))

    def size(self) -> int:
        return int(_named(self.options["size"])(self.options))

    def read(self, partition: Items) -> Iterator[tuple]:
        yield from _named(self.options["make"])(partition.first, partition.last, self.options)


class BatchReader(_Made, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        return shares(0, self.size(), self.tasks) or [Items(0, 0)]


class StreamReader(_Made, DataSourceStreamReader):
    """Offsets are numbers of items, so a query that is started again asks for those after its checkpoint alone."""

    def __init__(self, options: dict):
        super().__init__(options)
        self.at = 0

    def initialOffset(self) -> dict:
        return {"items": 0}

    def latestOffset(self) -> dict:
        size, step = self.size(), int(self.options.get("per_batch", 0))
        return {"items": min(size, self.at + step) if step else size}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.at = max(self.at, end["items"])
        return shares(start["items"], end["items"], self.tasks)

    def commit(self, end: dict) -> None:
        self.at = max(self.at, end["items"])


class GeneratorSource(DataSource):
    """Format ``brindle_generator``; the schema is the reader's."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return self.options["schema"]

    def reader(self, schema: StructType) -> BatchReader:
        return BatchReader(self.options)

    def streamReader(self, schema: StructType) -> StreamReader:
        return StreamReader(self.options)


def _options(schema: str, make: str, size: str, tasks: int, **options) -> dict:
    return {"schema": schema, "make": make, "size": size, "tasks": str(tasks), **{k: str(v) for k, v in options.items()}}


def read_generator(spark: SparkSession, schema: str, make: str, size: str, tasks: int = 8, **options) -> DataFrame:
    """A table of what a generator yields; ``tasks`` of them run at once, each over its share of the items."""
    spark.dataSource.register(GeneratorSource)
    return spark.read.format(NAME).options(**_options(schema, make, size, tasks, **options)).load()


def stream_generator(spark: SparkSession, schema: str, make: str, size: str, tasks: int = 8, **options) -> DataFrame:
    """The same as a stream: items that ``size`` tells of later are read later."""
    spark.dataSource.register(GeneratorSource)
    return spark.readStream.format(NAME).options(**_options(schema, make, size, tasks, **options)).load()


def _files(path: str) -> list[str]:
    return sorted(glob.glob(f"{path}/*.parquet")) if os.path.isdir(path) else [path]


def table_rows(options: dict) -> int:
    """``size`` for ``table_items``: rows of the Parquet table at ``path``, at most ``upto``, from its footers."""
    return min(sum(pq.read_metadata(f).num_rows for f in _files(options["path"])), int(options.get("upto", 1 << 62)))


def table_items(first: int, last: int, options: dict) -> Iterator[tuple]:
    """``make``: the rows of a Parquet table from ``first`` up to ``last``, as a paged service would give them; row groups
    that hold none of them are not read."""
    at = 0
    for name in _files(options["path"]):
        with pq.ParquetFile(name) as file:
            for g in range(file.num_row_groups):
                n = file.metadata.row_group(g).num_rows
                low, high = max(first - at, 0), min(last - at, n)
                if low < high:
                    rows = file.read_row_group(g, options["columns"].split(","), use_threads=False).slice(low, high - low)
                    yield from zip(*[c.to_pylist() for c in rows.columns], strict=True)
                at += n
