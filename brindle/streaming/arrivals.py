"""File-arrival streams: each new file is processed once and logged."""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from brindle.sources import ledger


def file_stream(spark: SparkSession, path: str, schema: StructType | str, kind: str = "csv", files_at_once: int | None = None, **options) -> DataFrame:
    """A stream of the records of files as they arrive, with ``_key``, the file each came from."""
    reader = spark.readStream.schema(schema).options(**options)
    if files_at_once:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    return reader.format(kind).load(path).withColumn("_key", F.col("_metadata.file_path"))


#: Gets a batch's records, the stream's id (as its checkpoint has it) and the batch's number.
Write = Callable[[DataFrame, str, int], object]


def into(path: str) -> Write:
    """A sink that adds each batch to a table with a ledger exactly once, however often the batch is run."""
    return lambda records, stream, number: ledger.append_once(records, path, stream, number)


def process_files(stream: DataFrame, write: Write, log: str, checkpoint: str, strict: bool = False, poll_seconds: int | None = None) -> StreamingQuery:
    """Start to process a file stream: ``write`` gets each batch's records, ``log`` a Parquet row per file.

    The checkpoint lets no file through twice. A batch that is run again after a crash has the same files, stream and
    number: it writes its own log folder again, and a sink that knows the number (``into``) adds nothing. The log has
    ``key``, ``status`` and ``batch_id``. With ``strict`` a file whose key is not above all keys of earlier batches is logged as
    ``late`` and its records left out. With ``poll_seconds`` the query goes on, else it ends with the files that are there.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        late = F.lit(False)
        if strict:
            known = seen_before(spark, log, number)
            late = F.col("_key") <= F.lit(known) if known else late
        write(batch.where(~late).drop("_key"), spark.sparkContext.getLocalProperty("sql.streaming.queryId"), number)
        status = F.when(late, "late").otherwise("processed")
        rows = batch.select(F.col("_key").alias("key"), status.alias("status"), F.lit(number).cast("long").alias("batch_id")).distinct()
        rows.write.mode("overwrite").parquet(f"{log}/batch={number}")
        batch.unpersist()

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=f"{poll_seconds} seconds") if poll_seconds else writer.trigger(availableNow=True)
    return writer.start()


class _Polls(StreamingQueryListener):
    """Counts one query's polls, with and without files, and tells when it has had enough of them."""

    def __init__(self, most: int, stop_at_first: bool):
        self.most, self.stop_at_first = most, stop_at_first
        self.query, self.polls, self.batches = None, 0, set()
        self.enough = threading.Event()

    def _polled(self, query: str) -> bool:
        if self.query is None or query != self.query or self.enough.is_set():
            return False
        self.polls += 1
        return True

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if self._polled(str(event.progress.runId)):
            if event.progress.numInputRows > 0:
                self.batches.add(event.progress.batchId)
            if self.polls >= self.most or (self.stop_at_first and self.batches):
                self.enough.set()

    def onQueryIdle(self, event) -> None:
        if self._polled(str(event.runId)) and self.polls >= self.most:
            self.enough.set()

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.query:
            self.enough.set()


@dataclass(frozen=True)
class Polled:
    polls: int
    batches: int


def poll_files(stream: DataFrame, write: Write, log: str, checkpoint: str, poll_seconds: int = 60, most_polls: int = 60, stop_at_first: bool = True, strict: bool = False) -> Polled:
    """Look for files every ``poll_seconds``, at most ``most_polls`` times, and with ``stop_at_first`` only until some have been
    processed; how often it looked and how many batches had records.

    One query runs all the while, so its state is set up once. A listener counts its polls, and this thread stops it. What
    a stop cuts short is run again by the next call, as the checkpoint and the sink say (``process_files``).
    """
    spark = stream.sparkSession
    seen, idle = _Polls(most_polls, stop_at_first), "spark.sql.streaming.noDataProgressEventInterval"
    before = spark.conf.get(idle)
    spark.streams.addListener(seen)
    spark.conf.set(idle, "0")  # else polls without files are told every ten seconds at most
    try:
        query = process_files(stream, write, log, checkpoint, strict, poll_seconds)
        seen.query = str(query.runId)
        while query.isActive and not seen.enough.wait(0.1):
            pass
        query.stop()
        if query.exception():
            raise query.exception()
    finally:
        spark.conf.set(idle, before)
        spark.streams.removeListener(seen)
    return Polled(seen.polls, len(seen.batches))


LOG = "key string, status string, batch_id long"


def read_log(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.schema(LOG).option("recursiveFileLookup", True).parquet(log)


def seen_before(spark: SparkSession, log: str, number: int) -> str | None:
    """The greatest key of the batches before ``number``."""
    if number == 0:
        return None
    return read_log(spark, log).where(F.col("batch_id") < number).agg(F.max("key")).first()[0]
