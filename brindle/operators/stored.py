"""Loads into tables with a ledger that touch as little as they must: upserts of stored files, increments, compaction."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.operators.loads import latest_per_key
from brindle.sources import ledger
from brindle.sources.ledger import File, Version
from brindle.sources.scratch import scratch_folder

#: Bits of a file's Bloom filter, in pieces of 4 KB, and bits set for a key.
BLOOM_BITS, PIECE_BITS, HASHES = 1 << 19, 1 << 15, 4
#: A batch of more keys is not looked up in the filters, where some key would seem to be in every file; it meets stored keys at once.
MOST_PROBED = 20_000
TARGET_BYTES = 256 << 20
#: Ends the names of folders whose files have an index.
INDEXED = "-indexed"


def _slots(keys: list[str]) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), *keys), F.lit(BLOOM_BITS)) for i in range(HASHES)]


def _add_indexed(df: DataFrame, path: str, keys: list[str]) -> dict[str, File]:
    """Add files, and to ``{path}/index`` for each bounds of its keys and a Bloom filter of them."""
    spark, files = df.sparkSession, ledger.add_files(df, path, INDEXED)
    for folder in {name.split("/")[0] for name in files}:
        written = spark.read.schema(df.schema).parquet(f"{path}/files/{folder}").select(F.concat(F.lit(f"{folder}/"), "_metadata.file_name").alias("file"), *keys)
        # least and greatest of each key by itself: they bound the keys together, and fixed-width ones are aggregated without a sort
        ends = written.groupBy("file").agg(*[F.min(k).alias(f"low{i}") for i, k in enumerate(keys)], *[F.max(k).alias(f"high{i}") for i, k in enumerate(keys)])
        ends = ends.select("file", *[F.struct(*[F.col(f"{end}{i}").alias(k) for i, k in enumerate(keys)]).alias(end) for end in ("low", "high")])
        # bitmaps are aggregated by a sort: of distinct slots, of which a file has BLOOM_BITS at most, not of all rows
        slot = written.select("file", F.explode(F.array(*_slots(keys))).alias("slot")).distinct()
        # the two functions count slots from 1
        pieces = slot.groupBy("file", F.bitmap_bucket_number(F.col("slot") + 1).alias("n")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("slot") + 1)).alias("bits"))
        bloom = pieces.groupBy("file").agg(F.collect_list(F.struct("n", "bits")).alias("bloom"))  # of BLOOM_BITS in all
        ends.join(bloom, "file").write.parquet(f"{path}/index/{folder}")
    return files


def files_with_keys(spark: SparkSession, path: str, at: Version, batch: DataFrame, keys: list[str]) -> list[str]:
    """Names of the table's files that hold a key of ``batch``.

    Files whose key range or Bloom filter excludes all of the batch's keys are not opened. Of the others, and of files without
    an index (those that ``ledger.append`` added), the key columns alone are read, and meet the batch's keys.
    """
    batch = batch.select(*keys).distinct()
    ends = batch.agg(F.min(F.struct(*keys)).alias("low"), F.max(F.struct(*keys)).alias("high"), F.count(F.lit(1)).alias("n")).first()
    if not ends.n or not at.files:
        return []
    names = [name for name in at.files if not name.split("/")[0].endswith(INDEXED)]
    if len(names) < len(at.files):
        names += _maybe_with_keys(spark, path, at, batch, keys, ends.n <= MOST_PROBED)
    if not names:
        return []
    stored = ledger.read(spark, path, at, names).select(*keys, F.regexp_extract("_metadata.file_path", "([^/]+/[^/]+)$", 1).alias("_file"))
    return [r._file for r in stored.join(batch, keys, "left_semi").select("_file").distinct().collect()]


def _maybe_with_keys(spark: SparkSession, path: str, at: Version, batch: DataFrame, keys: list[str], probed: bool) -> list[str]:
    """Names of the indexed files whose key range and, if ``probed``, Bloom filter do not exclude all keys of ``batch``."""
    folders = sorted({name.split("/")[0] for name in at.files})
    index = spark.read.parquet(*[f"{path}/index/{folder}" for folder in folders if folder.endswith(INDEXED)])
    bounds = batch.agg(F.min(F.struct(*keys)).alias("_low"), F.max(F.struct(*keys)).alias("_high"))
    maybe = index.join(F.broadcast(bounds), (F.col("low") <= F.col("_high")) & (F.col("high") >= F.col("_low")))  # one row
    if probed:
        slots = np.array([list(r) for r in batch.select(*_slots(keys)).collect()], np.int64)
        maybe = maybe.select("file", "bloom").mapInArrow(_probe(slots), "file string")
    return [r.file for r in maybe.select("file").collect() if r.file in at.files]


def _probe(slots: np.ndarray):
    """Files whose filter has all bits of one of the keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = []
            for pieces in batch.column("bloom"):
                bits = np.zeros(BLOOM_BITS // 8, np.uint8)
                for piece in pieces.as_py():
                    bits[(piece["n"] - 1) * PIECE_BITS // 8 : piece["n"] * PIECE_BITS // 8] = np.frombuffer(piece["bits"], np.uint8)
                hit.append(bool(((bits[slots >> 3] >> (slots & 7)) & 1).all(axis=1).any()))
            yield pa.RecordBatch.from_arrays([batch.column("file")], ["file"]).filter(pa.array(hit, pa.bool_()))

    return run


def _sized(df: DataFrame, size: int, target: int, by: list[str]) -> DataFrame:
    """Files of about ``target`` bytes in order of ``by``, so that each covers a range of its own."""
    return df.repartitionByRange(max(1, math.ceil(size / target)), *by).sortWithinPartitions(*by)


def create(df: DataFrame, path: str, keys: list[str], files: int) -> Version:
    """A table of as many files, in ranges of its keys, with their index; in place of one that is there."""
    spark = df.sparkSession
    schema = ledger.evolved(None, df.schema)
    added = _add_indexed(_sized(ledger.fitted(df, schema), files, 1, keys), path, keys)
    return ledger.commit(spark, path, ledger.version(spark, path), added, schema, {"keys": keys})


def upsert(batch: DataFrame, path: str, order_by: list[Column], target: int = TARGET_BYTES) -> Version:
    """The table with the batch's latest row for each of its keys; rows with a null in a key are left out.

    Only files that hold a key of the batch are written again, with the new rows, in one commit; all others stay. Columns
    may be new or missing, as in ``ledger.append``.
    """
    spark = batch.sparkSession
    base = ledger.version(spark, path)
    keys, schema = base.state["keys"], ledger.evolved(base.schema, batch.schema)
    scratch = scratch_folder(spark, "upsert")
    ledger.fitted(latest_per_key(batch.dropna(subset=keys), keys, order_by), schema).write.parquet(scratch)
    new = spark.read.parquet(scratch)
    touched = files_with_keys(spark, path, base, new, keys)
    stay = ledger.read(spark, path, base, touched).join(new.select(*keys), keys, "left_anti")
    rows = stay.unionByName(new, allowMissingColumns=True).select(*schema.names)
    size = sum(base.files[name].bytes for name in touched) + sum(f.bytes for f in base.files.values()) * new.count() // max(1, sum(f.rows for f in base.files.values()))
    added = _add_indexed(_sized(rows, size, target, keys), path, keys)
    files = {name: f for name, f in base.files.items() if name not in set(touched)}
    return ledger.commit(spark, path, base, {**files, **added}, schema, base.state)


def load_increment(source: DataFrame, path: str, cursor: str, keys: list[str], look_back: str | int | float | None = None) -> Version:
    """Append what the source has above the table's cursor, with the cursor's new value, in one commit.

    With ``look_back`` (an interval such as ``"3 days"`` for times, else a number) rows that far below the cursor are looked at
    again, and those whose keys (nulls are equal) the table has in that range are left out. Of rows with equal keys in a
    load, that of the greatest cursor is taken. A run that dies leaves data and cursor as they were. Rows with a null
    cursor are not loaded.
    """
    spark = source.sparkSession
    base = ledger.version(spark, path)
    last, rows = base.state.get("cursor"), source.where(F.col(cursor).isNotNull())
    if last is not None:
        start = F.lit(last).cast(source.schema[cursor].dataType)
        if look_back is None:
            rows = rows.where(F.col(cursor) > start)
        else:
            start = start - (F.expr(f"INTERVAL {look_back}") if isinstance(look_back, str) else F.lit(look_back))
            rows = rows.where(F.col(cursor) >= start)
            seen = ledger.read(spark, path, base).where(F.col(cursor) >= start).select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)])
            same = F.lit(True)
            for i, k in enumerate(keys):
                same = same & F.col(k).eqNullSafe(F.col(f"_{i}"))
            rows = rows.join(seen, same, "left_anti")
    rows = latest_per_key(rows, keys, [F.desc(cursor), F.xxhash64(*rows.columns)])
    schema = ledger.evolved(base.schema, rows.schema)
    added = ledger.add_files(ledger.fitted(rows, schema), path)
    at = Version(0, added, schema)
    highest = ledger.read(spark, path, at).agg(F.max(cursor).cast("string")).first()[0] if added else None
    known = [F.lit(x).cast(source.schema[cursor].dataType) for x in (last, highest) if x is not None]
    state = spark.range(1).select(F.greatest(*known, *known).cast("string")).first()[0] if known else None
    return ledger.commit(spark, path, base, {**base.files, **added}, schema, {**base.state, "cursor": state})


def packed(files: dict[str, File], small: int, most: int) -> list[list[str]]:
    """Names of files below ``small`` bytes in bins of at most ``most`` bytes (a single one may have more), first fit, largest first.

    A bin of one file is none: writing it again would win nothing.
    """
    bins: list[tuple[int, list[str]]] = []
    for name, f in sorted(((n, f) for n, f in files.items() if f.bytes < small), key=lambda x: (-x[1].bytes, x[0])):
        at = next((i for i, (size, _) in enumerate(bins) if size + f.bytes <= most), None)
        if at is None:
            bins.append((f.bytes, [name]))
        else:
            bins[at] = (bins[at][0] + f.bytes, [*bins[at][1], name])
    return [names for _, names in bins if len(names) > 1]


def compact(spark: SparkSession, path: str, small: int = TARGET_BYTES // 4, target: int = TARGET_BYTES, bin_bytes: int = 64 * TARGET_BYTES, by: list[str] | None = None) -> Version:
    """Write the table's small files again as files of about ``target`` bytes, in ranges of ``by`` (its keys unless given).

    Each bin of small files is one commit, so a run that dies keeps the bins that are done; files of ``small`` bytes and
    more stay as they are. The ledger knows all sizes, so nothing is read to choose.
    """
    at = ledger.version(spark, path)
    keys = at.state.get("keys")
    for names in packed(at.files, small, bin_bytes):
        rows, size = ledger.read(spark, path, at, names), sum(at.files[n].bytes for n in names)
        rows = _sized(rows, size, target, by or keys) if by or keys else rows.repartition(max(1, math.ceil(size / target)))
        added = _add_indexed(rows, path, keys) if keys else ledger.add_files(rows, path)
        files = {name: f for name, f in at.files.items() if name not in set(names)}
        at = ledger.commit(spark, path, at, {**files, **added}, at.schema, at.state)
    return at


def health(spark: SparkSession, paths: dict[str, str], small: int = TARGET_BYTES // 4) -> DataFrame:
    """Per named table what its ledger says: ``relname``, ``n_files``, ``n_small``, ``n_rows``, ``n_bytes``, ``version``."""
    rows = []
    for name, path in paths.items():  # a list of tables, not data
        at = ledger.version(spark, path)
        rows.append((name, len(at.files), sum(f.bytes < small for f in at.files.values()), sum(f.rows for f in at.files.values()), sum(f.bytes for f in at.files.values()), at.number))
    return spark.createDataFrame(rows, "relname string, n_files long, n_small long, n_rows long, n_bytes long, version long")


def maintain(spark: SparkSession, paths: dict[str, str], most_small: int = 1, small: int = TARGET_BYTES // 4, target: int = TARGET_BYTES) -> list[str]:
    """Compact the tables with more than ``most_small`` small files, those with the most first; their names."""
    sick = health(spark, paths, small).where(F.col("n_small") > most_small).orderBy(F.desc("n_small"), "relname")
    done = [r.relname for r in sick.select("relname").collect()]
    for name in done:
        compact(spark, paths[name], small, target)
    return done
