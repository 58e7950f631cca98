"""Loads with a write disposition, incremental extracts, versions of keys, comparison of relations.

Each load is a function of its inputs to the new content, so a rerun gives the same; ``write_*`` put it in place.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, NullType, StringType, StructField, StructType

from brindle.sources.ledger import absent, fitted
from brindle.sources.scratch import scratch_folder


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[Column]) -> DataFrame:
    """One row per key, the first by ``order_by``, which should order a key's rows wholly."""
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_n", number).where("_n = 1").drop("_n")


def numbered(df: DataFrame, partition: list[str], order_by: list[Column], name: str = "sequence") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*partition).orderBy(*order_by)))


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Both by name: a column that one side lacks is null there; numbers and times widen to hold both.

    Texts do not meet other types: ``TypeError`` up front, as a cast would fail only when rows are read.
    """
    kinds = {f.name: f.dataType for f in target.schema}
    for f in batch.schema:
        both = {kinds.get(f.name, f.dataType), f.dataType} - {NullType()}
        if len(both) > 1 and any(isinstance(kind, StringType) for kind in both):
            raise TypeError(f"column {f.name} holds {kinds[f.name].simpleString()}, not {f.dataType.simpleString()}")
    return target.unionByName(batch, allowMissingColumns=True)


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], order_by: list[Column]) -> DataFrame:
    """``target`` with the batch's latest row for each of its keys; batch rows with a null key are left out.

    A column that only the batch has comes last, null in the rows that stay; one that the batch lacks is null in its rows.
    """
    known = batch.where(F.coalesce(*[F.col(k).isNull() for k in keys]) == F.lit(False)) if len(keys) == 1 else batch.dropna(subset=keys)
    new = latest_per_key(known, keys, order_by)
    return target.join(new.select(*keys), keys, "left_anti").select(*target.columns).unionByName(new, allowMissingColumns=True)


def incremental(df: DataFrame, cursor: str, last) -> DataFrame:
    """Rows above the last value of the cursor column; all rows if there is none yet."""
    return df if last is None else df.where(F.col(cursor) > F.lit(last).cast(df.schema[cursor].dataType))


def next_state(df: DataFrame, cursor: str, last=None):
    """The greatest value of the cursor column, or the old one if there is none."""
    found = df.agg(F.max(cursor)).first()[0]
    return last if found is None else found


def reload_batch(target: DataFrame, batch: DataFrame, run_column: str, run_id) -> DataFrame:
    """``target`` with one run's rows replaced; rows without a run stay."""
    return target.where(~F.col(run_column).eqNullSafe(F.lit(run_id))).unionByName(batch)


def snapshot(history: DataFrame, key: str, updated_at: str, tie: str | None = None) -> DataFrame:
    """Versions with ``valid_from``, ``valid_to`` (null for the current one) and ``is_current``."""
    order = Window.partitionBy(key).orderBy(*[c for c in (updated_at, tie) if c])
    out = history.withColumn("valid_from", F.col(updated_at)).withColumn("valid_to", F.lead(updated_at).over(order))
    return out.withColumn("is_current", F.col("valid_to").isNull() & F.lead(F.lit(1)).over(order).isNull())


def snapshot_merge(versions: DataFrame, batch: DataFrame, key: str, updated_at: str, tie: str | None = None) -> DataFrame:
    """The snapshot after a batch; repeated versions count once.

    Intervals are made again for the keys of the batch alone, all others keep theirs.
    """
    own = [c for c in versions.columns if c not in ("valid_from", "valid_to", "is_current")]
    keys = batch.select(F.col(key).alias("_key")).distinct()
    of_batch = F.col(key).eqNullSafe(F.col("_key"))
    touched = versions.join(keys, of_batch, "left_semi").select(*own).unionByName(batch.select(*own)).distinct()
    return versions.join(keys, of_batch, "left_anti").unionByName(snapshot(touched, key, updated_at, tie))


def snapshot_in_ranges(history: DataFrame, key: str, updated_at: str, tie: str | None = None) -> DataFrame:
    """``snapshot`` for histories in which one key may have most rows.

    Rows are sorted in ranges of key and time, so a key spans as many tasks as its rows need. Within a range the next version
    is the row after; the last one of a key in a range takes the first of its next range, from a table with a row for each
    key and range.
    """
    spark, order = history.sparkSession, [c for c in (updated_at, tie) if c]
    marked = _kept(history.withColumn("_row", F.monotonically_increasing_id()), "versions")  # equal rows are told apart
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = _kept(marked.repartitionByRange(n, key, *order, "_row").withColumn("_part", F.spark_partition_id()), "version-ranges")
    firsts = ranged.groupBy("_part", key).agg(F.min(F.struct(*order)).alias("_first"))
    later = F.lead("_first").over(Window.partitionBy(key).orderBy("_part"))
    firsts = firsts.select(F.col("_part").alias("_p"), F.col(key).alias("_k"), later.alias("_next"))
    own = Window.partitionBy("_part", key).orderBy(*order, "_row")
    rows = ranged.withColumns({"_to": F.lead(updated_at).over(own), "_more": F.lead(F.lit(1)).over(own)})
    rows = rows.join(firsts, (F.col("_part") == F.col("_p")) & F.col(key).eqNullSafe(F.col("_k")))
    valid_to = F.when(F.col("_more").isNotNull(), F.col("_to")).otherwise(F.col("_next")[updated_at])
    current = F.col("_more").isNull() & F.col("_next").isNull()
    return rows.select(*[F.col(f"`{c}`") for c in history.columns], F.col(updated_at).alias("valid_from"), valid_to.alias("valid_to"), current.alias("is_current"))


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one of two relations has, as often as it has them more, with ``in_a`` and ``in_b``."""
    b = b.select(*a.columns)
    side = lambda df, x: df.withColumns({"in_a": F.lit(x), "in_b": F.lit(not x)})
    return side(a.exceptAll(b), True).unionByName(side(b.exceptAll(a), False))


def differing(a: DataFrame, b: DataFrame, leaves: int = 1 << 16, levels: int = 2) -> tuple[DataFrame, DataFrame]:
    """Rows of two relations that share a leaf of their hash trees with a row that only one of them has, or has more often.

    Rows are dealt to ``leaves`` by hash; each side's number of rows and two sums of their hashes are made for every leaf, and
    leaves that agree are left out. Each level deals what is left anew, by another hash. What a level shuffles is a row for
    each leaf and task; what it broadcasts is the numbers of ``leaves`` leaves at most. Two different leaves agree with a
    chance of about one in 2 ** 128.
    """
    b = b.select(*a.columns)
    rows = [part for f in a.schema for part in _hashed(f)]
    for level in range(levels):
        leaf = F.pmod(F.xxhash64(F.lit(level), *rows), F.lit(leaves))
        sums = [F.sum(F.xxhash64(F.lit(-1 - i), *rows).cast("decimal(38,0)")).alias(f"s{i}") for i in range(2)]
        told = [df.groupBy(leaf.alias("leaf")).agg(F.count(F.lit(1)).alias("n"), *sums).withColumn("same", F.struct("n", "s0", "s1")).select("leaf", "same") for df in (a, b)]
        both = told[0].join(told[1].withColumnRenamed("same", "other"), "leaf", "full").where(~F.col("same").eqNullSafe(F.col("other")))
        open_leaves = _kept(both.select(F.col("leaf").alias("_leaf")), "leaves")
        a, b = (df.join(F.broadcast(open_leaves), leaf == F.col("_leaf"), "left_semi") for df in (a, b))
    return a, b


def _hashed(f: StructField) -> list[Column]:
    """What to hash of a column so that different values differ: hashes pass over nulls, alone and in lists."""
    column = F.col(f"`{f.name}`")
    if isinstance(f.dataType, (ArrayType, MapType, StructType)):
        return [F.to_json(F.struct(column.alias("c")), {"ignoreNullFields": "false"})]
    return [column, column.isNull()]


def compare_by_checksums(a: DataFrame, b: DataFrame, leaves: int = 1 << 16, levels: int = 2) -> DataFrame:
    """The rows of ``compare``; only rows of ``differing`` leaves are shuffled, so the shuffle grows with the difference."""
    return compare(*differing(a, b, leaves, levels))


def write_replaced(df: DataFrame, path: str) -> None:
    """Put ``df`` in place of what ``path`` holds, even if ``df`` reads it.

    It is written beside ``path``; then the old content is renamed, the new one takes its name, and the old one goes. A
    crash at any point leaves one of both whole, the old one as ``{path}.replaced-…`` if between the two renames.
    """
    spark = df.sparkSession
    beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    df.write.parquet(beside)
    put_in_place(spark, beside, path)


def put_in_place(spark: SparkSession, beside: str, path: str) -> None:
    """Give the folder ``beside`` the name ``path``, whatever had it before."""
    jvm = spark.sparkContext._jvm
    old, new = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(beside)
    aside = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.replaced-{uuid.uuid4().hex}")
    fs = new.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = fs.exists(old)
    if there and not fs.rename(old, aside):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, old):
        if there:
            fs.rename(aside, old)
        raise OSError(f"cannot move {beside} to {path}")
    if there:
        fs.delete(aside, True)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """A table whose files came with different columns: all of them, null where a file has none.

    Its schema is read from beside the files (``write_appended`` keeps it there), or of a table without one from all files.
    """
    stored = _stored_schema(spark, path)
    return spark.read.schema(stored).parquet(path) if stored else spark.read.option("mergeSchema", True).parquet(path)


def _stored_schema(spark: SparkSession, path: str) -> StructType | None:
    try:
        return StructType.fromJson(json.loads(spark.read.text(f"{path.rstrip('/')}/_schema").first()[0]))
    except AnalysisException as error:
        if not absent(error):
            raise
        return None


def write_appended(df: DataFrame, path: str) -> None:
    """Append files. Columns that are there already take the type that they have, new ones come along (``read_evolved``).

    The table's schema is one small file in ``{path}/_schema``, which readers of the folder pass over; only for a folder
    without one are the footers of its files read, once. It is written before the data: a crash between the two leaves a
    column that is null everywhere.
    """
    spark = df.sparkSession
    stored = _stored_schema(spark, path)
    known = stored
    if known is None:
        try:
            known = read_evolved(spark, path).schema
        except AnalysisException as error:
            if not absent(error):
                raise
            known = df.schema
    names = set(known.names)
    schema = StructType([*known, *[f for f in df.schema if f.name not in names]])
    if schema != stored:
        spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path.rstrip('/')}/_schema")
    fitted(df, schema).write.mode("append").parquet(path)


def write_run(df: DataFrame, path: str, run_column: str) -> None:
    """Replace only the partitions of the runs that ``df`` holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(run_column).parquet(path)


def load(resources: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Replace a folder's tables by the resources of the same names, each in one move; where each lies."""
    out = {name: f"{folder}/{name}" for name in resources}
    for name, df in resources.items():
        write_replaced(df, out[name])
    return out


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def materialize_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """A catalog table, in the warehouse or at a path of its own."""
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)
