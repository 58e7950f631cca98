"""Line dedup with DataFrame functions alone: hashes travel, texts stay.

Every line becomes a 128-bit hash of its key with its document and position. The hashes are range-partitioned with a
secondary sort by document and position and streamed: each document's first occurrence of a key is told by looking at
the row before. A key is cut into slices by document, so a line that stands in a third of all documents is streamed
by many tasks; the slices' counts and first occurrences are then put together per key. What comes back is a
run-length bitmap of kept lines for each document that loses some, not text.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.common import packed, staged

BLANK = " \t\n\x0b\f\r"


def lines_of(text: Column) -> Column:
    """The lines; null and empty are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """Blanks stripped at both ends, A-Z lower-cased."""
    return F.translate(F.trim(line, F.lit(BLANK)), string.ascii_uppercase, string.ascii_lowercase)


def text_mark(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keep_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep: str = "none", id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document that loses lines: ``id``, ``mark`` (a hash of its text), ``n_dropped``, ``dropped``.

    ``dropped`` lists the runs of dropped lines, ``array<struct<start,end>>``, end exclusive, from 0. Keys of at least
    ``min_chars`` characters found in at least ``min_docs`` documents lose all their lines (``keep="none"``) or all but
    the first by document id, mark and position (``keep="first"``). Documents are told by their ids: rows of one id count
    as one document, however often they are repeated and whatever their texts, and each text loses its own lines; a null
    id is an id like any other, first in order. Texts are split whole, however long. An empty table gives no rows.
    """
    spark = docs.sparkSession
    lines = docs.select(F.col(id).alias("id"), text_mark(F.col(text)).alias("mark"), F.posexplode(lines_of(F.col(text))).alias("pos", "line"))
    lines = lines.withColumn("key", line_key(F.col("line"))).where(F.char_length("key") >= min_chars)
    hashed = staged(lines.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "id", "mark", "pos"), "line-hashes")

    # Range partitions of (hash, slice), sorted by document and position: the window needs no further exchange.
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = hashed.withColumn("slice", F.pmod(F.xxhash64("id", "mark"), F.lit(slices)))
    ranged = cut.repartitionByRange("h1", "h2", "slice")
    stream = Window.partitionBy("h1", "h2", "slice").orderBy("id", "mark", "pos")
    document = F.struct("id", "mark")
    seen = ranged.withColumn("again", F.lag(document).over(stream).eqNullSafe(document)).where(~F.col("again"))
    per_slice = seen.groupBy("h1", "h2", "slice").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "mark", "pos")).alias("first"))
    frequent = per_slice.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.min("first").alias("first")).where(F.col("n") >= min_docs)

    # Back to the lines slice by slice, so that a frequent key's lines stay dealt to many tasks.
    def back(keys: DataFrame) -> DataFrame:
        return cut.join(keys.select("h1", "h2", "first").join(per_slice.select("h1", "h2", "slice"), ["h1", "h2"]), ["h1", "h2", "slice"])

    hits = back(frequent)
    texts = hashed.groupBy("id").agg(F.min("mark").alias("x"), F.max("mark").alias("y"))
    if not texts.where(F.col("x") != F.col("y")).isEmpty():  # counts so far are of texts, at least as many as ids
        ids = hits.select("h1", "h2", "id").distinct().groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("ids")).where(F.col("ids") >= min_docs)
        hits = back(frequent.join(staged(ids.select("h1", "h2"), "frequent-keys"), ["h1", "h2"]))
    if keep == "first":
        hits = hits.where(~F.col("first").eqNullSafe(F.struct("id", "mark", "pos")))
    hits = hits.select("id", "mark", "pos").distinct()
    per_doc = Window.partitionBy("id", "mark").orderBy("pos")
    runs = hits.withColumn("run", F.col("pos") - F.row_number().over(per_doc)).groupBy("id", "mark", "run").agg(F.struct(F.min("pos").alias("start"), (F.max("pos") + 1).alias("end")).alias("one"))
    bitmaps = runs.groupBy("id", "mark").agg(F.sort_array(F.collect_list("one")).alias("dropped"))
    n = F.aggregate("dropped", F.lit(0).cast("long"), lambda total, r: total + r["end"] - r["start"])
    return bitmaps.select(F.col("id").alias(id), "mark", n.alias("n_dropped"), "dropped")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` with the kept lines as ``text``, and ``n_lines`` (before) and ``n_dropped``.

    A text that loses nothing stays as it is; one that loses all lines becomes empty; a null text becomes empty. Input
    columns named ``n_lines`` or ``n_dropped`` are replaced; all others stay, whatever their names. Rows that agree in id
    and text lose the same lines; texts of any length are read whole; an empty table gives an empty table.
    """
    own = [F.col("_row")[c].alias(c) for c in docs.columns if c not in (text, "n_lines", "n_dropped")]
    return _dropped(docs, bitmaps, id, text).select(*own, F.col("_kept").alias(text), "n_lines", "n_dropped")


def _dropped(docs: DataFrame, bitmaps: DataFrame, id: str, text: str) -> DataFrame:
    """``_row`` (all columns but the text), ``_kept``, ``n_lines``, ``n_dropped``."""
    marks = bitmaps.select(F.col(id).alias("_id"), F.col("mark").alias("_mark"), F.col("n_dropped").alias("_n"), F.col("dropped").alias("_runs"))
    docs = docs.select(packed(docs, text).alias("_row"), F.col(id).alias("_own"), F.col(text).alias("_text"))
    id, text = "_own", "_text"
    lines = lines_of(F.col(text))
    size = F.size(lines)
    # The kept runs lie between the dropped ones.
    begin = lambda i: F.when(i == 0, 0).otherwise(F.get(F.col("_runs"), i - 1)["end"])
    stop = lambda i: F.when(i == F.size("_runs"), size).otherwise(F.get(F.col("_runs"), i)["start"])
    parts = F.transform(F.sequence(F.lit(0), F.size("_runs")), lambda i: F.slice(lines, begin(i) + 1, stop(i) - begin(i)))
    kept = F.when(F.col("_runs").isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(F.array_join(F.flatten(parts), "\n"))
    joined = docs.join(marks, docs[id].eqNullSafe(marks["_id"]) & (text_mark(docs[text]) == marks["_mark"]), "left")
    return joined.select("_row", kept.alias("_kept"), size.cast("long").alias("n_lines"), F.coalesce(F.col("_n"), F.lit(0)).cast("long").alias("n_dropped"))


def dedup_lines(docs: DataFrame, **how) -> DataFrame:
    """``docs`` without the lines that ``keep_bitmaps`` drops; the columns stay as they are."""
    id, text = how.get("id", "doc_id"), how.get("text", "text")
    out = _dropped(docs, keep_bitmaps(docs, **how), id, text)
    return out.select(*[(F.col("_kept") if c == text else F.col("_row")[c]).alias(c) for c in docs.columns])
