"""Benchmark decontamination by winnowing: which words of a document lie in a passage of a benchmark item.

A passage of ``L`` words has ``w = L - k + 1`` runs of ``k`` words, and its fingerprint is the least hash among them. That
is winnowing: the selected fingerprints of a text are the minima of every ``w`` runs in a row, so texts that share ``L``
words in a row always share the fingerprint of that span. Documents' fingerprints are first looked up in a bitmap of the
items' ones, whose size is bounded (``MOST_BITS``); those that pass are extended to the passages around them, and these meet
the items' passages in a join on fingerprint and 128-bit hash of the whole passage. The passages of items are distinct there,
so the join makes no pairs, and a passage that a third of all documents have is dealt to many tasks.

Texts never move: a task sends the extended passages of the documents that it reads, nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm import textkernel as k
from brindle.llm.common import join_by_slices, slices, staged, utf8

#: Bytes that stand between words: all of ASCII but digits and letters.
BETWEEN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: Words that are hashed at a time, however long a text is.
BLOCK_WORDS = 1 << 16
#: Bits of the bitmap of fingerprints: sixteen for each one, from 8 KB to 16 MB. Beyond that more passages are extended
#: in vain; results stay the same.
LEAST_BITS, MOST_BITS = 16, 27
SECOND = k.U(0xC2B2AE3D27D4EB4F)
PASSAGE = ["len", "fp", "h1", "h2"]


def run_length(length: int) -> int:
    """Words of a run (``k``) for passages of ``length`` words; ``length - k + 1`` runs make a window of winnowing."""
    return (length + 1) // 2


def least_of(h: np.ndarray, n: int) -> np.ndarray:
    """The minimum of every ``n`` values in a row."""
    m, have = h, 1
    while have < n:
        step = min(have, n - have)
        m = np.minimum(m[: len(m) - step], m[step:])
        have += step
    return m


def rolled(h: np.ndarray, n: int, base: np.uint64) -> np.ndarray:
    """Hashes of every ``n`` values in a row."""
    m = len(h) - n + 1
    out = h[:m].copy()
    for i in range(1, n):
        out *= base
        out += h[i : i + m]
    return k.mix(out)


class Words:
    """The words of a batch of texts."""

    def __init__(self, texts: list[bytes]):
        buf, self.at = k.join(texts)
        self.buf = k.LOWER[buf]
        self.start, self.end = k.words(self.buf, BETWEEN)
        self.first = np.searchsorted(self.start, self.at)
        self.count = np.diff(self.first)

    def blocks(self, overlap: int) -> Iterator[tuple[int, int, int, k.Substrings, np.ndarray, np.ndarray]]:
        """``(a, b, z)``: passages start at words ``a`` to ``b`` and end before ``z``; with the hashes of words ``a`` to ``z``."""
        for a in range(0, len(self.start), BLOCK_WORDS):
            b = min(a + BLOCK_WORDS, len(self.start))
            z = min(b + overlap, len(self.start))
            base = self.start[a]
            part = self.buf[base : self.end[z - 1] + 1]
            yield a, b, z, part, self.start[a:z] - base, self.end[a:z] - base

    def passages(self, length: int, bits: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """First word (of the batch), fingerprint and two hashes of the passages of ``length`` words within one text whose
        fingerprint ``bits`` may hold; all passages without ``bits``."""
        n = run_length(length)
        text = np.repeat(np.arange(len(self.count)), self.count)
        for a, b, z, part, start, end in self.blocks(length - 1):
            if z - a < length:
                continue
            h = k.Substrings(part).hashes(start, end)
            fp = least_of(rolled(h, n, k.U(k.BASE)), length - n + 1)[: b - a]
            at = text[a : a + len(fp)] == text[a + length - 1 : a + length - 1 + len(fp)]
            if bits is not None:  # a fingerprint is looked up once for all passages in a row that have it
                new = np.flatnonzero(np.concatenate([[True], fp[1:] != fp[:-1]]))
                hit = holds(bits, fp[new])
                if not hit.any():
                    continue
                at &= np.repeat(hit, np.diff(np.append(new, len(fp))))
            at = np.flatnonzero(at)
            if len(at):
                other = k.Substrings(part, 1).hashes(start, end)
                yield a + at, fp[at], rolled(h, length, SECOND)[at], rolled(other, length, k.U(k.BASE))[at]


def holds(bits: np.ndarray, fp: np.ndarray) -> np.ndarray:
    slot = fp & k.U(len(bits) * 8 - 1)
    return (bits[(slot >> k.U(3)).astype(np.int64)] >> (slot & k.U(7)).astype(np.uint8)) & 1 > 0


def _sent(texts: list[bytes], lengths: list[int] | None, most: int, bits: np.ndarray | None) -> Iterator[tuple[np.ndarray, list[np.ndarray | None]]]:
    """Which text, and its number of words alone or first word, length, fingerprint and hashes of a passage of it; with
    no ``lengths`` those of its own length, ``most`` at most."""
    for i, j in slices([len(t) for t in texts]):
        w = Words(texts[i:j])
        yield np.arange(i, j), [w.count, *[None] * 5]
        own = np.minimum(w.count, most)
        for length in sorted(set(own.tolist()) - {0}) if lengths is None else lengths:
            for at, fp, h1, h2 in w.passages(length, bits):
                text = np.searchsorted(w.first, at, "right") - 1
                if lengths is None:
                    mine = own[text] == length
                    at, fp, h1, h2, text = at[mine], fp[mine], h1[mine], h2[mine], text[mine]
                yield i + text, [None, at - w.first[text], np.full(len(at), length), *[x.view(np.int64) for x in (fp, h1, h2)]]


SENT = ["n_words", "start", *PASSAGE]


def _passages(df: DataFrame, id: str, text: str, lengths: list[int] | None, most: int, bits: np.ndarray | None, name: str) -> DataFrame:
    """``id``, ``row`` (a number) and either ``n_words`` or a passage, as ``_sent`` gives them; staged, so a row keeps its number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for which, columns in _sent(utf8(batch.column("text")), lengths, most, bits):
                at = pa.array(which)
                arrays = [pa.nulls(len(at), pa.int64()) if c is None else pa.array(c, pa.int64()) for c in columns]
                yield pa.record_batch([batch.column("id").take(at), batch.column("row").take(at), *arrays], ["id", "row", *SENT])

    rows = df.select(F.col(id).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    kind = df.schema[id].dataType.simpleString()
    return staged(rows.mapInArrow(run, f"id {kind}, row long, " + ", ".join(f"{c} long" for c in SENT)), name)


def _bitmap(passages: DataFrame) -> np.ndarray:
    """The bitmap of the passages' fingerprints, put together by 4 KB pieces."""
    prints = passages.select("fp").distinct()
    size = max(LEAST_BITS, min(MOST_BITS, (16 * prints.count()).bit_length()))
    slot = F.col("fp").bitwiseAND((1 << size) - 1) + 1  # the functions below count from 1
    pieces = prints.groupBy(F.bitmap_bucket_number(slot).alias("n")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    bits = np.zeros(1 << (size - 3), np.uint8)
    for n, piece in pieces.collect():  # 2 ** MOST_BITS bits in all
        bits[(n - 1) * 4096 : n * 4096] = np.frombuffer(bytes(piece), np.uint8)
    return bits


def item_passages(items: DataFrame, window: int = 10, id: str = "item_id", text: str = "text") -> DataFrame:
    """``id`` and passage (``len``, ``fp``, ``h1``, ``h2``) of every ``window`` words in a row of an item; an item of fewer
    words is one passage, one without words none. Distinct; staged."""
    found = _passages(items, id, text, None, window, None, "items")
    return staged(found.where("start IS NOT NULL").select("id", *PASSAGE).distinct(), "item-passages")


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_words``, ``n_hit`` (words inside a passage of an item), ``items`` (ids of
    the items with passages there, as sorted strings) and ``spans`` (maximal runs of hit words, end exclusive).

    Words are runs of digits, of letters A-Z in any case, and of all that is not ASCII. Null and empty texts have no words.
    A text of any length is read whole, some words at a time. Rows are judged one by one, so a repeated row or id gives a
    row each. Items that repeat an id are one item; one with a null id has passages, but no name to list. An empty table of
    documents gives no rows, one of items hits nowhere. Other columns are not read.
    """
    passages = item_passages(items, window, item_id, item_text)
    lengths = sorted(r.len for r in passages.select("len").distinct().collect())  # of 1 to window
    sent = _passages(docs, id, text, lengths, window, _bitmap(passages), "passages")
    distinct = passages.select(*PASSAGE).distinct()
    hits = staged(join_by_slices(sent.where("start IS NOT NULL").drop("id", "n_words"), distinct, PASSAGE, "row").select("row", "start", *PASSAGE), "passage-hits")
    told = _spans(hits).join(_named(hits, passages), "row", "left")
    out = sent.where("start IS NULL").select("row", "id", "n_words").join(told, "row", "left")
    no_spans, no_items = F.expr("CAST(array() AS array<struct<start: bigint, end: bigint>>)"), F.expr("CAST(array() AS array<string>)")
    return out.select(F.col("id").alias(id), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", no_items).alias("items"), F.coalesce("spans", no_spans).alias("spans"))


def _spans(hits: DataFrame) -> DataFrame:
    """``row``, ``n_hit``, ``spans``: overlapping and touching passages of a document put together."""
    end = F.col("start") + F.col("len")
    order = Window.partitionBy("row").orderBy("start", "len")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = hits.groupBy("row", "start").agg(F.max("len").alias("len")).withColumn("end", end)
    runs = runs.withColumn("new", F.when(F.col("start") <= before, 0).otherwise(1)).withColumn("run", F.sum("new").over(order))
    spans = runs.groupBy("row", "run").agg(F.struct(F.min("start").alias("start"), F.max("end").alias("end")).alias("span"))
    words = F.sum(F.col("span")["end"] - F.col("span")["start"])
    return spans.groupBy("row").agg(words.alias("n_hit"), F.sort_array(F.collect_list("span")).alias("spans"))


def _named(hits: DataFrame, passages: DataFrame) -> DataFrame:
    """``row``, ``items``. Documents with the same set of passages (told by 128 bits) share one look-up of their items."""
    sets = hits.select("row", *PASSAGE).distinct().groupBy("row").agg(F.bit_xor(F.xxhash64(*PASSAGE)).alias("s1"), F.bit_xor(F.xxhash64(F.lit(1), *PASSAGE)).alias("s2"))
    sets = staged(sets, "passage-sets")
    one = sets.groupBy("s1", "s2").agg(F.min("row").alias("row"))
    named = hits.join(one, "row").select("s1", "s2", *PASSAGE).distinct().join(passages.where("id IS NOT NULL"), PASSAGE)
    items = named.select("s1", "s2", F.col("id").cast("string").alias("id")).distinct().groupBy("s1", "s2").agg(F.sort_array(F.collect_list("id")).alias("items"))
    return join_by_slices(sets, items, ["s1", "s2"], "row").select("row", "items")
