"""Quality by language-model perplexity: interpolated modified Kneser-Ney over characters, at any size of the model.

N-grams are strings of ``ORDER`` characters as they stand, so every script keeps its distinctions and a model grows
with the corpus. A task packs the documents that it reads into chunks of one language. A chunk sends each n-gram that
it holds once, with how often its trusted documents hold it; counts, continuation counts, discounts and interpolation are
joins and sums of shards of (language, n-gram). The n-grams that any chunk holds meet the model in joins, order by
order, and their logarithms go back to the chunks, which add them up for each document. Chunks lie in buckets, so that
texts never move: what a chunk is told comes to its bucket. Nothing is gathered on the driver.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from brindle.llm.common import bucketed, join_by_slices, slices, staged

ORDER = 4
#: What stands before a text: a code point that Unicode assigns to no character.
EDGE = "\uffff"
#: Below the single characters all code points are alike.
POINTS = 0x110000
#: Characters of a chunk, of the parts of a long text, and of what a kernel takes at a time.
CHUNK, PART, SECTION = 8 << 20, 1 << 20, 1 << 20
#: One trusted document in so many is not counted: these set the limit.
HELD_OUT = 2
#: Held-out documents of a language that weigh as much as all languages together.
DRAWN = 100
#: A table with a row for each language is broadcast if it has at most so many; an unclean column may name any number.
MOST_LANGUAGES = 10_000


def name_of(lang: Column) -> Column:
    """A language's name that is never null."""
    return F.coalesce(F.concat(F.lit("="), lang), F.lit("-"))


def held_out(id: Column) -> Column:
    return F.pmod(F.xxhash64(id), F.lit(HELD_OUT)) == 0


def _zip(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(raw)


def _unzip(b: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(b)


def _pack(kind: pa.DataType):
    """A task's documents by language, in chunks; a text longer than ``PART`` in several parts, each after its context."""
    types = [pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(kind), pa.list_(pa.int32()), pa.binary()]

    def row(name: str, held: list) -> pa.RecordBatch:
        uids, ids, parts = zip(*held, strict=True)
        values = [secrets.randbits(62), name, uids, ids, [len(p) for p in parts], _zip("".join(parts).encode())]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, types, strict=True)], names=["chunk", "name", "uids", "ids", "sizes", "raw"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list] = {}
        size: dict[str, int] = {}
        for batch in batches:
            for uid, id, text, name in zip(*[batch.column(c).to_pylist() for c in ("uid", "id", "text", "name")], strict=True):
                text = text or ""
                for at in range(0, max(len(text), 1), PART):
                    part = (text[at - ORDER + 1 : at] if at else EDGE * (ORDER - 1)) + text[at : at + PART]
                    waiting.setdefault(name, []).append((uid, id, part))
                    size[name] = size.get(name, 0) + len(part)
                    if sum(size.values()) >= 2 * CHUNK or size[name] >= CHUNK:
                        most = max(size, key=size.get)
                        yield row(most, waiting.pop(most))
                        size.pop(most)
        for name, held in waiting.items():
            yield row(name, held)

    return run


class Block:
    """Parts of texts in a row with at most 65536 different characters, and their distinct n-grams in order."""

    def __init__(self, parts: list[str], alphabet: np.ndarray):
        self.parts, self.alphabet = parts, alphabet
        self.code = np.zeros(POINTS, np.uint64)
        self.code[alphabet] = np.arange(len(alphabet), dtype=np.uint64)
        self.grams = np.unique(np.concatenate([np.unique(names) for _, names, _ in self.sections()]))

    def sections(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """The first part of a section, its n-grams (the ``ORDER`` codes at 16 bits each), and the part of each."""
        for i, j in slices([len(p) for p in self.parts], SECTION):
            code = self.code[points("".join(self.parts[i:j]))]
            name = code[: max(len(code) - ORDER + 1, 0)].copy()
            for n in range(1, ORDER):
                name <<= np.uint64(16)
                name |= code[n : len(code) - ORDER + 1 + n]
            sizes = np.array([len(p) - ORDER + 1 for p in self.parts[i:j]])
            part = np.repeat(np.arange(j - i), sizes)
            yield i, name[np.arange(len(part)) + part * (ORDER - 1)], part

    def strings(self) -> list[str]:
        shifts = np.arange(ORDER - 1, -1, -1, dtype=np.uint64) * np.uint64(16)
        at = (self.grams[:, None] >> shifts) & np.uint64(0xFFFF)
        text = self.alphabet[at.astype(np.int64)].astype(np.uint32).tobytes().decode("utf-32-le")
        return [text[i : i + ORDER] for i in range(0, len(text), ORDER)]


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def blocks_of(sizes: list[int], raw: bytes) -> list[Block]:
    """One for a chunk, but for one with more characters than 16 bits can tell apart."""
    text, at, parts = _unzip(raw).decode(), 0, []
    for n in sizes:
        parts.append(text[at : at + n])
        at += n

    def cut(parts: list[str]) -> list[Block]:
        seen = np.zeros(POINTS, bool)
        for i, j in slices([len(p) for p in parts], SECTION):
            seen[points("".join(parts[i:j]))] = True
        alphabet = np.flatnonzero(seen)
        if len(alphabet) <= 1 << 16:
            return [Block(parts, alphabet)]
        if len(parts) > 1:
            return [*cut(parts[: len(parts) // 2]), *cut(parts[len(parts) // 2 :])]
        raise AssertionError("a part has no more than 65536 characters of its own")

    return cut(parts)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One at a time: a row holds a chunk."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1)


def _send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        chunk, name, sizes, raw, trusted = (row.column(c)[0].as_py() for c in ("chunk", "name", "sizes", "raw", "trusted"))
        good = np.zeros(len(sizes), bool)
        good[trusted or []] = True
        at = first = 0
        for block in blocks_of(sizes, raw):
            n = np.zeros(len(block.grams), np.int64)
            for i, names, part in block.sections():
                some, times = np.unique(names[good[first + i + part]], return_counts=True)
                n[np.searchsorted(block.grams, some)] += times
            m = len(n)
            columns = [pa.array([name] * m, pa.string()), pa.array(block.strings(), pa.string()), pa.array(np.full(m, chunk)), pa.array(np.arange(at, at + m, dtype=np.int32)), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, names=["name", "gram", "chunk", "at", "n"])
            at, first = at + m, first + len(block.parts)


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        sizes, raw = (row.column(c)[0].as_py() for c in ("sizes", "raw"))
        got = row.column("told")[0].values
        total = np.full(len(sizes), np.nan)
        at = first = 0
        for block in blocks_of(sizes, raw) if got is not None else []:
            log_p = np.full(len(block.grams), np.nan)
            place = got.field("at").to_numpy() - at
            here = (place >= 0) & (place < len(log_p))
            log_p[place[here]] = got.field("log_p").to_numpy()[here]
            for i, names, part in block.sections():
                sums = np.bincount(part, log_p[np.searchsorted(block.grams, names)])
                total[first + i : first + i + len(sums)] = sums
            at, first = at + len(log_p), first + len(block.parts)
        n = np.array(sizes) - ORDER + 1
        total[(n == 0) | np.isnan(total)] = np.nan
        columns = [row.column("uids")[0].values, row.column("ids")[0].values, pa.array([row.column("name")[0].as_py()] * len(total), pa.string())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(total, mask=np.isnan(total)), pa.array(n, pa.int64())], names=["uid", "id", "name", "log_p", "n"])


def discounts(counts: DataFrame) -> DataFrame:
    """Per language the three discounts of an order's counts, from how many n-grams occur once to four times."""
    times = lambda k: F.sum((F.col("n") == k).cast("double"))
    t = counts.groupBy("name").agg(*[times(i).alias(f"t{i}") for i in (1, 2, 3, 4)])
    y = F.when(F.col("t1") + 2 * F.col("t2") > 0, F.col("t1") / (F.col("t1") + 2 * F.col("t2"))).otherwise(0.5)

    def d(k: int) -> Column:
        known = (F.col(f"t{k}") > 0) & (F.col(f"t{k + 1}") > 0)
        value = k - (k + 1) * y * F.col(f"t{k + 1}") / F.col(f"t{k}")
        return F.when(known, F.greatest(F.lit(0.05 * k), F.least(value, F.lit(0.95 * k)))).otherwise(0.5 * k).alias(f"d{k}")

    return t.select("name", d(1), d(2), d(3))


def few_languages(named: DataFrame) -> bool:
    return named.select("name").distinct().limit(MOST_LANGUAGES + 1).count() <= MOST_LANGUAGES


def by_language(rows: DataFrame, told: DataFrame, few: bool, spread: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``told``, a row for each language: broadcast where these are ``few``, else dealt by ``spread``
    too, so that one language may have any share of the rows."""
    return rows.join(F.broadcast(told), "name", how) if few else join_by_slices(rows, told, ["name"], spread, how)


def train(counted: DataFrame, few: bool = False) -> tuple[list[DataFrame], list[DataFrame]]:
    """From ``name``, ``gram``, ``n``: of each order from 1 the probabilities ``name``, ``gram``, ``p``, and what a
    context leaves to the next lower order, ``name``, ``context``, ``g``."""
    counts = {ORDER: staged(counted, "ngrams")}
    shorter = F.expr("substring(gram, 2)")
    for n in range(ORDER - 1, 0, -1):  # in how many contexts of one more character an n-gram is seen
        counts[n] = staged(counts[n + 1].groupBy("name", shorter.alias("gram")).agg(F.count(F.lit(1)).alias("n")), "ngrams")
    known, left = [], []
    for n in range(1, ORDER + 1):
        table = by_language(counts[n], discounts(counts[n]), few, "gram")
        cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        table = table.select("name", "gram", F.substring("gram", 1, n - 1).alias("context"), "n", cut.alias("cut"))
        of = staged(table.groupBy("name", "context").agg(F.sum("n").alias("total"), (F.sum("cut") / F.sum("n")).alias("g")), "contexts")
        seen = table.join(of, ["name", "context"]).withColumn("own", (F.col("n") - F.col("cut")) / F.col("total"))
        if known:
            below = known[-1].select("name", F.col("gram").alias("short"), F.col("p").alias("below"))
            seen = seen.withColumn("short", shorter).join(below, ["name", "short"])
        else:
            seen = seen.withColumn("below", F.lit(1.0 / POINTS))
        known.append(staged(seen.select("name", "gram", (F.col("own") + F.col("g") * F.col("below")).alias("p")), "probabilities"))
        left.append(of.select("name", "context", "g"))
    return known, left


def look_up(wanted: DataFrame, known: list[DataFrame], left: list[DataFrame], few: bool = False) -> DataFrame:
    """``name``, ``gram``, ``p`` of the n-grams ``wanted`` (distinct ``name``, ``gram``) whose language has a model.

    Only those that an order has not seen go on to the next lower one.
    """
    wanted = by_language(wanted, left[0].select("name").distinct(), few, "gram", "left_semi")
    told = []
    for n in range(ORDER, 0, -1):
        found = wanted.join(known[n - 1], ["name", "gram"], "left").withColumn("context", F.substring("gram", 1, n - 1))
        told.append(staged(found.join(left[n - 1], ["name", "context"], "left").select("name", "gram", "p", F.coalesce("g", F.lit(1.0)).alias("g")), "looked-up"))
        wanted = told[-1].where("p IS NULL").select("name", F.expr("substring(gram, 2)").alias("gram")).distinct()
    below = told.pop().select("name", "gram", F.coalesce("p", F.col("g") / POINTS).alias("p"))
    while told:
        short = below.select("name", F.col("gram").alias("short"), F.col("p").alias("below"))
        mine = told.pop().withColumn("short", F.when(F.col("p").isNull(), F.expr("substring(gram, 2)")))
        below = mine.join(short, ["name", "short"], "left").select("name", "gram", F.coalesce("p", F.col("g") * F.col("below")).alias("p"))
    return below


def thresholds(trusted: DataFrame, quantile: float, few: bool = False) -> DataFrame:
    """``name``, ``threshold`` from ``name``, ``perplexity``, ``held`` of trusted documents.

    A language's limit is the quantile of those held out (of all where none is), in logarithms. With few of them that
    says little, so its distance to the language's median is drawn, as strongly as ``DRAWN`` documents would, to that
    of all languages; each distance is widened by one part in the root of the number of documents behind it.
    """
    some = trusted.groupBy("name").agg(F.max("held").alias("some"))  # here and below: a row for each language
    held = by_language(trusted, some, few, "perplexity").where(F.col("held") | ~F.col("some"))
    own = held.groupBy("name").agg(F.count(F.lit(1)).alias("n"), *[F.percentile_approx(F.log("perplexity"), q, 100_000).alias(c) for c, q in (("middle", 0.5), ("limit", quantile))])
    own = staged(own, "language-limits")
    above, n = by_language(held, own, few, "perplexity").agg(F.percentile_approx(F.log("perplexity") - F.col("middle"), quantile, 100_000), F.count(F.lit(1))).first()
    widened = F.lit(above * (1 + n**-0.5) if n else 0.0)
    alone = (F.col("limit") - F.col("middle")) * (1 + F.pow("n", F.lit(-0.5)))
    share = F.col("n") / (F.col("n") + DRAWN)
    return own.select("name", F.exp(F.col("middle") + share * alone + (1 - share) * widened).alias("threshold"))


def judge(docs: DataFrame, labels: DataFrame, quantile: float = 0.99, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``lang``, ``perplexity``, ``threshold``, ``kept``.

    Trusted are the documents whose labels all say quality 1 and none says toxic. All of them are counted but one in
    ``HELD_OUT``, by hashed id: those set the limit, the ``quantile`` of their language (see ``thresholds``; all trusted
    ones do both where a language has no others). A document is kept if its perplexity is at most the limit, ties included. A text
    that is null or empty has no perplexity and is not kept; a document of a language without trusted text is kept,
    without perplexity. A null language is a language of its own. Whole texts are read, very long ones in several parts.
    Repeated rows are judged each; an empty table gives an empty table; without labels everything is kept.
    """
    good = labels.where(F.col(id).isNotNull()).groupBy(id).agg(F.min("quality").alias("_q"), F.max(F.coalesce("toxic", F.lit(0))).alias("_t")).where("_q = 1 AND _t = 0").select(F.col(id).alias("id"))
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id).alias("id"), F.col(text).alias("text"), name_of(F.col(lang)).alias("name"))
    kind = docs.schema[id].dataType.simpleString()
    id_type = to_arrow_type(docs.schema[id].dataType)
    packed = rows.mapInArrow(_pack(id_type), f"chunk long, name string, uids array<long>, ids array<{kind}>, sizes array<int>, raw binary")
    chunks = bucketed(packed, "chunks", "chunk")
    few = few_languages(chunks)
    places = chunks.select("chunk", "name", F.posexplode("ids").alias("place", "id")).where("id IS NOT NULL")
    places = places.join(good, "id", "left_semi").withColumn("held", held_out(F.col("id")))
    counted = places.groupBy("name").agg(F.min("held").alias("none"))  # a row for each language
    places = by_language(places, counted, few, "id").where(~F.col("held") | F.col("none"))
    trusted = places.groupBy("chunk").agg(F.collect_list("place").alias("trusted"))
    sent = chunks.select("chunk", "name", "sizes", "raw").join(trusted, "chunk", "left").mapInArrow(_send, "name string, gram string, chunk long, at int, n long")
    sent = staged(sent, "chunk-ngrams")
    known, left = train(sent.where("n > 0").groupBy("name", "gram").agg(F.sum("n").alias("n")), few)
    p = look_up(sent.select("name", "gram").distinct(), known, left, few)
    told = sent.select("name", "gram", "chunk", "at").join(p, ["name", "gram"]).select("chunk", "at", F.log("p").cast("float").alias("log_p"))
    told = told.groupBy("chunk").agg(F.collect_list(F.struct("at", "log_p")).alias("told"))
    added = chunks.join(told, "chunk", "left").mapInArrow(_add_up, f"uid long, id {kind}, name string, log_p double, n long")
    whole = added.groupBy("uid", "id", "name").agg(F.sum("log_p").alias("log_p"), F.sum("n").alias("n"))
    scored = staged(whole.select("id", "name", "n", F.when(F.col("n") > 0, F.exp(-F.col("log_p") / F.col("n"))).alias("perplexity")), "perplexities")
    limits = thresholds(scored.where("perplexity IS NOT NULL").join(good, "id", "left_semi").select("name", "perplexity", held_out(F.col("id")).alias("held")), quantile, few)
    kept = (F.col("n") > 0) & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    of = F.when(F.col("name") != "-", F.expr("substring(name, 2)"))
    return by_language(scored, limits, few, "id", "left").select(F.col("id").alias(id), of.alias("lang"), "perplexity", "threshold", kept.alias("kept"))
