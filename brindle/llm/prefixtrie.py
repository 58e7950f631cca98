"""Conversation prefix trie: every distinct sequence of first turns is a node, with totals over its subtree.

A node is told by its depth and two exclusive-or sums of hashes of its turns, each hashed with its place; texts themselves
never leave the scan. Turns are numbered, and sums run, over range partitions and blocks whose totals are carried on, so
a conversation of any length is dealt to many tasks.

Totals over subtrees come by bands of ``HEIGHT`` levels. A node adds its own figures to its ancestors within its band, at
most ``HEIGHT``; the tops of bands form a trie of their own, ``HEIGHT`` times lower, which is rolled up in the same way; then a
top's completed total goes to its ancestors in the band above, again at most ``HEIGHT``. So rounds grow with the logarithm of
the depth, and no node is ever sent to more than ``2 * HEIGHT`` others a round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from brindle.llm.common import join_by_slices, staged

HEIGHT = 8
#: Turns whose sums run in one task; characters of ids that are hashed at a time.
BLOCK, CHUNK = 4096, 1 << 16
NODE = ["depth", "k1", "k2"]


def numbered_turns(turns: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``pos`` (from 1), ``t1``, ``t2`` (of role and text), ``bytes`` (of the text as UTF-8).

    Turns stand in order of ``turn`` (null first), those of one number in order of role and of their text's SHA-256. A null
    role or text is empty; rows without an ``id`` belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = turns.where(F.col(id).isNotNull()).select(F.col(id).alias("conv"), F.col(turn).alias("turn"), role.alias("role"), F.unhex(F.sha2(text, 256)).alias("sha"), F.octet_length(text).cast("long").alias("bytes"))
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "turns")  # so that equal turns are told apart
    order = ["turn", "role", "sha", "row"]
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = staged(rows.repartitionByRange(n, "conv", *order).withColumn("part", F.spark_partition_id()), "ranged-turns")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = ranged.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n")).select("conv", "part", before.alias("before"))
    pos = F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order))
    counted = ranged.withColumn("own", pos).join(starts, ["conv", "part"])
    return counted.select("conv", (F.col("own") + F.col("before")).cast("int").alias("pos"), F.xxhash64("role", "sha").alias("t1"), F.xxhash64(F.lit(1), "role", "sha").alias("t2"), "bytes")


def rebuilt(turns: DataFrame, every: int = 5, most: int = 9) -> DataFrame:
    """Turns of every conversation ``c`` of ``numbered_turns``: the first ``h`` of ``c - c % every``, then its own after its first
    ``h``, where ``h`` is the checksum (CRC-32) of ``c`` as decimal digits modulo ``most``."""
    size = turns.groupBy("conv").agg(F.max("pos").alias("size"))
    convs = size.withColumn("h", F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(most)).cast("int")).withColumn("base", F.col("conv") - F.col("conv") % every)
    given = turns.where(F.col("pos") < most).select(F.col("conv").alias("base"), "pos", "t1", "t2", "bytes")
    heads = convs.join(given, "base").where(F.col("pos") <= F.col("h")).select("conv", "pos", "t1", "t2", "bytes")
    # A conversation's own turns move up where its base has fewer than h.
    moved = convs.join(size.select(F.col("conv").alias("base"), F.col("size").alias("given")), "base", "left").select("conv", "h", F.least("h", F.coalesce("given", F.lit(0))).alias("kept"))
    tails = turns.withColumn("block", F.floor(F.col("pos") / BLOCK))
    spread = moved.join(tails.select("conv", "block").distinct(), "conv")
    tails = tails.join(spread, ["conv", "block"]).where(F.col("pos") > F.col("h"))
    return heads.unionByName(tails.select("conv", (F.col("pos") - F.col("h") + F.col("kept")).cast("int").alias("pos"), "t1", "t2", "bytes"))


def paths(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """``conv``, ``depth``, ``k1``, ``k2``, ``p1``, ``p2``, ``bytes``: every conversation's nodes, root first, with their parents' sums."""
    rows = turns.select("conv", F.col("pos").alias("depth"), F.xxhash64("pos", "t1").alias("z1"), F.xxhash64("pos", "t2").alias("z2"), "bytes").withColumn("block", F.floor(F.col("depth") / BLOCK))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("conv", "block").agg(F.bit_xor("z1").alias("z1"), F.bit_xor("z2").alias("z2"))
    sums = sums.select("conv", "block", *[F.coalesce(F.bit_xor(z).over(earlier), F.lit(0)).alias(b) for z, b in (("z1", "b1"), ("z2", "b2"))])
    running = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    keyed = rows.withColumns({"k1": F.bit_xor("z1").over(running), "k2": F.bit_xor("z2").over(running)}).join(sums, ["conv", "block"])
    keyed = keyed.withColumns({"k1": F.col("k1").bitwiseXOR(F.col("b1")), "k2": F.col("k2").bitwiseXOR(F.col("b2"))})
    out = keyed.select("conv", "depth", "k1", "k2", F.col("k1").bitwiseXOR(F.col("z1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("z2")).alias("p2"), "bytes")
    zero = F.lit(0).cast("long")
    root = convs.select("conv", F.lit(0).alias("depth"), *[zero.alias(c) for c in ("k1", "k2", "p1", "p2", "bytes")])
    return staged(out.unionByName(root), "paths")


def rolled_up(nodes: DataFrame, path: DataFrame, deepest: int, values: list[str], height: int = HEIGHT) -> DataFrame:
    """``NODE`` and the sums of ``values`` over each node's subtree.

    ``nodes`` have ``conv``, a member of theirs, and ``path`` has ``conv`` and ``NODE`` for every node on members' paths; depths
    are 0 to ``deepest``.
    """
    band = F.floor(F.col("depth") / height).cast("int")
    up = path.groupBy("conv", band.alias("band")).agg(F.collect_list(F.struct(*NODE)).alias("path"))  # at most height of them
    sums = [F.sum(v).alias(v) for v in values]
    above = nodes.select("conv", F.col("depth").alias("own"), *values, band.alias("band")).join(up, ["conv", "band"])
    above = above.select(F.explode(F.filter("path", lambda a: a["depth"] <= F.col("own"))).alias("a"), *values)
    within = staged(above.select("a.*", *values).groupBy(*NODE).agg(*sums), "bands")
    if deepest < height:
        return within
    lower = lambda df: df.where(F.col("depth") % height == 0).withColumn("depth", (F.col("depth") / height).cast("int"))
    tops = lower(within).join(lower(nodes.select("conv", *NODE)), NODE)
    total = rolled_up(staged(tops, "tops"), staged(lower(path), "top-paths"), deepest // height, values, height)
    total = total.where("depth > 0").join(tops.select("conv", *NODE), NODE)
    down = total.select("conv", (F.col("depth") - 1).alias("band"), *values).join(up, ["conv", "band"]).select(F.explode("path").alias("a"), *values)
    return staged(within.unionByName(down.select("a.*", *values)).groupBy(*NODE).agg(*sums), "totals")


def joined_digests(members: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``keys`` and ``digest``: the SHA-256, as lowercase hex, of the group's values, ascending, as decimals joined by commas.

    Values are range-partitioned, so a group of any size is sorted by many tasks; these send pieces of ``CHUNK`` characters,
    and one task streams a group's pieces through the hash, a piece at a time.
    """
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    types = ", ".join(f"{k} {members.schema[k].dataType.simpleString()}" for k in keys)
    kind = members.schema[value].dataType.simpleString()
    of = lambda *names: pa.schema([*[to_arrow_schema(members.select(*keys).schema).field(k) for k in keys], *names])
    sent = of(pa.field("first", to_arrow_schema(members.select(value).schema).field(0).type), ("piece", pa.string()))
    given = of(("digest", pa.string()))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, held, size = None, None, [], 0
        piece = lambda: {**dict(zip(keys, key, strict=True)), "first": first, "piece": ",".join(held)}
        for batch in batches:
            out = []
            for *own, v in zip(*[batch.column(k).to_pylist() for k in [*keys, "v"]], strict=True):
                if own != key or size > CHUNK:
                    out += [piece()] if held else []
                    key, first, held, size = own, v, [], 0
                held.append(str(v))
                size += len(held[-1]) + 1
            if out:
                yield pa.RecordBatch.from_pylist(out, sent)
        if held:
            yield pa.RecordBatch.from_pylist([piece()], sent)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, hashlib.sha256()
        told = lambda: {**dict(zip(keys, key, strict=True)), "digest": state.hexdigest()}
        for batch in batches:
            out = []
            for *own, piece in zip(*[batch.column(k).to_pylist() for k in [*keys, "piece"]], strict=True):
                if own == key:
                    state.update(b"," + piece.encode())
                    continue
                out += [told()] if key else []
                key, state = own, hashlib.sha256(piece.encode())
            if out:
                yield pa.RecordBatch.from_pylist(out, given)
        if key:
            yield pa.RecordBatch.from_pylist([told()], given)

    rows = members.select(*keys, F.col(value).alias("v")).repartitionByRange(n, *keys, "v").sortWithinPartitions(*keys, "v")
    cut = rows.mapInArrow(pieces, f"{types}, first {kind}, piece string")
    return cut.repartition(n, *keys).sortWithinPartitions(*keys, "first").mapInArrow(digests, f"{types}, digest string")


def trie(turns: DataFrame, every: int = 5, most: int = 9, height: int = HEIGHT, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per node: ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``.

    Conversations are rebuilt first (``rebuilt``; with ``most=1`` they stay as they are). ``saved_tokens`` are bytes: of each
    node in the subtree those of its last text, for all members but one. A repeated row is a turn like any other. Order
    and nulls are as ``numbered_turns`` says; texts of any length are read whole; an empty table gives no rows; other
    columns are not read.
    """
    given = staged(numbered_turns(turns, id, turn, role, text), "numbered-turns")
    path = paths(rebuilt(given, every, most), given.select("conv").distinct())
    nodes = path.groupBy(*NODE).agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.first("bytes").alias("bytes"), F.first("p1").alias("p1"), F.first("p2").alias("p2"))
    nodes = staged(nodes, "nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = staged(nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")), "trie")

    deepest = path.agg(F.coalesce(F.max("depth"), F.lit(0))).first()[0]
    own = nodes.select("conv", *NODE, F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"))
    totals = rolled_up(own, path.select("conv", *NODE), deepest, ["n_leaves", "saved_tokens"], height)

    last = path.groupBy("conv").agg(F.max(F.struct(*NODE)).alias("last")).select("conv", "last.*")
    ends = joined_digests(staged(last, "ends"), NODE, "conv").withColumnRenamed("digest", "ends_sha256")
    parents = nodes.select(F.col("depth").alias("p0"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("parent_conv_id"))
    below = join_by_slices(nodes.where("depth > 0").withColumn("p0", F.col("depth") - 1), parents, ["p0", "p1", "p2"], "k1").select(*NODE, "parent_conv_id")
    told = nodes.join(below, NODE, "left").join(totals, NODE, "left").join(ends, NODE, "left")
    return told.select(
        F.col("conv").alias("conv_id"),
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
