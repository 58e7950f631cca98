"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source starts with the same expected number of copies, ``target / source size``. The whole part is
given; the fractional parts are rounded so that the source's words stay whole: two documents at a time pass words
from one to the other, in a direction drawn so that expectations hold, until one of them has a whole number. Groups
of documents (by hashed id, so a rerun makes the same groups) each leave one undecided document; those meet in the
next level of a tree, ``FAN_IN`` groups to one, until each source has one document left, which is drawn alone. So a
source's words miss its target by less than one document.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.common import join_by_slices, packed, staged

#: Weights by a source's place in the order of sources, repeating.
WEIGHTS = (3, 1, 2)
#: Documents to a group of the first level, and groups to a group of the next.
LEAF_ROWS, FAN_IN = 2000, 64
WORD = r"[^\x20\x09-\x0D]+"


def numbered(df: DataFrame, order: Column) -> DataFrame:
    """``df`` with ``_rank``, from 0: a range-partitioned sort, and the rows in the partitions before one's own."""
    place = F.monotonically_increasing_id()  # the partition and, in its last 33 bits, the row
    own = staged(df.orderBy(order).withColumn("_place", place), "ordered")
    part = F.shiftright("_place", 33)
    parts = own.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")  # a row for each partition
    parts = parts.select("_part", before.alias("_before"))
    placed = own.join(F.broadcast(parts), part == F.col("_part"))
    return placed.withColumn("_rank", F.col("_before") + F.col("_place").bitwiseAND((1 << 33) - 1)).drop("_place", "_part", "_before")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Add ``target`` to one row per source with ``source`` and ``source_size``.

    Sources in the order of their code points, null last, weigh ``weights`` in turn and share ``share`` of all sizes.
    A target stops at ``most`` times its source's size and what is cut is shared again by weight among those that
    have not stopped, until none is above: as many passes as sources stop in turn, each one sum over the sources.
    A source of size 0 has target 0. There may be any number of sources: they are put in order over many tasks.
    """
    ranked = numbered(staged(sources, "mix-source-sizes"), F.col("source").asc_nulls_last())
    ranked = staged(ranked.withColumn("_weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))), "mix-sources")
    cap = F.col("source_size") * F.lit(float(most))
    total = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, stopped = 0.0, -1
    while True:
        above = F.col("_weight") * F.lit(level) > cap
        cut, open_weight, n = ranked.agg(F.sum(F.when(above, cap).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("_weight"))), F.count(F.when(above, 1))).first()
        if n == stopped or not open_weight:
            break
        stopped, level = n, (total - cut) / open_weight
    return ranked.select("source", "source_size", F.least(F.col("_weight") * F.lit(level), cap).alias("target"))


def pivotal(sizes: np.ndarray, parts: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, int]:
    """Round ``parts`` (each in [0, 1]) in order so that ``sum(sizes * parts)`` stays; the place left undecided, or -1."""
    out = parts.tolist()
    held = -1
    for i, (s, p, u) in enumerate(zip(sizes.tolist(), parts.tolist(), draws.tolist(), strict=True)):
        if not 0.0 < p < 1.0:
            continue
        if held < 0:
            held = i
            continue
        t, q = float(sizes[held]), out[held]
        up = min((1.0 - q) * t, p * s)  # words that may pass from i to the held one
        down = min(q * t, (1.0 - p) * s)
        # Up with probability down / (up + down): expectations stay.
        words = up if u * (up + down) < down else -down
        q, p = q + words / t, p - words / s
        q, p = (round(x) if abs(x - round(x)) < 1e-12 else x for x in (q, p))
        if 0.0 < q < 1.0 and 0.0 < p < 1.0:  # by rounding errors alone
            p = round(p)
        out[held], out[i] = q, p
        held = held if 0.0 < q < 1.0 else i if 0.0 < p < 1.0 else -1
    return np.array(out), held


ROUNDED = "_key string, _salt long, _twin long, source string, size long, source_size long, target double, _whole long, _part double, _draw double, _leaf long, _open boolean"


def _round(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["size", "_draw", "_key", "_salt", "_twin"], kind="stable")
    parts, held = pivotal(group["size"].to_numpy(), group["_part"].to_numpy(), group["_draw"].to_numpy())
    group["_part"] = parts
    group["_open"] = False
    if held >= 0:
        group.iloc[held, group.columns.get_loc("_open")] = True
    return group


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 0, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``size`` (words), ``source``, ``source_size``, ``target``, ``copies``, ``taken``.

    ``taken`` is ``copies * size`` and ``copies`` at most ``most`` rounded up. Null and empty texts have size 0 and are
    given the whole part of their copies. A null source is a source of its own, a null id an id like any other.
    Repeated rows are rounded each for itself, dealt to many groups; which of them gets a copy more is not told apart. An empty table
    gives an empty table; other columns of ``docs`` are not read. Whole texts are counted, however long.
    """
    return _mixed(docs, weights, share, most, seed, id, text, source).drop("_salt")


def _group(id: Column, source: Column, salt: Column) -> list[Column]:
    """``_g1``, ``_g2``: 128 bits that rows share if they agree in id, source and text."""
    told = [id.cast("string"), id.isNull(), source.cast("string"), source.isNull(), salt]
    return [F.xxhash64(*told).alias("_g1"), F.xxhash64(F.lit(1), *told).alias("_g2")]


def _twins(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_twin``: for rows of equal ``_g1`` and ``_g2`` their places in a row, dealt over many tasks, else null.

    The places of a group are the same in every run, though not which of its rows has which.
    """
    repeated = rows.groupBy("_g1", "_g2").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_g1", "_g2", F.lit(True).alias("_again"))
    if repeated.isEmpty():
        return rows.withColumn("_twin", F.lit(None).cast("long"))
    told = staged(join_by_slices(rows.withColumn("_row_id", F.monotonically_increasing_id()), repeated, ["_g1", "_g2"], "_row_id", "left"), "mix-twins")
    again = numbered(told.where("_again"), F.struct("_g1", "_g2", "_row_id")).withColumnRenamed("_rank", "_twin")
    return told.where("_again IS NULL").withColumn("_twin", F.lit(None).cast("long")).unionByName(again).drop("_again", "_row_id")


def _mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 0, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """What ``mix`` returns, with a hash of the text as ``_salt``."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    salt = F.xxhash64(F.col(text))
    sized = staged(docs.select(F.col(id).alias("_id"), F.col(source).cast("string").alias("source"), size.alias("size"), salt.alias("_salt"), *_group(F.col(id), F.col(source), salt)), "mix-sizes")
    sized = _twins(sized)
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    aims = targets(sources.select("source", "source_size"), weights, share, most)
    counts = sources.select(F.col("source").alias("_s"), F.ceil(F.col("_rows") / LEAF_ROWS).alias("_leaves"))
    aims = staged(aims.join(counts, F.col("source").eqNullSafe(F.col("_s"))).drop("_s").withColumnRenamed("source", "_s"), "mix-targets")
    key = F.col("_id").cast("string")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(copies + F.lit(1e-12)).cast("long")
    part = F.when(F.col("size") > 0, F.greatest(copies - whole, F.lit(0.0))).otherwise(0.0)
    spread = F.xxhash64(key, F.lit(seed), "_salt", "_twin")  # ids may be null or repeat, and rows too; a leaf stays small all the same
    rows = sized.join(aims, sized["source"].eqNullSafe(aims["_s"])).select(
        key.alias("_key"), "_salt", "_twin", "source", "size", "source_size", "target", whole.alias("_whole"), part.alias("_part"),
        (F.shiftrightunsigned(F.xxhash64(key, F.lit(seed + 1), "_twin"), 11) / F.lit(float(1 << 53))).alias("_draw"),
        F.pmod(spread, F.col("_leaves")).alias("_leaf"), F.lit(True).alias("_open"), F.col("_leaves"),
    )
    most_leaves = aims.agg(F.max("_leaves")).first()[0] or 1
    level = staged(rows.drop("_leaves").groupBy("source", "_leaf").applyInPandas(_round, ROUNDED), "mix-level")
    decided = level.where(~F.col("_open"))
    while most_leaves > 1:
        most_leaves = -(-most_leaves // FAN_IN)
        waiting = level.where("_open").withColumn("_leaf", F.floor(F.col("_leaf") / FAN_IN))
        level = staged(waiting.groupBy("source", "_leaf").applyInPandas(_round, ROUNDED), "mix-level")
        decided = decided.unionByName(level.where(~F.col("_open")))
    last = level.where("_open").withColumn("_part", F.when(F.col("_draw") < F.col("_part"), 1.0).otherwise(0.0))
    done = decided.unionByName(last).withColumn("copies", F.col("_whole") + F.col("_part").cast("long"))
    kind = docs.schema[id].dataType
    return done.select(
        F.col("_key").cast(kind).alias(id), "_salt", "size", "source", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"),
    )


def apply(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken; columns may have any names.

    Rows that agree in id, source and text share out their copies. Null and empty texts are taken as ``mix`` says, texts of
    any length move once, and an empty table gives an empty one.
    """
    id, text, source = (how.get(n, d) for n, d in (("id", "doc_id"), ("text", "text"), ("source", "source")))
    salt = F.xxhash64(F.col(text))
    taken = _mixed(docs, **how)
    taken = staged(taken.select(*_group(F.col(id), F.col("source"), F.col("_salt")), "copies"), "mix-taken")
    steps = taken.groupBy("_g1", "_g2", "copies").agg(F.count(F.lit(1)).alias("n"))
    # Of a group, how many rows are taken how often, most often first: a few numbers, however many rows there are.
    steps = staged(steps.groupBy("_g1", "_g2").agg(F.sum("n").alias("n"), F.reverse(F.sort_array(F.collect_list(F.struct("copies", "n")))).alias("steps")), "mix-steps")
    ours = docs.select(packed(docs).alias("_row"), *_group(F.col(id), F.col(source), salt))
    wanted = steps.where(F.exists("steps", lambda x: x["copies"] > 0))
    times = F.col("steps")[0]["copies"]
    if not steps.where("n > 1").isEmpty():
        ours = staged(_twins(ours), "mix-rows")
        first = ours.where("_twin IS NOT NULL").groupBy("_g1", "_g2").agg(F.min("_twin").alias("first"))
        wanted = wanted.join(first, ["_g1", "_g2"], "left")
        ours = ours.withColumn("_by", F.coalesce("_twin", F.lit(0)))
        place = F.coalesce(F.col("_twin") - F.col("first"), F.lit(0))
        # The step that a row's place falls into: pass steps until their rows are used up.
        walk = F.aggregate("steps", F.struct(place.alias("left"), F.lit(-1).cast("long").alias("copies")), lambda acc, x: F.when(acc["left"] < 0, acc).otherwise(F.struct((acc["left"] - x["n"]).alias("left"), x["copies"].alias("copies"))))
        joined = join_by_slices(ours, wanted, ["_g1", "_g2"], "_by").withColumn("_times", walk["copies"])
    else:
        joined = ours.join(wanted, ["_g1", "_g2"]).withColumn("_times", times)
    joined = joined.select("_row", F.explode(F.array_repeat(F.lit(1), F.col("_times").cast("int"))))
    return joined.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
