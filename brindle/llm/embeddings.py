"""Embedding near-dedup: all pairs of a label by int8 tile products with rigorous error bounds.

Equal vectors of a label are one class. A label's classes are dealt into blocks of about ``BLOCK`` by hash, whatever the
label's size, and the int8 codes of every two blocks meet in one tile. A unit vector ``u`` is ``s * q + e`` with whole numbers ``q`` in
[-127, 127]; for two of them ``|u.v - s_u s_v q_u.q_v| <= |s_u q_u||e_v| + |e_u||s_v q_v| + |e_u||e_v|``, with the
norms of the actual errors. Vectors with a pair that the bound leaves possibly above the threshold are sent to that
tile again, as they are, and such pairs are computed in double precision. A tile returns, for each class, the number of
linked vectors and one link of a spanning forest: pairs never leave their tile.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.llm.common import map_batches, staged
from brindle.llm.components import connected_components

BLOCK = 2048
SIDE = 512
#: Pairs that are computed again at a time; always a pair by itself, so that a tile's other pairs do not change its sum.
AGAIN = 1 << 16


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``q`` (int8), ``s``, the norm of ``s * q`` and that of the error, both rounded up."""
    s = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / s[:, None]).astype(np.int8)
    near = q * s[:, None]
    up = 1 + 1e-9
    return q, s, np.linalg.norm(near, axis=1) * up, np.linalg.norm(unit - near, axis=1) * up + 1e-12


def scaled(v: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that the largest component lies in [0.5, 1): squares neither overflow nor vanish."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=1))[1][:, None])


def possible(x: tuple, y: tuple, threshold: float):
    """Index pairs of rows of ``x`` and ``y`` (what ``quantised`` gives) whose cosine may be ``threshold`` or more, a part at a time."""
    (qx, sx, ax, ex), (qy, sy, ay, ey) = x, y
    kind = np.float32 if qx.shape[1] <= 1024 else np.float64  # sums of products of int8 stay exact
    for i in range(0, len(qx), SIDE):
        a = slice(i, i + SIDE)
        left = qx[a].astype(kind)
        for j in range(0, len(qy), SIDE):
            b = slice(j, j + SIDE)
            about = (left @ qy[b].astype(kind).T) * np.outer(sx[a], sy[b])
            slack = np.outer(ax[a], ey[b]) + np.outer(ex[a], ay[b] + ey[b]) + 1e-9
            p, q = np.nonzero(about + slack >= threshold)
            if len(p):
                yield i + p, j + q


def tile_links(x: np.ndarray, y: np.ndarray, threshold: float):
    """Index pairs ``(i, j)`` of rows of ``x`` and ``y`` (doubles, not zero) with cosine at least ``threshold``, a part at a time."""
    x, y = scaled(x), scaled(y)
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    for i, j in possible(quantised(x / nx[:, None]), quantised(y / ny[:, None]), threshold):
        for n in range(0, len(i), AGAIN):
            c, d = i[n : n + AGAIN], j[n : n + AGAIN]
            hit = np.einsum("ij,ij->i", x[c], y[d]) / (nx[c] * ny[d]) >= threshold
            yield c[hit], d[hit]


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node reachable from each of ``n`` nodes."""
    root = np.arange(n)
    while len(a):
        x, y = root[a], root[b]
        low = np.minimum(x, y)
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        while not np.array_equal(root[root], root):
            root = root[root]
        differ = root[a] != root[b]
        a, b = a[differ], b[differ]
    return root


def _code_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    """``q``, ``s``, ``a``, ``e`` of ``quantised`` in place of ``v``; lengths may differ."""
    dim, n = batch.column("dim").to_numpy(), batch.num_rows
    q, numbers = np.empty(n, object), np.empty((3, n))
    for d in np.unique(dim):
        at = np.flatnonzero(dim == d)
        v = scaled(batch.column("v").take(pa.array(at)).flatten().to_numpy().astype(np.float64).reshape(-1, d))
        codes, *told = quantised(v / np.linalg.norm(v, axis=1)[:, None])
        q[at] = [row.tobytes() for row in codes]
        numbers[:, at] = told
    kept = [name for name in batch.schema.names if name != "v"]
    return pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(q, pa.binary()), *map(pa.array, numbers)], names=[*kept, "q", "s", "a", "e"])


def _open(threshold: float, keys: list[str]):
    """Of a tile of codes, ``keys`` of the vectors that may have a partner there."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        q = np.frombuffer(b"".join(table.column("q").to_pylist()), np.int8).reshape(-1, table.column("dim")[0].as_py())
        codes = (q, *[table.column(c).to_numpy() for c in ("s", "a", "e")])
        side, low = table.column("own").to_numpy(), table.column("low")[0].as_py()
        left = np.flatnonzero(side == low)
        right = left if table.column("high")[0].as_py() == low else np.flatnonzero(side != low)
        some = np.zeros(len(q), bool)
        for i, j in possible(*[tuple(c[x] for c in codes) for x in (left, right)], threshold):
            i, j = left[i], right[j]
            other = i != j
            some[i[other]] = some[j[other]] = True
        return table.select(keys).take(pa.array(np.flatnonzero(some)))

    return run


def _tile(threshold: float, block: str):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        dim = table.column("dim")[0].as_py()
        v = np.frombuffer(b"", np.float64) if not table.num_rows else table.column("v").combine_chunks().flatten().to_numpy().astype(np.float64)
        v = v.reshape(-1, dim)
        node, count = table.column("node").combine_chunks(), table.column("count").to_numpy()
        side, low = table.column(block).to_numpy(), table.column("low")[0].as_py()
        inner = table.column("high")[0].as_py() == low
        left = np.flatnonzero(side == low)
        right = left if inner else np.flatnonzero(side != low)
        links, root = np.zeros(len(v), np.int64), np.arange(len(v))
        if len(left) and len(right):
            for i, j in tile_links(v[left], v[right], threshold):
                i, j = left[i], right[j]
                if inner:
                    i, j = i[i != j], j[i != j]
                    links += np.bincount(i, count[j], len(v)).astype(np.int64)
                else:
                    links += (np.bincount(i, count[j], len(v)) + np.bincount(j, count[i], len(v))).astype(np.int64)
                root = forest(len(v), np.concatenate([np.arange(len(v)), i]), np.concatenate([root, j]))
        some = pa.array(np.flatnonzero(links))
        return pa.table({"node": node.take(some), "links": pa.array(links).take(some), "root": node.take(pa.array(root[some.to_numpy()]))})

    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.93, id: str = "vec_id", embedding: str = "embedding", label: str = "label", block: int = BLOCK) -> DataFrame:
    """One row per row of ``vectors``: ``id``, ``n_links``, ``component_id``, ``kept``.

    Vectors of one label (not null) and one length link if their cosine in double precision is at least
    ``threshold``, ties included. Vectors are read whole, however long. Vectors that are null, empty, zero or hold null or non-finite components, and rows without an id,
    link with nothing: no links, their own id as component, kept. Rows are vectors: a repeated row links to its copy, and
    vectors that share an id are vectors of their own. Finite components may be of any size.
    An empty table gives an empty table; other columns are not read.
    """
    kind = vectors.schema[id].dataType.simpleString()
    e = F.col("v")
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
    rows = vectors.select(F.col(id).alias("id"), F.col(label).alias("label"), F.col(embedding).alias("v"))
    good = F.col("id").isNotNull() & F.col("label").isNotNull() & e.isNotNull() & F.forall(e, fine) & F.exists(e, lambda c: c != 0)
    rows = staged(rows.select("id", "label", F.when(good, e).alias("v"), F.when(good, F.xxhash64(e)).alias("h1"), F.when(good, F.xxhash64(F.lit(1), e)).alias("h2")), "vectors")
    same = ["label", "h1", "h2"]
    # A class is told by its smallest id, for the order of components, and by its hashes, as an id may have several vectors.
    node = F.struct("rep", "label", "h1", "h2").alias("node")
    node_kind = f"struct<rep: {kind}, label: {vectors.schema[label].dataType.simpleString()}, h1: bigint, h2: bigint>"
    classes = rows.where(F.col("v").isNotNull()).groupBy(*same).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("count"), F.first("v").alias("v"))
    classes = staged(classes.withColumn("dim", F.size("v")), "vector-classes")

    blocks = classes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    codes = classes.select(*same, "dim", "v")
    codes = map_batches(codes, _code_batch, T.StructType([*[f for f in codes.schema if f.name != "v"], *T.StructType.fromDDL("q binary, s double, a double, e double")]))
    dealt = staged(codes, "vector-codes").join(blocks, ["label", "dim"]).withColumn("own", F.pmod(F.xxhash64("h1"), F.col("blocks")).cast("int"))
    tiles = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tile = ["label", "dim", "low", "high"]
    tiles = tiles.select("label", "dim", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "h1", "h2", "q", "s", "a", "e")
    keys = [*tile, "own", "h1", "h2"]
    # Codes meet in every tile; vectors go to the tiles in which they may have a partner.
    some = staged(tiles.groupBy(*tile).applyInArrow(_open(threshold, keys), tiles.select(*keys).schema), "open-vectors")
    again = some.join(classes.drop("dim"), same).select(*tile, "own", node, "count", "v")
    met = staged(again.groupBy(*tile).applyInArrow(_tile(threshold, "own"), f"node {node_kind}, links long, root {node_kind}"), "tile-links")
    links = met.groupBy("node").agg(F.sum("links").alias("links"))
    found = connected_components(met.select(F.col("node").alias("a"), F.col("root").alias("b")))

    told = classes.select(*same, "rep", "count", node).join(links, "node", "left").join(found, "node", "left")
    told = told.select(*same, (F.coalesce("links", F.lit(0)) + F.col("count") - 1).alias("n_links"), F.coalesce("component.rep", "rep").alias("component"))
    out = rows.join(told, same, "left").select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component"))
    return out.select(F.col("id").alias(id), "n_links", F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"))
