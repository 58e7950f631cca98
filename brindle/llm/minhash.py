"""MinHash near-dedup by a multi-index Hamming join of b-bit signatures.

A document's set of shingles gets ``COMPONENTS`` minimum hashes. The first ``CHUNKED`` keep 16 bits each and are split
into ``CHUNKS`` chunks: two signatures that differ in at most ``2 * CHUNKS - 1`` of them have, by pigeonhole, a chunk
with at most one error, so they agree in one of the keys that leave a single component of a chunk out. All
components keep one bit more in a 64-bit sketch; sets that share a key with any other get a longer one of ``LONG``
bits. At similarity 0.8 a component differs with chance 0.2 and a bit with 0.1: more than 19 of 32, 22 of
64 or 148 of 1024 differ in fewer than three pairs in a million together. What passes is confirmed on the full sets.

Equal sets are one class, and no join makes pairs of the classes of a key:

- stars: a key has up to four centers, and a class is compared with the few centers of its keys that are closest to
  it. A center meets slices of ``STAR_ROWS`` of its classes, which may be any number; links make components;
- tiles: the classes of a key that are still in different components are dealt into blocks, and every two blocks meet in
  a tile. There sketches tell which classes have a partner left (a pair belongs to the first key that both share);
  only those send their sets to a second tile, which returns links of a spanning forest. Pairs stay within a tile.
  Of a key of several blocks, classes go first whose shingles are too much their own for any partner, and a component of
  a block's size has blocks of its own, which do not meet each other.

So a hot key is many tasks, and what is shuffled grows with the classes of a key times the blocks of other components
that may have partners, never with its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.llm import textkernel as k
from brindle.llm.common import map_batches, packed, slices, staged, utf8
from brindle.llm.components import connected_components

COMPONENTS, CHUNKED, CHUNKS = 64, 32, 10
SKETCH_BITS = 22
LONG, LONG_BITS = 1024, 148
#: Centers that a class is compared with, and classes of a center to a slice.
TRIED, STAR_ROWS = 2, 256
#: Classes of a block, and shingles of all its sets.
BLOCK_ROWS, BLOCK_SHINGLES = 512, 1 << 20
_rng = np.random.default_rng(991)
FLIPS = _rng.integers(0, 2**64, COMPONENTS, dtype=k.U)
FACTORS = _rng.integers(0, 2**64, COMPONENTS, dtype=k.U) | k.U(1)
TAGS = _rng.integers(0, 2**64, CHUNKED, dtype=k.U)
LONG_FLIPS = _rng.integers(0, 2**64, LONG, dtype=k.U)
LONG_FACTORS = _rng.integers(0, 2**64, LONG, dtype=k.U) | k.U(1)
CHUNK_OF = np.arange(CHUNKED) * CHUNKS // CHUNKED
CHUNK_START = np.searchsorted(CHUNK_OF, np.arange(CHUNKS))


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Each text's sorted distinct hashes of ``n`` words in a row; of all its words if it has fewer; empty without words."""
    buf, at = k.join(texts)
    buf = k.LOWER[buf]
    start, end = k.words(buf)
    first = np.searchsorted(start, at)
    count = np.diff(first)
    h = k.Substrings(buf).hashes(start, end)
    hashes, where = k.windows(h, np.repeat(np.arange(len(texts)), count), n)
    cut = np.searchsorted(where, first)
    out = []
    for i, c in enumerate(count.tolist()):
        if c >= n:
            out.append(np.unique(hashes[cut[i] : cut[i + 1]]))
        elif c:
            whole = np.full(1, c, k.U)
            for at in range(first[i], first[i + 1]):
                whole = whole * k.U(k.BASE) + h[at]
            out.append(k.mix(whole))
        else:
            out.append(np.zeros(0, k.U))
    return out


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For sets that are not empty: 16-bit components, ``(sets, CHUNKED)``, and 64-bit sketches."""
    flat = np.concatenate(sets)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    parts = np.empty((len(sets), CHUNKED), np.uint16)
    sketch = np.zeros(len(sets), k.U)
    for j in range(COMPONENTS):
        least = k.mix(np.minimum.reduceat((flat ^ FLIPS[j]) * FACTORS[j], at))
        if j < CHUNKED:
            parts[:, j] = least >> k.U(48)
        sketch |= (least & k.U(1)) << k.U(j)
    return parts, sketch


def long_sketches(sets: list[np.ndarray]) -> np.ndarray:
    """For sets that are not empty: one bit of ``LONG`` minimum hashes, ``(sets, LONG // 64)``."""
    flat = np.concatenate(sets)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.zeros((len(sets), LONG // 64), k.U)
    for j in range(LONG):
        least = k.mix(np.minimum.reduceat((flat ^ LONG_FLIPS[j]) * LONG_FACTORS[j], at))
        out[:, j // 64] |= (least & k.U(1)) << k.U(j % 64)
    return out


def keys_of(parts: np.ndarray) -> np.ndarray:
    """One key for each component left out of its chunk, ``(sets, CHUNKED)``."""
    codes = parts.astype(k.U) * FACTORS[:CHUNKED] * k.U(k.BASE)
    chunk = np.stack([codes[:, CHUNK_OF == c].sum(axis=1, dtype=k.U) for c in range(CHUNKS)], axis=1)
    return k.mix(chunk[:, CHUNK_OF] - codes + TAGS)


def _signed(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64), pa.int64())


def _signature_batch(n: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = utf8(batch.column("text"))
        size, sums, sketches, parts = (np.zeros(len(texts), np.int64), np.zeros((2, len(texts)), k.U), np.zeros(len(texts), k.U), [None] * len(texts))
        for i, j in slices([len(t) for t in texts]):
            sets = shingle_sets(texts[i:j], n)
            size[i:j] = [len(s) for s in sets]
            full = [s for s in sets if len(s)]
            if full:
                p, sketch = signatures(full)
                at = i + np.flatnonzero(size[i:j])
                sketches[at] = sketch
                sums[0, at] = [k.mix(s).sum(dtype=k.U) for s in full]
                sums[1, at] = [k.mix(s ^ k.U(k.BASE)).sum(dtype=k.U) for s in full]
                for row, to in zip(p, at.tolist(), strict=True):
                    parts[to] = row.tobytes()
        return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("mark"), pa.array(size), _signed(sums[0]), _signed(sums[1]), _signed(sketches), pa.array(parts, pa.binary())], names=["id", "mark", "n", "s1", "s2", "sketch", "parts"])

    return run


def _parts(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, CHUNKED)


def _key_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    repeat = pa.array(np.repeat(np.arange(batch.num_rows), CHUNKED))
    names = ["rep", "mark", "sketch"]
    return pa.RecordBatch.from_arrays([_signed(keys_of(_parts(batch.column("parts"))).ravel()), *[batch.column(c).take(repeat) for c in names]], names=["key", *names])


def _set_batch(n: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, kept, sets, wide = utf8(batch.column("text")), [], [], []
        for i, j in slices([len(t) for t in texts]):
            full = [(i + at, s) for at, s in enumerate(shingle_sets(texts[i:j], n)) if len(s)]
            if full:
                kept += [at for at, _ in full]
                wide += [w.tobytes() for w in long_sketches([s for _, s in full])]
                sets += [s.tobytes() for _, s in full]
        kept = pa.array(kept, pa.int64())
        columns = [batch.column("rep").take(kept), batch.column("mark").take(kept), pa.array([len(s) // 8 for s in sets], pa.int64()), pa.array(sets, pa.binary()), pa.array(wide, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["rep", "mark", "size", "shingles", "wide"])

    return run


def _tiles(batches: Iterator[pa.RecordBatch], tile: list[str]) -> Iterator[pa.Table]:
    """The rows of each tile, of batches that are sorted by tile."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = list(zip(*[batch.column(c).to_pylist() for c in tile], strict=True))
        cuts = [0, *[i for i in range(1, len(names)) if names[i] != names[i - 1]], len(names)]
        for a, z in zip(cuts, cuts[1:], strict=False):
            if held and names[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, z - a))
            last = names[a]
    if held:
        yield pa.Table.from_batches(held)


def by_tile(df: DataFrame, tile: list[str], fn: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """``fn`` of the rows of each tile, a tile in memory at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _tiles(batches, tile):
            yield from fn(table).to_batches()

    return df.repartition(*tile).sortWithinPartitions(*tile).mapInArrow(run, schema)


def _sets(column: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(x, k.U) for x in column.to_pylist()]


def linked(sets: list[np.ndarray], one: int, others: np.ndarray, percent: int) -> np.ndarray:
    """Those of ``others`` whose set is as similar to that of ``one`` as asked; sets are sorted and not empty."""
    own, out = sets[one], []
    for i, j in slices([len(sets[x]) for x in others]):
        part = others[i:j]
        sizes = np.array([len(sets[x]) for x in part])
        flat = np.concatenate([sets[x] for x in part])
        at = np.searchsorted(own, flat)
        at[at == len(own)] = 0
        common = np.add.reduceat((own[at] == flat).astype(np.int64), np.cumsum(sizes) - sizes)
        out.append(part[100 * common >= percent * (len(own) + sizes - common)])
    return np.concatenate(out) if out else others


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of a set."""
    for batch in batches:
        sets = _sets(batch.column("shingles"))
        for i, j in slices([len(s) for s in sets]):
            repeat = pa.array(np.repeat(np.arange(i, j), [len(s) for s in sets[i:j]]))
            yield pa.RecordBatch.from_arrays([batch.column("rep").take(repeat), batch.column("mark").take(repeat), _signed(np.concatenate(sets[i:j]))], names=["rep", "mark", "shingle"])


def _star(percent: int):
    """A slice of a center's classes: ``a``, ``b`` of those linked with it."""

    def run(table: pa.Table) -> pa.Table:
        center = table.column("center").to_numpy()
        sets, one = _sets(table.column("shingles")), int(np.flatnonzero(center)[0])
        hit = linked(sets, one, np.flatnonzero(~center), percent)
        rep = table.column("rep").combine_chunks()
        return pa.table({"a": rep.take(pa.array(hit)), "b": rep.take(pa.array(np.full(len(hit), one)))})

    return run


def candidates(table: pa.Table, percent: int, sketch_bits: int, long_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of a tile that may be similar and whose first shared key is the tile's."""
    own, low, high = table.column("own").to_numpy(), table.column("low")[0].as_py(), table.column("high")[0].as_py()
    sketch, size = table.column("sketch").to_numpy().view(k.U), table.column("size").to_numpy()
    wide = np.frombuffer(b"".join(table.column("wide").to_pylist()), k.U).reshape(len(sketch), -1)
    parts = _parts(table.column("parts"))
    which = int(np.flatnonzero(keys_of(parts[:1])[0].view(np.int64) == table.column("key")[0].as_py())[0])
    component = table.column("component").combine_chunks().dictionary_encode().indices.to_numpy()
    left = np.flatnonzero(own == low)
    right = left if low == high else np.flatnonzero(own == high)
    found = []
    for i in range(0, len(left), 128):
        x = left[i : i + 128]
        near = np.bitwise_count(sketch[x][:, None] ^ sketch[right][None, :]) <= sketch_bits
        near &= component[x][:, None] != component[right][None, :]
        if low == high:
            near &= x[:, None] < right[None, :]
        a, b = np.nonzero(near)
        a, b = x[a], right[b]
        few = 100 * np.minimum(size[a], size[b]) >= percent * np.maximum(size[a], size[b])
        a, b = a[few], b[few]
        for j in range(0, len(a), 1 << 16):
            c, d = a[j : j + (1 << 16)], b[j : j + (1 << 16)]
            differ = parts[c] != parts[d]
            errors = np.add.reduceat(differ, CHUNK_START, axis=1, dtype=np.int64)
            agree = errors[:, CHUNK_OF] == differ
            first = agree.argmax(axis=1) == which
            c, d = c[first], d[first]
            close = np.bitwise_count(wide[c] ^ wide[d]).sum(axis=1, dtype=np.int64) <= long_bits
            found.append((c[close], d[close]))
    return tuple(np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(2))


def _with_partner(percent: int, sketch_bits: int, long_bits: int):
    """Of a tile, the rows that have a candidate."""

    def run(table: pa.Table) -> pa.Table:
        a, b = candidates(table, percent, sketch_bits, long_bits)
        return table.take(pa.array(np.union1d(a, b).astype(np.int64)))

    return run


def _links(percent: int, sketch_bits: int, long_bits: int):
    """Of a tile with sets: ``a``, ``b`` of links that join its components; a pair that is joined already is left out."""

    def run(table: pa.Table) -> pa.Table:
        a, b = candidates(table, percent, sketch_bits, long_bits)
        sets, root = _sets(table.column("shingles")), np.arange(table.num_rows)
        order = np.argsort(a, kind="stable")
        a, b, left, right = a[order], b[order], [], []
        for i in np.unique(a).tolist():
            others = b[np.searchsorted(a, i) : np.searchsorted(a, i, side="right")]
            for x in linked(sets, i, others[root[others] != root[i]], percent).tolist():
                if root[x] != root[i]:
                    root[root == root[x]] = root[i]
                    left.append(i)
                    right.append(x)
        rep = table.column("rep").combine_chunks()
        return pa.table({"a": rep.take(pa.array(left, pa.int64())), "b": rep.take(pa.array(right, pa.int64()))})

    return run


def star_links(shared: DataFrame, sets: DataFrame, percent: int, sketch_bits: int) -> DataFrame:
    """``a``, ``b``: classes linked with one of the ``TRIED`` closest centers of their keys."""
    kind = shared.schema["rep"].dataType.simpleString()
    one, drawn = F.struct("rep", "mark", "sketch"), F.xxhash64("rep", "mark")
    centers = shared.groupBy("key").agg(F.array_distinct(F.array(F.min(one), F.max(one), F.min_by(one, drawn), F.max_by(one, drawn))).alias("centers"))
    centers = centers.select(F.col("key").alias("key2"), F.explode("centers").alias("c")).select("key2", F.col("c.rep").alias("crep"), F.col("c.mark").alias("cmark"), F.col("c.sketch").alias("csketch"))
    bits = F.bit_count(F.col("sketch").bitwiseXOR(F.col("csketch")))
    met = shared.join(centers, (F.col("key") == F.col("key2")) & (F.col("rep") != F.col("crep")) & (bits <= sketch_bits))
    # At most four centers a key: a class has a bounded number of them.
    closest = F.slice(F.sort_array(F.collect_set(F.struct(bits.alias("bits"), "crep", "cmark"))), 1, TRIED)
    stars = met.groupBy("rep", "mark").agg(closest.alias("c")).select("rep", "mark", F.explode("c").alias("c")).select("rep", "mark", "c.crep", "c.cmark")
    stars = staged(stars.join(sets.select("rep", "mark", "size"), ["rep", "mark"]), "stars")
    # A table of its own: the join can split a hot center. Slices are bounded in rows and, for long documents, in shingles.
    slices = F.greatest(F.ceil(F.count(F.lit(1)) / STAR_ROWS), F.ceil(F.sum("size") / BLOCK_SHINGLES))
    slices = staged(stars.groupBy("crep", "cmark").agg(slices.alias("slices")), "star-slices")
    stars = stars.join(slices, ["crep", "cmark"]).withColumn("slice", F.pmod(drawn, F.col("slices")))
    tile = ["crep", "cmark", "slice"]
    centers = stars.select(*tile).distinct().select(*tile, F.col("crep").alias("rep"), F.col("cmark").alias("mark"), F.lit(True).alias("center"))
    rows = stars.select(*tile, "rep", "mark", F.lit(False).alias("center")).union(centers)
    return by_tile(rows.join(sets.select("rep", "mark", "shingles"), ["rep", "mark"]), tile, _star(percent), f"a {kind}, b {kind}")


def _blocks(rows: Column, shingles: Column) -> Column:
    return F.greatest(F.ceil(rows / BLOCK_ROWS), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")


def _mixed(placed: DataFrame) -> DataFrame:
    """``placed`` without the keys whose classes are all in one component."""
    keys = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where(F.col("x") != F.col("y")).select("key")
    return placed.join(keys, "key")


def with_possible_partner(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``placed`` without classes that no class of their key can be linked with; keys of one block stay as they are.

    A shingle that one class alone has, of all in keys of several blocks, is in no intersection. A class with ``shared``
    others has a partner of at most ``shared * (100 + percent) / percent - size`` shingles, if the key has a set so small.
    """
    kind = placed.schema["rep"].dataType.simpleString()
    keys = placed.groupBy("key").agg(_blocks(F.count(F.lit(1)), F.sum("size")).alias("blocks"), F.min("size").alias("least"))
    keys = staged(keys.where("blocks > 1").select("key", "least"), "hot-keys")
    if keys.isEmpty():
        return placed
    hot = placed.join(keys, "key").select("rep", "mark").distinct()
    shingles = hot.join(sets.select("rep", "mark", "shingles"), ["rep", "mark"]).mapInArrow(_shingle_rows, f"rep {kind}, mark long, shingle long")
    alone = shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("rep"), F.min("mark").alias("mark")).where("n = 1")
    alone = alone.groupBy("rep", "mark").agg(F.count(F.lit(1)).alias("alone"))
    shared = F.col("size") - F.coalesce("alone", F.lit(0))
    possible = F.col("least").isNull() | (shared * (100 + percent) >= percent * (F.col("size") + F.col("least")))
    kept = placed.join(keys, "key", "left").join(alone, ["rep", "mark"], "left").where(possible)
    return staged(_mixed(staged(kept.select(placed.columns), "possible")), "mixed-possible")


def dealt_tiles(placed: DataFrame) -> DataFrame:
    """``placed`` with ``own``, a class's block, a row for each tile of two blocks ``low`` and ``high``.

    Components that would fill a block have blocks of their own, which meet all blocks of the key but each other.
    """
    groups = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("shingles"))
    large = (F.col("rows") >= BLOCK_ROWS) | (F.col("shingles") >= BLOCK_SHINGLES)
    groups = groups.groupBy("key", F.when(large, F.col("component")).alias("of")).agg(_blocks(F.sum("rows"), F.sum("shingles")).alias("blocks"))
    groups = groups.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("of", "blocks"))).alias("groups"))  # fewer than blocks
    before = lambda i: F.aggregate(F.slice("groups", 1, i), F.lit(0), lambda n, g: n + g["blocks"])
    groups = groups.select("key", F.transform("groups", lambda g, i: F.struct(g["of"], before(i).alias("start"), g["blocks"])).alias("groups"))
    dealt = placed.join(groups, "key").withColumn("_own", F.get(F.filter("groups", lambda g: g["of"] == F.col("component")), F.lit(0)))
    dealt = dealt.withColumn("_in", F.coalesce("_own", F.get(F.filter("groups", lambda g: g["of"].isNull()), F.lit(0))))
    dealt = dealt.withColumn("own", F.col("_in.start") + F.pmod(F.xxhash64("rep", "mark"), F.col("_in.blocks")).cast("int"))
    met = F.filter("groups", lambda g: ~g["of"].eqNullSafe(F.col("component")))
    others = F.flatten(F.transform(met, lambda g: F.sequence(g["start"], g["start"] + g["blocks"] - 1)))
    tiles = dealt.select(*placed.columns, "own", F.explode(others).alias("other"))
    return tiles.select(*placed.columns, "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))


def tile_links(shared: DataFrame, found: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, sketch_bits: int, long_bits: int) -> DataFrame:
    """``a``, ``b``: links between classes of one key whose components (``found``) differ so far."""
    kind = shared.schema["rep"].dataType.simpleString()
    placed = shared.join(found, shared["rep"] == found["node"], "left").select("key", "rep", "mark", F.coalesce("component", "rep").alias("component"))
    info = sets.select("rep", "mark", "size", "wide").join(classes.select("rep", "mark", "sketch", "parts"), ["rep", "mark"])
    placed = with_possible_partner(staged(_mixed(placed).join(info, ["rep", "mark"]), "mixed-keys"), sets, percent)
    tiles = dealt_tiles(placed).select("key", "low", "high", "own", "rep", "mark", "component", "size", "sketch", "parts", "wide")
    tile = ["key", "low", "high"]
    active = staged(by_tile(tiles, tile, _with_partner(percent, sketch_bits, long_bits), tiles.schema), "tiles")
    return by_tile(active.join(sets.select("rep", "mark", "shingles"), ["rep", "mark"]), tile, _links(percent, sketch_bits, long_bits), f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text", sketch_bits: int = SKETCH_BITS, long_bits: int = LONG_BITS) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_shingles``, ``component_id``, ``kept``.

    A document's set holds the distinct runs of ``n`` words, A-Z lower-cased; with fewer words all of them as one; null
    and empty texts have an empty set and link with nothing. Links need ``100 * common >= percent * united``, ties
    included. ``component_id`` is the smallest id reachable, ``kept`` tells whether that is the row's own. Rows of one id
    are one node, linked to whatever any of their texts is linked to. Rows without an id stay unlinked: their component
    is null and they are kept. Whole texts are read; a very long one has a set in proportion, which alone may fill a
    tile. An empty table gives an empty table. Signatures and sketches are made for a ``percent`` of 80 or more;
    ``sketch_bits`` of 64 and ``long_bits`` of 1024 leave only the signatures' own guarantee.
    """
    kind = docs.schema[id].dataType.simpleString()
    texts = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    rows = staged(map_batches(texts, _signature_batch(n), f"id {kind}, mark long, n long, s1 long, s2 long, sketch long, parts binary"), "signatures")
    named = rows.where((F.col("n") > 0) & F.col("id").isNotNull())
    same = ["s1", "s2", "n"]
    classes = named.groupBy(*same).agg(F.min(F.struct("id", "mark")).alias("one"), F.first("sketch").alias("sketch"), F.first("parts").alias("parts"))
    classes = staged(classes.select(*same, F.col("one.id").alias("rep"), F.col("one.mark").alias("mark"), "sketch", "parts"), "classes")

    keys = map_batches(classes.select("rep", "mark", "sketch", "parts"), _key_batch, f"key long, rep {kind}, mark long, sketch long")
    held = keys.groupBy("key").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).where(F.col("x") != F.col("y")).select("key")
    shared = staged(keys.join(held, "key"), "shared-keys")
    wanted = shared.select(F.col("rep").alias("id"), "mark").distinct()
    once = texts.join(wanted, ["id", "mark"]).dropDuplicates(["id", "mark"]).select(F.col("id").alias("rep"), "mark", "text")
    sets = staged(map_batches(once, _set_batch(n), f"rep {kind}, mark long, size long, shingles binary, wide binary"), "shingle-sets")

    # An id with several texts joins their classes.
    member = named.join(classes.select(*same, "rep"), same).select("id", "rep")
    several = member.groupBy("id").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).where(F.col("x") != F.col("y")).select("id")
    own = member.join(several, "id").where(F.col("id") != F.col("rep")).select(F.col("id").alias("a"), F.col("rep").alias("b"))
    links = staged(star_links(shared, sets, percent, sketch_bits).union(own), "links")
    found = connected_components(links)
    more = staged(tile_links(shared, found, classes, sets, percent, sketch_bits, long_bits), "tile-links")
    if not more.isEmpty():
        found = connected_components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))

    component = classes.join(found, classes["rep"] == found["node"], "left").select(*same, F.coalesce("component", "rep").alias("component"))
    linked_rows = rows.where(F.col("id").isNotNull()).join(component, same, "left").select("id", "n", F.coalesce("component", "id").alias("component"))
    out = linked_rows.union(rows.where(F.col("id").isNull()).select("id", "n", F.lit(None).cast(kind)))
    return out.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def dedup(docs: DataFrame, n: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id; of rows with one id, the least by its text's hash,
    then by all its columns written out.

    Rows without an id stay; null and empty texts are like none. Columns may have any names and types. Texts of any length are
    compared whole; an empty table gives an empty table.
    """
    judged = near_duplicates(docs, n, percent, id, text).where("kept").select(F.col(id).alias("_kept_id")).distinct()
    rows = docs.select(packed(docs).alias("_row"), F.col(id).alias("_own_id"), F.xxhash64(F.col(text)).alias("_mark"))
    kept = rows.join(judged, F.col("_own_id") == F.col("_kept_id"), "left_semi")
    repeated = rows.where(F.col("_own_id").isNotNull()).groupBy("_own_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    if not repeated.isEmpty():
        kept = kept.groupBy("_own_id").agg(F.min_by("_row", F.struct("_mark", F.to_json("_row"))).alias("_row"))
    out = kept.select("_row").union(rows.where(F.col("_own_id").isNull()).select("_row"))
    return out.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
