"""Removal of byte strings that repeat across documents, by bucket refinement of sampled suffixes.

A window of ``length`` bytes names one of its positions, that of its least q-gram hash, so equal windows name equal
places (about one byte in 16 is such an anchor). Anchors fall into buckets by their q-gram. A bucket is refined by the
buckets of offsets around it: first by the whole stretch of windows that share the anchor, then, only where
stretches of one bucket differ, window by window, each window's bucket being made of those of its q-grams at later
offsets (``B20 -> B40 -> B50``, every name reused for the next). A bucket's pointer is the smallest document in it. Texts
lie in compressed chunks, which lie in buckets of files, so that what a chunk is told comes to its text:

1. each chunk sends the hashes of its anchors, a few bytes each, and learns which stand in a second document;
2. each chunk sends a row for each different stretch around those, with its smallest document; sorted by bucket and
   stretch, they tell which stretches a smaller document has, and where stretches of one bucket differ whether another
   has the same 8 or 15 bytes on either side of the q-gram;
3. of the latter, the chunk of a stretch's smallest document sends a row for each different window that may be
   another's too, and learns which windows a smaller document has.

Rows of 2 are cut into ranges, so that a bucket may span many tasks; of 3, a name has a row for each chunk at most. So a
string that a third of all documents share costs each chunk a row, whatever stands around it. Nothing is gathered on
the driver.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from brindle.llm import textkernel as k
from brindle.llm.common import bucketed, staged

Q = 20
CHUNK = 4 << 20
BLOCK = 1 << 18
#: Bytes of text to a range of hashes, at least; there are also at least four times as many ranges as shuffle partitions.
RANGE_BYTES = 32 << 20
NO_ID = np.iinfo(np.int64).max
#: ``live`` has a chunk's stretches in one row of its own; the other rows have one stretch each.
STRETCHES = "chunk long, bucket int, stretch long, at int, doc long, sides int, live binary"
#: Bytes on either side of the q-gram by which stretches of a bucket are told apart first.
NEAR, FAR = 8, 15
NAMES = "chunk long, name long, at int, doc long"


def _zip(a: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(a if isinstance(a, bytes) else a.tobytes())


def _unzip(b: bytes, kind=None):
    raw = zstandard.ZstdDecompressor().decompress(b)
    return raw if kind is None else np.frombuffer(raw, kind)


def _planes(values: np.ndarray) -> bytes:
    """Whole numbers byte by byte of equal weight, compressed."""
    return _zip(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T))


def _from_planes(b: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(_unzip(b, np.uint8).reshape(size, -1).T).view(kind).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as differences."""
    return _planes(np.diff(values, prepend=k.U(0)))


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(_from_planes(b, k.U), dtype=k.U)


def _chunks(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            raw = b"".join(texts)
            sizes = np.array([len(t) for t in texts], np.int64)
            row = [secrets.randbits(62), len(raw), _zip(np.array(ids, np.int64)), _zip(np.array(missing, bool)), _zip(sizes), _zip(raw)]
            return pa.RecordBatch.from_pylist([dict(zip(("chunk", "n_bytes", "ids", "missing", "sizes", "raw"), row, strict=True))])

        ids, missing, texts, total = [], [], [], 0
        for batch in batches:
            for id, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                t = text.as_py()
                ids.append(NO_ID if id is None else id)
                missing.append(id is None)
                texts.append(b"" if t is None else t.encode())
                total += len(texts[-1])
                if total >= limit:
                    yield out()
                    ids, missing, texts, total = [], [], [], 0
        if ids:
            yield out()

    return run


class Chunk:
    """Documents end to end, and their runs: windows in a row that name one anchor."""

    def __init__(self, ids: bytes, sizes: bytes, raw: bytes, length: int):
        self.ids, self.sizes = _unzip(ids, np.int64), _unzip(sizes, np.int64)
        self.buf = np.frombuffer(_unzip(raw), np.uint8)
        self.length = length
        self.ends = np.cumsum(self.sizes)

    def runs(self) -> tuple[np.ndarray, ...]:
        """Of each run: its q-gram hash, document's place in the chunk, first window, number of windows, anchor's place."""
        n, w = self.length, self.length - Q + 1
        parts = []
        for at in range(0, len(self.buf), BLOCK):
            part = self.buf[at : at + BLOCK + n - 1]
            if len(part) < n:
                break
            z = k.mix(k.Substrings(part).fixed(Q))
            least, where = z, np.arange(len(z), dtype=np.int32)
            step, have = 1, 1
            while have < w:
                step = min(have, w - have)
                a, b = least[:-step], least[step:]
                less = b < a
                where = np.where(less, where[step:], where[:-step])
                least = np.where(less, b, a)
                have += step
            s = np.arange(len(least))
            doc = np.searchsorted(self.ends, s + at, side="right")
            ok = self.ends[np.minimum(doc, len(self.ends) - 1)] >= s + at + n
            new = np.ones(len(s), bool)
            new[1:] = (where[1:] != where[:-1]) | (doc[1:] != doc[:-1])
            new &= ok
            first = np.flatnonzero(new)
            if not len(first):
                continue
            count = np.bincount((np.cumsum(new) - 1)[ok], minlength=len(first))
            parts.append((least[first], doc[first], first + at, count, where[first] + at))
        if not parts:
            return tuple(np.zeros(0, t) for t in (k.U, np.int64, np.int64, np.int64, np.int64))
        return tuple(np.concatenate([p[i] for p in parts]) for i in range(5))


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """One at a time: a row holds a chunk. Lists stay Arrow arrays, null stays none."""
    for i in range(batch.num_rows):
        row = {name: column[i] for name, column in zip(batch.schema.names, batch.columns, strict=True)}
        yield {name: x.values if isinstance(x, pa.ListScalar) else x.as_py() for name, x in row.items()}


def _stored(row: dict, length: int) -> Chunk:
    return Chunk(row["ids"], row["sizes"], row["raw"], length)


def _by_range(z: np.ndarray, ranges: int):
    """Order by range and value, and the cuts between ranges that are there."""
    part = (z % k.U(ranges)).astype(np.int64)
    order = np.lexsort((z, part))
    part = part[order]
    cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
    return order, part, cut, np.concatenate([cut[1:], [len(part)]]) if len(part) else cut


def _short(z: np.ndarray, ids: np.ndarray, drop: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shortened hashes, and which of them two documents of the chunk share."""
    short = z >> k.U(drop)
    order = np.lexsort((ids, short))
    short, ids = short[order], ids[order]
    first = np.concatenate([[True], short[1:] != short[:-1]])
    start = np.flatnonzero(first)
    if not len(short):
        return short, np.zeros(0, bool)
    return short[start], np.minimum.reduceat(ids, start) != np.maximum.reduceat(ids, start)


def _send_hashes(length: int, ranges: int, drop: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                c = _stored(row, length)
                z, doc, *_ = c.runs()
                short, shared = _short(z, c.ids[doc], drop)
                order, part, cut, end = _by_range(short, ranges)
                if len(cut):
                    yield pa.RecordBatch.from_pylist([{"range": int(part[a]), "chunk": row["chunk"], "hashes": pack_sorted(short[order[a:e]]), "shared": np.packbits(shared[order[a:e]]).tobytes()} for a, e in zip(cut, end, strict=True)])

    return run


def _repeated(table: pa.Table) -> pa.Table:
    """Of one range: for each chunk a bit for each of its hashes, set if another document has it too."""
    values = [unpack_sorted(b) for b in table.column("hashes").to_pylist()]
    shared = [np.unpackbits(np.frombuffer(b, np.uint8), count=len(v)).astype(bool) for b, v in zip(table.column("shared").to_pylist(), values, strict=True)]
    every = np.sort(np.concatenate([*values, *[v[s] for v, s in zip(values, shared, strict=True)]]))
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    bits = []
    for v in values:
        at = np.searchsorted(twice, v)
        hit = np.zeros(len(v), bool)
        inside = at < len(twice)
        hit[inside] = twice[at[inside]] == v[inside]
        bits.append(np.packbits(hit).tobytes())
    return pa.table({"range": table.column("range"), "chunk": table.column("chunk"), "bits": pa.array(bits, pa.binary())}).filter(pa.array([any(b) for b in bits]))


def _places(row: dict, z: np.ndarray, ids: np.ndarray, ranges: int, drop: int) -> np.ndarray:
    """Which anchors stand in a second document, by what the chunk is told in ``repeated``."""
    short, _ = _short(z, ids, drop)
    order, part, cut, end = _by_range(short, ranges)
    bits = {b["range"]: b["bits"] for b in row["repeated"].to_pylist()}
    live = np.zeros(len(short), bool)
    for a, e in zip(cut, end, strict=True):
        if (b := bits.get(int(part[a]))) is not None:
            live[order[a:e]] = np.unpackbits(np.frombuffer(b, np.uint8), count=e - a)
    return live[np.searchsorted(short, z >> k.U(drop))]


def _sides(buf: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """A byte's worth of hash of the ``NEAR`` and ``FAR`` bytes before the q-gram at each anchor, and of those behind it."""
    out = np.zeros(len(anchor), np.uint32)
    factors = k.BYTE_CODES[1][:FAR].astype(np.uint32) | np.uint32(1)
    for i in range(0, len(anchor), 1 << 16):
        at = anchor[i : i + (1 << 16), None]
        for shift, sign, begin in ((0, -1, 1), (16, 1, Q)):
            near = buf[np.clip(at + sign * (begin + np.arange(FAR)), 0, len(buf) - 1)].astype(np.uint32) + np.uint32(1)
            near *= factors
            for more, n in ((0, NEAR), (8, FAR)):
                h = near[:, :n].sum(axis=1, dtype=np.uint32)
                h ^= h >> np.uint32(15)
                h *= np.uint32(0x2C1B3C6D)
                out[i : i + (1 << 16)] |= (h >> np.uint32(24)) << np.uint32(shift + more)
    return out.view(np.int32)


def _send_stretches(length: int, ranges: int, drop: int):
    names = [("chunk", pa.int64()), ("bucket", pa.int32()), ("stretch", pa.int64()), ("at", pa.int32()), ("doc", pa.int64()), ("sides", pa.int32()), ("live", pa.binary())]
    schema = pa.schema(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                c = _stored(row, length)
                z, doc, start, count, anchor = c.runs()
                ids = c.ids[doc]
                alive = _places(row, z, ids, ranges, drop)
                z, ids, start, count, anchor = z[alive], ids[alive], start[alive], count[alive], anchor[alive]
                if not len(z):
                    continue
                h = k.mix(_hashes(c.buf, start, count + length - 1) * k.U(k.BASE) + z)
                order = np.lexsort((start, ids, h))
                z, h, ids, start, count, anchor = (x[order] for x in (z, h, ids, start, count, anchor))
                new = np.concatenate([[True], h[1:] != h[:-1]])
                first = np.flatnonzero(new)
                live = b"".join([np.int64(len(z)).tobytes(), start.astype(np.int64).tobytes(), count.astype(np.uint8).tobytes(), (anchor - start).astype(np.uint8).tobytes(), np.packbits(new).tobytes()])
                n = len(first)
                columns = [np.full(n, row["chunk"]), (z[first] >> k.U(32)).astype(np.uint32).view(np.int32), h[first].view(np.int64), np.arange(n, dtype=np.int32), ids[first], _sides(c.buf, anchor[first])]
                yield pa.RecordBatch.from_arrays([*[pa.array(x) for x in columns], pa.nulls(n, pa.binary())], schema=schema)
                yield pa.RecordBatch.from_pylist([{"chunk": row["chunk"], "live": _zip(live)}], schema=schema)

    return run


def _pointed(rows: pa.Table, edge: bool) -> pa.RecordBatch:
    """Of whole buckets, sorted by bucket, stretch and document: ``chunk``, ``at``, ``shared``.

    ``shared`` is -1 for a stretch that a smaller document has. Where stretches differ it holds for the smallest document's a
    bit for each side hash that another stretch has too; all at the ``edge`` of a range, beyond which there may be others.
    """
    bucket, stretch, doc, sides = (rows.column(c).to_numpy() for c in ("bucket", "stretch", "doc", "sides"))
    other = np.concatenate([[True], bucket[1:] != bucket[:-1]])
    new = other | np.concatenate([[True], stretch[1:] != stretch[:-1]])
    first, of = np.flatnonzero(new), np.cumsum(new) - 1
    gone = doc > doc[first][of]
    which = (np.cumsum(other) - 1)[first]
    differ = np.full(len(first), True) if edge else np.bincount(which)[which] > 1
    shared = np.zeros(len(first), np.int64)
    for i in range(4):
        key = which << 8 | sides[first].view(np.uint32) >> np.uint32(8 * i) & np.uint32(0xFF)
        _, place, times = np.unique(key, return_inverse=True, return_counts=True)
        shared |= ((times[place] > 1) | edge).astype(np.int64) << i
    told = np.where(gone, -1, shared[of])
    some = pa.array(np.flatnonzero(gone | differ[of]))
    return pa.RecordBatch.from_arrays([rows.column("chunk").combine_chunks().take(some), rows.column("at").combine_chunks().take(some), pa.array(told.astype(np.int8)).take(some)], names=["chunk", "at", "shared"])


def _point(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_pointed`` over a range of stretches, as many whole buckets at a time as a batch brings to an end."""
    held: list[pa.RecordBatch] = []
    edge = True  # the first bucket of a range
    for batch in batches:
        bucket = batch.column("bucket").to_numpy()
        if not len(bucket):
            continue
        cut = int(np.searchsorted(bucket, bucket[-1]))  # where the batch's last bucket begins
        begun = held and held[-1].column("bucket")[held[-1].num_rows - 1].as_py() == bucket[0]
        head = int(np.searchsorted(bucket, bucket[0], side="right")) if begun else 0
        if held and (not begun or head < len(bucket)):
            yield _pointed(pa.Table.from_batches([*held, batch.slice(0, head)]), edge)
            held, edge = [], False
        elif begun:
            held.append(batch)
            continue
        if cut > head:
            middle = batch.slice(head, cut - head)
            if edge:  # a range's first bucket by itself
                one = int(np.searchsorted(bucket[head:cut], bucket[head], side="right"))
                yield _pointed(pa.Table.from_batches([middle.slice(0, one)]), True)
                middle, edge = middle.slice(one), False
            if middle.num_rows:
                yield _pointed(pa.Table.from_batches([middle]), False)
        held = [batch.slice(max(cut, head))]
    if held:
        yield _pointed(pa.Table.from_batches(held), True)


def _hashes(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Of stretches in ascending order, section by section of the buffer."""
    out, i = np.zeros(len(start), k.U), 0
    while i < len(start):
        a = int(start[i])
        j = int(np.searchsorted(start, a + BLOCK, side="left"))
        out[i:j] = k.Substrings(buf[a : a + BLOCK + 512]).hashes(start[i:j] - a, start[i:j] - a + size[i:j])
        i = j
    return out


def window_buckets(buf: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Bucket names of the windows that start at ``at``: a q-gram's, refined by those at later offsets; the last two
    q-grams overlap where ``Q`` does not divide ``length``."""
    grams = k.mix(k.Substrings(buf, family=1).fixed(Q))
    name, have = grams[at], Q
    while have < length:
        have = min(have + Q, length)
        name = k.mix(name * k.U(k.BASE) + grams[at + have - Q])
    return name


class Live:
    """A chunk's stretches around repeated anchors, by equal stretch and document."""

    def __init__(self, chunk: Chunk, live: bytes, told: pa.StructArray | None):
        raw = _unzip(live)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        self.chunk = chunk
        self.start = np.frombuffer(raw, np.int64, n, 8)
        self.count, lead = (np.frombuffer(raw, np.uint8, n, 8 + i * n).astype(np.int64) for i in (8, 9))
        new = np.unpackbits(np.frombuffer(raw, np.uint8, offset=8 + 10 * n), count=n).astype(bool)
        self.first, self.of = np.flatnonzero(new), np.cumsum(new) - 1
        self.lead = lead[self.first]
        self.ids = chunk.ids[np.searchsorted(chunk.ends, self.start, side="right")]
        self.least = self.ids[self.first]
        self.shared, self.differ = np.zeros(len(self.first), np.int8), np.zeros(len(self.first), bool)
        if told is not None:
            at, shared = told.field("at").to_numpy(), told.field("shared").to_numpy()
            self.shared[at], self.differ[at] = shared, shared >= 0
        self.gone = self.shared < 0

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the stretches that differ from others of their buckets, each window that may be another's too: its stretch,
        its offset and its bucket's name."""
        which = np.flatnonzero(self.differ)
        n = self.count[self.first[which]]
        stretch = np.repeat(which, n)
        offset = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        before, bits = self.lead[stretch] - offset, self.shared[stretch]
        behind = self.chunk.length - Q - before
        may = np.ones(len(stretch), bool)
        for i, (reach, least) in enumerate(((before, NEAR), (before, FAR), (behind, NEAR), (behind, FAR))):
            may &= (reach < least) | (bits >> i & 1 > 0)
        stretch, offset = stretch[may], offset[may]
        return stretch, offset, _names(self.chunk.buf, self.start[self.first[stretch]] + offset, self.chunk.length)

    def smallest(self, stretch: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct names in order, the smallest document of each in this chunk, and each window's place among them."""
        names, place = np.unique(name, return_inverse=True)
        doc = np.full(len(names), NO_ID)
        np.minimum.at(doc, place, self.least[stretch])
        return names, doc, place

    def removed(self, lost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of what goes; ``lost`` are the places of names that a smaller document elsewhere has."""
        length = self.chunk.length
        whole = self.gone[self.of] | (self.ids > self.least[self.of])
        start, end = [self.start[whole]], [self.start[whole] + self.count[whole] + length - 1]
        stretch, offset, name = self.windows()
        if len(name):
            names, doc, place = self.smallest(stretch, name)
            hit = np.zeros(len(names), bool)
            hit[lost] = True
            lose = hit[place] | (self.least[stretch] > doc[place])
            # All places of the stretch in its smallest document lose these windows.
            n = np.where(self.differ, self.count[self.first], 0)
            before = np.cumsum(n) - n
            hit = np.zeros(int(n.sum()), bool)
            hit[before[stretch[lose]] + offset[lose]] = True
            mine = np.flatnonzero(~whole & self.differ[self.of])
            row = np.repeat(mine, self.count[mine])
            move = np.arange(len(row)) - np.repeat(np.cumsum(self.count[mine]) - self.count[mine], self.count[mine])
            at = hit[before[self.of[row]] + move]
            start.append(self.start[row[at]] + move[at])
            end.append(start[-1] + length)
        return np.concatenate(start), np.concatenate(end)


def _send_names(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                live = Live(_stored(row, length), row["live"], row["told"])
                stretch, _, name = live.windows()
                names, doc, _ = live.smallest(stretch, name)
                n = len(names)
                columns = [np.full(n, row["chunk"]), names.view(np.int64), np.arange(n, dtype=np.int32), doc]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["chunk", "name", "at", "doc"])

    return run


def _names(buf: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """``window_buckets`` of windows in ascending or any order, section by section of the buffer."""
    out = np.zeros(len(at), k.U)
    most = BLOCK
    section = at // most
    order = np.argsort(section, kind="stable")
    cut = np.searchsorted(section[order], np.arange(section.max() + 2)) if len(at) else [0, 0]
    for s in range(len(cut) - 1):
        i = order[cut[s] : cut[s + 1]]
        if len(i):
            out[i] = window_buckets(buf[s * most : (s + 1) * most + length], at[i] - s * most, length)
    return out


def _apply(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                c = _stored(row, length)
                missing = _unzip(row["missing"], bool)
                mark = np.zeros(len(c.buf) + 1, np.int32)
                if row["live"] is not None:
                    start, end = Live(c, row["live"], row["told"]).removed(np.zeros(0, np.int64) if row["lost"] is None else row["lost"].to_numpy())
                    np.add.at(mark, start, 1)
                    np.add.at(mark, end, -1)
                gone = np.cumsum(mark[:-1]) > 0
                edge = gone.copy()
                edge[1:] &= ~gone[:-1]
                begin = c.ends - c.sizes
                inner = begin[(c.sizes > 0)]
                edge[inner] = gone[inner]
                total, runs = np.concatenate([[0], np.cumsum(gone)]), np.concatenate([[0], np.cumsum(edge)])
                kept = [c.buf[a:e][~gone[a:e]].tobytes() for a, e in zip(begin.tolist(), c.ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.ids, mask=missing), pa.array(c.sizes), pa.array(total[c.ends] - total[begin]), pa.array(runs[c.ends] - runs[begin]), pa.array(kept, pa.binary())],
                    names=["id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    return run


def remove_repeats(docs: DataFrame, length: int = 50, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (bytes).

    A byte goes if a string of ``length`` bytes (``Q`` to 255) covers it that also starts in a document with a smaller
    id; strings are judged on the input and never cross documents. Ids are whole numbers (others raise ``TypeError``); a
    row without an id counts as larger than any other, and rows of equal id do not remove from each other. Null and
    empty texts have no bytes; whole texts are read, and one longer than a chunk is a chunk. An empty table gives an empty
    table; other columns are not read.
    """
    spark = docs.sparkSession
    if not isinstance(docs.schema[id].dataType, IntegralType):
        raise TypeError(f"ids must be whole numbers, {id} is {docs.schema[id].dataType.simpleString()}")
    texts = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    chunks = bucketed(texts.mapInArrow(_chunks(CHUNK), "chunk long, n_bytes long, ids binary, missing binary, sizes binary, raw binary"), "chunks", "chunk")
    text_of = chunks.select("chunk", "ids", "sizes", "raw")
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    ranges = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_BYTES))
    drop = max(0, 64 - max(40, int(total).bit_length() + 12))

    hashes = text_of.mapInArrow(_send_hashes(length, ranges, drop), "range long, chunk long, hashes binary, shared binary")
    repeated = staged(hashes.groupBy("range").applyInArrow(_repeated, "range long, chunk long, bits binary"), "repeated-hashes")
    repeated = repeated.groupBy("chunk").agg(F.collect_list(F.struct("range", "bits")).alias("repeated"))
    sent = staged(text_of.join(repeated.hint("merge"), "chunk").mapInArrow(_send_stretches(length, ranges, drop), STRETCHES), "stretches")
    live = sent.where("live IS NOT NULL").select("chunk", "live")
    stretches = sent.where("live IS NULL").drop("live").repartitionByRange("bucket", "stretch").sortWithinPartitions("bucket", "stretch", "doc")
    told = stretches.mapInArrow(_point, "chunk long, at int, shared byte").groupBy("chunk").agg(F.collect_list(F.struct("at", "shared")).alias("told"))
    told = staged(live.join(told.hint("merge"), "chunk", "left"), "told-stretches")

    names = text_of.join(told.hint("merge"), "chunk").mapInArrow(_send_names(length), NAMES)
    least = F.min("doc").over(Window.partitionBy("name"))  # a row for each chunk at most
    lost = names.withColumn("least", least).where("least < doc").groupBy("chunk").agg(F.collect_list("at").alias("lost"))
    out = chunks.join(told.join(lost.hint("merge"), "chunk", "left").hint("merge"), "chunk", "left").mapInArrow(_apply(length), "id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.select(F.col("id").alias(id), "n_bytes", "n_removed", "n_spans", "kept")
