from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from brindle.llm import suffixdedup


def brute(rows, n):
    first = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    big = 1 << 62
    for i, b in data:
        for p in range(len(b) - n + 1):
            s = b[p : p + n]
            first[s] = min(first.get(s, big), big if i is None else i)
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - n + 1):
            if first[b[p : p + n]] < (big if i is None else i):
                gone[p : p + n] = b"\1" * n
        runs = sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
        out.append((i, len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def check(df, n=50):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixdedup.remove_repeats(df, n).collect()]
    assert sorted(got, key=repr) == brute(rows, n)


def test_brute_force(docs):
    check(docs.select("doc_id", "text"))


def test_small_chunks(docs, monkeypatch):
    monkeypatch.setattr(suffixdedup, "CHUNK", 700)
    check(docs.select("doc_id", "text"), 40)


def test_blocks_do_not_show(texts, monkeypatch):
    raw = [(t or "").encode() for t in texts]
    z = suffixdedup._zip
    chunk = suffixdedup.Chunk(z(np.arange(len(raw))), z(np.array([len(t) for t in raw])), z(b"".join(raw)), 50)
    windows = lambda runs: {(int(h), int(s) + i, int(at)) for h, _, s, n, at in zip(*runs, strict=True) for i in range(int(n))}
    whole = windows(chunk.runs())
    monkeypatch.setattr(suffixdedup, "BLOCK", 150)
    assert windows(chunk.runs()) == whole and len(whole) == sum(max(len(t) - 49, 0) for t in raw)


def test_a_passage_in_many_surroundings(spark):
    rng = random.Random(9)
    words = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))
    passage = words(30)
    check(spark.createDataFrame([(i, words(rng.randint(0, 9)) + passage[rng.randint(0, 3) :] + words(9)) for i in range(60)], "doc_id long, text string").repartition(6))


def test_ids_that_are_no_numbers(spark):
    with pytest.raises(TypeError):
        suffixdedup.remove_repeats(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


@pytest.mark.parametrize("seed", range(3))
def test_random_strings_over_few_letters(spark, seed):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("ab") for _ in range(rng.randint(20, 200))) for _ in range(8)]
    rows = [(i, "".join(rng.choice(pool)[rng.randint(0, 9) :] + rng.choice(["", "é", "x"]) for _ in range(rng.randint(0, 4)))) for i in range(40)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), 30)


def test_null_ids_repeated_ids_and_empty(spark, no_docs):
    s = "the quick brown fox jumps over the lazy dog and runs far away from here"
    rows = [(None, s), (None, s + "!"), (3, "z" + s), (3, s), (1, s[:60]), (2, None), (4, "")]
    check(spark.createDataFrame(rows, "doc_id long, text string"))
    assert suffixdedup.remove_repeats(no_docs).count() == 0


def test_buckets_over_batches_and_ranges():
    """However rows are cut to batches, every bucket is told whole; at a range's edges nothing is ruled out."""
    rng = random.Random(4)
    rows = sorted((rng.randrange(12), rng.randrange(5), rng.randrange(4)) for _ in range(200))
    columns = {"chunk": [i for i in range(200)], "bucket": [b for b, _, _ in rows], "stretch": [b * 10 + s for b, s, _ in rows], "at": list(range(200)), "doc": [d for _, _, d in rows], "sides": [s % 2 for _, s, _ in rows]}
    schema = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("stretch", pa.int64()), ("at", pa.int32()), ("doc", pa.int64()), ("sides", pa.int32())])
    batch = pa.RecordBatch.from_pydict(columns, schema=schema)
    want = None
    for size in (200, 1, 7, 30):
        got = sorted((r["chunk"], r["shared"]) for part in suffixdedup._point(batch.slice(i, size) for i in range(0, 200, size)) for r in part.to_pylist())
        want = want or got
        assert got == want
    least = {}
    for b, s, d in rows:
        least[b, s] = min(d, least.get((b, s), d))
    told = dict(want)
    for i, (b, s, d) in enumerate(rows):
        if d > least[b, s]:
            assert told[i] == -1
        elif b in (rows[0][0], rows[-1][0]):
            assert told[i] == 15
        else:
            others = {x for c, x in least if c == b and x != s}
            assert (told[i] & 1 > 0) == any(x % 2 == s % 2 for x in others) if others else i not in told
