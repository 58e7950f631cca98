from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from brindle.llm import prefixtrie

TURNS = "conv_id long, turn long, role string, text string, depth int, k1 string"


def brute(rows, every=5, most=9):
    convs: dict[int, list] = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).digest(), text or ""))
    said = {c: [(r, t) for _, _, r, _, t in sorted(v)] for c, v in convs.items()}
    members: dict[tuple, list] = {}
    for c in sorted(said):
        h = zlib.crc32(str(c).encode()) % most
        whole = tuple(said.get(c - c % every, [])[:h] + said[c][h:])
        for d in range(len(whole) + 1):
            members.setdefault(whole[:d], []).append((c, len(whole) == d))
    children: dict[tuple, list] = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    totals: dict[tuple, list] = {path: [0, 0] for path in members}
    for path, own in members.items():
        leaf, saved = path not in children, (len(own) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            totals[path[:d]][0] += leaf
            totals[path[:d]][1] += saved
    out = []
    for path, own in members.items():
        ends = ",".join(str(c) for c, end in own if end)
        out.append((own[0][0], len(path), members[path[:-1]][0][0] if path else None, len(own), len(children.get(path, [])), *totals[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df, **how):
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r[c] for c in columns) for r in prefixtrie.trie(df, **how).collect()), key=repr)


def made(seed, convs=60, longest=14, words=2):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(convs * 2), convs):
        for turn in range(rng.randint(1, longest)):
            rows.append((c, turn, rng.choice(["user", "assistant"]) if turn > 2 else "user", " ".join(rng.choice(["é", "b"]) for _ in range(rng.randint(1, words))), 1, "x"))
    rows += [(3, None, None, None, 1, ""), (3, None, "user", "", 1, ""), (3, 0, "user", "b", 1, ""), (3, 0, "user", "b", 1, ""), (3, 0, "a", "z", 1, ""), (None, 1, "user", "b", 1, ""), (-7, 1, "user", "b", 1, "")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("height", [2, 8])
def test_brute_force(spark, height):
    rows = made(height)
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    df = df.where("conv_id IS NULL OR conv_id >= 0")
    assert got(df, height=height) == brute([r for r in rows if r[0] != -7])


def test_deep_conversations_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "BLOCK", 10)
    rng = random.Random(4)
    base = [("user", rng.choice("ab")) for _ in range(200)]
    rows = []
    for c in range(12):
        own = base[: rng.randint(100, 200)] + [("assistant", rng.choice("ab")) for _ in range(40)]
        rows += [(c, i, *said, 0, "") for i, said in enumerate(own)]
    assert got(spark.createDataFrame(rows, TURNS).repartition(3), height=3) == brute(rows)
    assert got(spark.createDataFrame(rows, TURNS), most=1) == brute(rows, most=1)


def test_one_conversation_has_most_turns(spark):
    rows = [(10, i % 7 if i % 2 else None, "user", "x" * (i % 3), 0, "") for i in range(500)] + made(8, 5)
    rows = [r for r in rows if r[0] is None or r[0] >= 0]
    assert got(spark.createDataFrame(rows, TURNS).repartition(6)) == brute(rows)


def test_many_conversations_end_in_one_node(spark):
    df = spark.range(30000).selectExpr("id AS conv_id", "0L AS turn", "'user' AS role", "'hello' AS text")
    told = {r.depth: r for r in prefixtrie.trie(df, most=1).collect()}
    assert len(told) == 2 and told[1].n_convs == 30000 and told[0].saved_tokens == 29999 * 5
    assert told[1].ends_sha256 == hashlib.sha256(",".join(map(str, range(30000))).encode()).hexdigest()


def test_empty(spark):
    assert got(spark.createDataFrame([], TURNS)) == []
    assert got(spark.createDataFrame([(None, 1, "user", "b", 1, "")], TURNS)) == []
