from __future__ import annotations

import random
import re

import numpy as np
import pytest

from brindle.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS, DOCS = "item_id long, text string, n_words int", "doc_id long, text string, start int, row string"


def words_of(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(items, docs, window):
    passages: dict[tuple, set] = {}
    for i, text, *_ in items:
        w = words_of(text)
        n = min(window, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            passages.setdefault(tuple(w[p : p + n]), set()).add(i)
    out = []
    for i, text, *_ in docs:
        w, hit, found = words_of(text), set(), set()
        for n in range(1, window + 1):
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in passages:
                    hit |= set(range(p, p + n))
                    found |= passages[tuple(w[p : p + n])]
        out.append((i, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return sorted(out, key=repr)


def got(docs, items, window=10):
    rows = decontaminate.contamination(docs, items, window).collect()
    for r in rows:
        assert sum(s.end - s.start for s in r.spans) == r.n_hit
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:], strict=False))
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in rows), key=repr)


def made(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "c", "Dd", "é9", "x1", "日本"]
    text = lambda n: rng.choice(["", "!! "]) + rng.choice([" ", ", ", "\n", "--"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 2, 3, 4, 7, 9, 10, 11, 14])), 0) for i in range(40)]
    items += [(None, text(10), 0), (3, text(12), 0), (100, None, 0), (101, "", 0), (7, items[7][1], 0)]
    docs = []
    for i in range(150):
        t = text(rng.choice([0, 1, 5, 20, 60]))
        docs.append((i, t + (f" {(rng.choice(items)[1] or '').upper().replace('É', 'é')} {text(3)}" if i % 3 == 0 else ""), 1, "x"))
    docs += [(None, text(30), 1, None), (5, docs[5][1], 1, None), (5, text(20), 1, None), (400, None, None, None), (401, "long " * 30000 + (items[5][1] or ""), 1, "")]
    return items, docs


@pytest.mark.parametrize("window", [10, 6])
def test_brute_force(spark, window):
    items, docs = made(window)
    assert got(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(items, ITEMS).repartition(3), window) == brute(items, docs, window)


def test_items_of_full_windows_alone(spark):
    items, docs = made(3)
    items = [x for x in items if len(words_of(x[1])) >= 10]
    assert got(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)) == brute(items, docs, 10)


def test_empty_tables(spark):
    items, docs = made(4)
    none = spark.createDataFrame([], ITEMS)
    assert got(spark.createDataFrame(docs[:20], DOCS), none) == brute([], docs[:20], 10)
    assert decontaminate.contamination(spark.createDataFrame([], DOCS), spark.createDataFrame(items, ITEMS)).count() == 0


def test_a_passage_that_all_documents_share(spark):
    passage = " ".join(f"word{i}" for i in range(14))
    docs = spark.range(3000).selectExpr("id AS doc_id", f"concat('only', id, ' {passage} end', id) AS text")
    items = spark.range(200).selectExpr("id AS item_id", f"'{passage}' AS text")
    rows = decontaminate.contamination(docs, items).collect()
    assert len(rows) == 3000 and {(r.n_words, r.n_hit, len(r["items"])) for r in rows} == {(16, 14, 200)}


def test_every_shared_span_has_a_shared_fingerprint_whatever_the_block(monkeypatch):
    rng = random.Random(9)
    text = " ".join(rng.choice("abcd") + rng.choice("xyz") for _ in range(700)).encode()
    whole = None
    for block in (1 << 16, 13, 1):
        monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
        parts = list(decontaminate.Words([text, b"", text[:100]]).passages(10, None))
        found = [np.concatenate(x) for x in zip(*parts, strict=True)]
        whole = whole or found
        assert all(np.array_equal(a, b) for a, b in zip(found, whole, strict=True))
    assert len(whole[0]) == 691 + 25  # of 700 and of 34 words
    assert len(np.unique(whole[1])) < len(whole[0]) / 2


def test_bitmap_holds_all_fingerprints(spark):
    rows = spark.range(50000).selectExpr("xxhash64(id) AS fp")
    bits = decontaminate._bitmap(rows)
    prints = np.array([r.fp for r in rows.collect()]).view(np.uint64)
    assert decontaminate.holds(bits, prints).all()
    others = np.array([r.fp for r in spark.range(50000).selectExpr("xxhash64(id, 1) AS fp").collect()]).view(np.uint64)
    assert decontaminate.holds(bits, others).mean() < 0.1
