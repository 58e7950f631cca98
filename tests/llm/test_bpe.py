from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from brindle.llm import bpe
from brindle.llm.queries import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
OURS = bpe.WordBpe(open(PATH, encoding="utf-8").read())
ODD = ["", " ", "aaaa aaaaaa a", "İstanbul ΣΑΣ ſ K", "<|endoftext|> x<|startoftext|>y <|end", "é ﬁ ① ½ 12345", "don't I'LL we've 's", "日本語 😀😀", "\x85  \x1c\x1dx\x1e", "a" * 3000, "\x00 \x01", "ab" * 5000]


def same(text):
    encoded = LIBRARY.encode(text, add_special_tokens=False).ids
    ours = OURS.encode([text])
    assert ours.to_pylist() == [encoded]
    assert OURS.decode(ours).to_pylist() == [LIBRARY.decode(encoded, skip_special_tokens=False)]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(max_codepoint=0x24F, exclude_categories=["Cs", "Cn"]), max_size=60))
def test_any_text(text):
    same(text)


def test_every_code_point():
    """Assigned or not, whatever version of Unicode the installed libraries know."""
    points = [chr(c) for c in (*range(0xD800), *range(0xE000, 0x110000))]
    for i in range(0, len(points), 8192):
        texts = [f"a{c}b 1{c}. {c}" for c in points[i : i + 8192]]
        want = [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]
        got = OURS.encode(texts).to_pylist()
        assert [t for t, x, y in zip(texts, want, got, strict=True) if x != y] == []


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=40))
def test_any_character(text):
    same(text)


def test_merges_one_at_a_time_agree():
    words = ["aaaa", "banana", "mississippi", "zzzzzzz", "thethethe"]
    fast = OURS.merge(words)
    OURS.ordered = False
    slow = OURS.merge(words)
    OURS.ordered = True
    assert all((a == b).all() for a, b in zip(fast, slow, strict=True))


def test_table(spark, docs, no_docs):
    out = bpe.decode(bpe.encode(docs.withColumnRenamed("n_chars", "ids"), PATH), PATH)
    assert out.columns == ["doc_id", "text", "lang", "source", "ids", "decoded"]
    for r in out.collect():
        ids = LIBRARY.encode(r.text or "", add_special_tokens=False).ids
        assert list(r.ids) == ids and r.decoded == LIBRARY.decode(ids, skip_special_tokens=False)
    assert bpe.decode(bpe.encode(no_docs, PATH), PATH).count() == 0


def test_memory_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_PIECES", 3)
    one = bpe.WordBpe(open(PATH, encoding="utf-8").read())
    for text in ("a b c d e", "f a", "a b g"):
        assert one.encode([text]).to_pylist() == [LIBRARY.encode(text, add_special_tokens=False).ids]
