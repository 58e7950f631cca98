"""BPE encoding and decoding with a vocabulary file of the ``tokenizers`` library.

Merges run over many words at once: the symbols of all new words of a batch lie in one flat array, a binary search
over the sorted pair keys gives each neighbouring pair its rank, and each round joins every word's lowest-ranked
pair. Work stays within tasks and batches; nothing is shuffled.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from brindle.llm.common import replace_columns, with_fields

#: Pieces whose ids a task remembers; beyond it the memory starts anew.
REMEMBERED_PIECES = 200_000
NONE = np.iinfo(np.int64).max
SEPARATORS = "\x1c\x1d\x1e\x1f"
#: A character of private use: neither white space nor letter nor number.
PRIVATE = "\ue000"

# Fixed values, of the Unicode Character Database: letters and numbers that version 16.0 added, and the lower-case
# forms that versions 16.0 and 17.0 added. The library knows these (and no later letter), whatever Python knows.
LETTERS_16 = """
1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D40-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B 1138E 11390-113B5 113B7
113D1 113D3 116D0-116E3 11BC0-11BE0 11BF0-11BF9 13460-143FA 16100-1611D 16130-16139 16D40-16D6C 16D70-16D79 18CFF
1CCF0-1CCF9 1E5D0-1E5ED 1E5F0-1E5FA
"""
LOWER_17 = "1C89>1C8A A7CB>0264 A7CC>A7CD A7CE>A7CF A7D2>A7D3 A7D4>A7D5 A7DA>A7DB A7DC>019B 10D50-10D65>10D70 16EA0-16EB8>16EBB"


def code_points(ranges: str) -> dict[int, int]:
    """``A-B>C`` as each code point from A to B with its own from C on (from A without C)."""
    out = {}
    for part in ranges.split():
        whole, _, to = part.partition(">")
        first, _, last = whole.partition("-")
        a, z = int(first, 16), int(last or first, 16)
        out |= {c: int(to or first, 16) + c - a for c in range(a, z + 1)}
    return out


LOWERED = code_points(LOWER_17)
UPPER_17 = frozenset(map(chr, LOWERED))


def byte_characters() -> list[str]:
    """The visible character that stands for each byte: itself if printable Latin-1, else the next from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class WordBpe:
    """The parsed vocabulary: normalising, splitting to words, merging."""

    def __init__(self, definition: str):
        d = json.loads(definition)
        model = d["model"]
        self.ids: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in d["added_tokens"]}
        self.find_special = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.pattern = regex.compile(d["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        size = max([*self.ids.values(), *self.special.values()]) + 1
        names = [""] * size
        for s, i in (*self.ids.items(), *self.special.items()):
            names[i] = s
        self.names = pa.array(names, pa.string())
        of = byte_characters()
        self.inner = np.array([self.ids[c] for c in of], np.int64)
        self.last = np.array([self.ids[c + suffix] for c in of], np.int64)
        left, right, to = (np.empty(len(model["merges"]), np.int64) for _ in range(3))
        for k, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left[k], right[k], to[k] = self.ids[a], self.ids[b], self.ids[a + b]
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.to = keys[order], order.astype(np.int64), to[order]
        # Joining all places of a pair in one round is right if no merge uses a symbol that a later merge makes.
        made = np.full(size, -1, np.int64)
        made[to[::-1]] = np.arange(len(to))[::-1]
        self.ordered = bool(np.all(np.maximum(made[left], made[right]) < np.arange(len(to))))
        # Letters and numbers that ``regex`` knows, but the library does not.
        every = "".join(map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x110000)]))
        self.later = frozenset(c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn") - set(map(chr, code_points(LETTERS_16)))
        self.known: dict[str, int] = {}
        self.flat = (np.zeros(0, np.int32), np.zeros(0, np.int64))

    def pieces(self, text: str) -> list[str]:
        """Runs between white space, in order, which no word crosses; a special token is a piece of its own."""
        if self.find_special and "<|" in text:
            out: list[str] = []
            for part in self.find_special.split(text):
                out += [part] if part in self.special else self._plain(part)
            return out
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # a final sigma is lowered like any other
            if not UPPER_17.isdisjoint(text):
                text = text.translate(LOWERED)
        text = text.lower()
        # str.split also takes 0x1C-0x1F for white space, which the pattern does not.
        return text.split() if not any(c in text for c in SEPARATORS) else regex.split(r"\s+", text.strip(" "))

    def split(self, piece: str) -> list[str]:
        """The words of a piece; characters of no known class go with punctuation."""
        if piece.isascii() or self.later.isdisjoint(piece):
            return self.pattern.findall(piece)
        masked = "".join(PRIVATE if c in self.later else c for c in piece)
        return [piece[m.start() : m.end()] for m in self.pattern.finditer(masked)]

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end, and each word's number of ids."""
        raw = [w.encode() for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbol = self.inner[data]
        symbol[ends - 1] = self.last[data[ends - 1]]
        word = np.repeat(np.arange(len(raw)), sizes)
        done_symbol, done_word = [], []
        while len(symbol):
            key = symbol[:-1] << 32 | symbol[1:]
            key[word[:-1] != word[1:]] = -1
            at = np.searchsorted(self.keys, key)
            at[at == len(self.keys)] = 0
            rank = np.where(self.keys[at] == key, self.ranks[at], NONE)
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            lowest = np.minimum.reduceat(np.concatenate([rank, [NONE]]), first)
            per = np.diff(np.concatenate([first, [len(symbol)]]))
            goes_on = np.repeat(lowest < NONE, per)
            done_symbol.append(symbol[~goes_on])
            done_word.append(word[~goes_on])
            low = np.repeat(lowest, per)[:-1]
            hit = np.flatnonzero((rank == low) & (low < NONE))
            if not len(hit):
                break
            if self.ordered:  # of overlapping places (aaa) every second one, from the left
                fresh = np.concatenate([[True], hit[1:] != hit[:-1] + 1])
                start = np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))
                hit = hit[(np.arange(len(hit)) - start) % 2 == 0]
            else:
                hit = hit[np.unique(word[hit], return_index=True)[1]]
            symbol[hit] = self.to[at[hit]]
            stays = goes_on
            stays[hit + 1] = False
            symbol, word = symbol[stays], word[stays]
        symbol, word = np.concatenate([*done_symbol, symbol[:0]]), np.concatenate([*done_word, word[:0]])
        order = np.argsort(word, kind="stable")
        return symbol[order], np.bincount(word, minlength=len(raw))

    def learn(self, pieces: list[str]) -> None:
        """Merge the words of new pieces and remember each piece's ids."""
        plain = [p for p in pieces if p not in self.special]
        special = [p for p in pieces if p in self.special]
        split = [self.split(p) for p in plain]
        words = {w: i for i, w in enumerate(dict.fromkeys(w for ws in split for w in ws))}
        ids, sizes = self.merge(list(words)) if words else (self.flat[0], self.flat[1][:0])
        start = np.concatenate([[0], np.cumsum(sizes)])
        which = np.fromiter((words[w] for ws in split for w in ws), np.int64)
        counts = sizes[which]
        before = np.concatenate([[0], np.cumsum(counts)])
        taken = ids[np.repeat(start[which] - before[:-1], counts) + np.arange(before[-1])]
        edges = np.concatenate([[0], np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))])
        at = len(self.known)
        self.known.update((p, at + i) for i, p in enumerate(plain + special))
        added = np.concatenate([np.diff(before[edges]), np.ones(len(special), np.int64)])
        self.flat = (np.concatenate([self.flat[0], taken, [self.special[p] for p in special]]).astype(np.int32), np.concatenate([self.flat[1], added]))

    def encode(self, texts: list[str | None]) -> pa.ListArray:
        """Ids of each text; null is an empty text."""
        if len(self.known) > REMEMBERED_PIECES:
            self.known, self.flat = {}, (self.flat[0][:0], self.flat[1][:0])
        split = [self.pieces(t) if t else [] for t in texts]
        new = list(set().union(*split).difference(self.known)) if split else []
        if new:
            self.learn(new)
        flat, sizes = self.flat
        start = np.concatenate([[0], np.cumsum(sizes)])
        get, offsets, parts, total = self.known.__getitem__, np.zeros(len(texts) + 1, np.int64), [], 0
        for i, ws in enumerate(split):
            n = np.fromiter(map(get, ws), np.int64, len(ws))
            counts = sizes[n]
            size = int(counts.sum())
            if size:
                shift = start[n] - np.concatenate([[0], np.cumsum(counts)[:-1]])
                parts.append(flat[np.repeat(shift, counts) + np.arange(size)])
            total += size
            offsets[i + 1] = total
        values = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """Token names joined by one space, which is what the file's missing decoder means."""
        ids = pc.fill_null(ids, pa.scalar([], ids.type))
        names = self.names.take(ids.flatten())
        offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(ids).to_numpy(zero_copy_only=False))])
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), names), " ")


@lru_cache(maxsize=2)
def _parsed(definition: str) -> WordBpe:
    return WordBpe(definition)


def _small(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def encode(df: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Every row of ``df`` with its text's ids, ``array<int>``, in column ``ids``.

    ``vocabulary``: path of the file, read by the driver alone; its text (a fixed size) goes to the tasks. Gives what
    the library does without special tokens of its own; the strings of special tokens in a text become their ids.
    Null and empty texts give an empty list, an empty table an empty table; rows are independent, so repeated rows
    repeat; whole texts are read, however long; an input column with the name ``ids`` is replaced.
    """
    definition = Path(vocabulary).read_text(encoding="utf-8")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _parsed(definition)
        for batch in _small(batches):
            yield replace_columns(batch, **{ids: bpe.encode(batch.column(batch.schema.get_field_index(text)).to_pylist())})

    return df.mapInArrow(run, with_fields(df.schema, **{ids: T.ArrayType(T.IntegerType())}))


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Every row of ``df`` with the text of its ids in column ``text``, special tokens included.

    A null or empty list gives an empty text, an empty table an empty table; lists of any length are read whole, repeated
    rows repeat; an input column with the name ``text`` is replaced.
    """
    definition = Path(vocabulary).read_text(encoding="utf-8")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _parsed(definition)
        for batch in _small(batches):
            yield replace_columns(batch, **{text: bpe.decode(batch.column(batch.schema.get_field_index(ids)))})

    return df.mapInArrow(run, with_fields(df.schema, **{text: T.StringType()}))
