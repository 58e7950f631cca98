"""Secret scans: an Aho-Corasick pass over keywords, anchored patterns at its hits, then embedded checks.

Work stays within a row; nothing is shuffled. Three kinds are the base and are judged by pattern and length alone:

- ``assign``: a credential keyword, ``:`` or ``=``, and a value of 8 or more characters;
- ``access``: ``AKIA`` and capitals or digits, 16 or more characters;
- ``hex``: 32 or more lower-case hexadecimal digits.

The others carry something that can be verified, and only verified ones are reported:

- ``github`` and ``npm``: tokens whose last six characters are the CRC-32 of the 30 before, in base 62;
- ``jwt``: three base64url parts, the first a JSON object with ``alg``;
- ``card``: 13 to 19 digits right after a card keyword, with a right Luhn digit;
- ``pem``: a private key block whose body is base64 and whose end names the same key.

No two parts of a pattern that may repeat accept the same character, and what a failed match has read is not read again
for its kind, so a text takes time in proportion to its length.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import string
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from brindle.llm.common import replace_columns, with_fields

KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "card", "pem")
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
TOKEN = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
JWT = re.compile(r"(eyJ[A-Za-z0-9_-]++)\.eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++")
JWT_RUN = re.compile(r"[A-Za-z0-9_-]++")
CARD = re.compile(r"(?ai:card|visa|mastercard)[\x20:#=]{1,3}(\d(?:[\x20-]?\d){12,18})(?!\d)")
PEM = re.compile(r"-----BEGIN ((?:[A-Z]{1,32} )?PRIVATE KEY)-----([A-Za-z0-9+/=\s]*+)-----END \1-----")
#: Keyword (in lower case) -> the kind whose pattern is tried there.
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign",
    "akia": "access", "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github", "npm_": "npm",
    "eyj": "jwt", "card": "card", "visa": "card", "mastercard": "card", "-----begin ": "pem",
}
BASE62 = string.digits + string.ascii_uppercase + string.ascii_lowercase
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
HEX = np.zeros(256, bool)
HEX[list(b"0123456789abcdef")] = True
LEAST_HEX, LEAST_VALUE, LEAST_ACCESS = 32, 8, 16


def checksum62(body: str) -> str:
    """CRC-32 in six base-62 digits."""
    n, out = binascii.crc32(body.encode()), ""
    for _ in range(6):
        n, r = divmod(n, 62)
        out = BASE62[r] + out
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _verified(kind: str, m: re.Match) -> bool:
    if kind == "assign":
        return len(m[1]) >= LEAST_VALUE
    if kind == "access":
        return len(m[0]) >= LEAST_ACCESS
    if kind in ("github", "npm"):
        return checksum62(m[1]) == m[2]
    if kind == "card":
        return luhn(re.sub(r"\D", "", m[1]))
    try:
        if kind == "jwt":
            head = json.loads(base64.urlsafe_b64decode(m[1] + "=" * (-len(m[1]) % 4)))
            return isinstance(head, dict) and "alg" in head
        body = "".join(m[2].split())
        return body != "" and m[2][0].isspace() and len(base64.b64decode(body, validate=True)) > 0
    except (ValueError, RecursionError):
        return False


def _run_end(text: str, at: int) -> int:
    """Where to go on after a JWT has failed at ``at``: at every later place of a run of its characters it fails too,
    as what follows the run is the same."""
    run = JWT_RUN.match(text, at)
    return run.end() if run else at + 1


PATTERNS = {"assign": ASSIGN, "access": ACCESS, "github": TOKEN, "npm": TOKEN, "jwt": JWT, "card": CARD, "pem": PEM}


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        found.add_word(word, (len(word), kind))
    found.make_automaton()
    return found


def hex_runs(text: str) -> list[tuple[int, int]]:
    """Whole runs of 32 or more hexadecimal digits. Such a run holds a character at a multiple of 32: only where one
    of these is a digit, edges are looked for."""
    codes = np.frombuffer(text.encode("latin-1", "replace"), np.uint8)  # one byte a character; no other becomes a digit
    if not HEX[codes[LEAST_HEX - 1 :: LEAST_HEX]].any():
        return []
    digit = np.concatenate([[False], HEX[codes], [False]])
    edge = np.flatnonzero(digit[1:] != digit[:-1])
    low, high = edge[0::2], edge[1::2]
    long = high - low >= LEAST_HEX
    return list(zip(low[long].tolist(), high[long].tolist(), strict=True))


def spans(text: str) -> list[tuple[int, int, str]]:
    """All spans of a text, ``(start, end, kind)`` by start, then kind as in ``KINDS``."""
    low = text.lower()
    if len(low) != len(text):
        low = text.translate(ASCII_LOWER)
    out = [(a, z, "hex") for a, z in hex_runs(text)]
    past = dict.fromkeys(KINDS, 0)
    hits = sorted((end - size + 1, kind) for end, (size, kind) in _automaton().iter(low))
    for at, kind in hits:
        # Leftmost and not overlapping per kind: a match, kept or not, uses its characters up.
        if at < past[kind]:
            continue
        if m := PATTERNS[kind].match(text, at):
            past[kind] = m.end()
            if _verified(kind, m):
                out.append((m.start(), m.end(), kind))
        elif kind == "jwt":
            past[kind] = _run_end(text, at)
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def scan(df: DataFrame, text: str = "text", found: str = "spans") -> DataFrame:
    """Every row of ``df`` with its text's spans, ``array<struct<kind,start,end>>`` in code points, in column ``found``.

    Null and empty texts give an empty list; whole texts are read, however long; rows are independent, so repeated
    rows repeat; an input column with the name ``found`` is replaced.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[{"kind": k, "start": a, "end": z} for a, z, k in spans(t)] if t else [] for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            yield replace_columns(batch, **{found: pa.array(rows, ARROW_SPANS)})

    return df.mapInArrow(run, with_fields(df.schema, **{found: SPANS}))
