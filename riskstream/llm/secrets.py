"""Secret scan: fixed patterns, and values in a credential context that are costly to guess.

The cost of a value, in bits, is that of its cheapest segmentation into common words, dates,
repeats, keyboard walks and brute-force spans, found by dynamic programming over its characters.
A value beside a credential word is a secret from ``MIN_BITS`` on.

Spans are in code points, end exclusive, sorted by start and then by kind. A ``cost`` span covers the
value alone and is left out where fixed patterns already cover all of it.

Defined results: null counts as the empty text, without spans. Texts of any length are scanned
whole, and values of any length segmented whole, in linear time. Segmentations of equal cost are alike, as
only the cost counts. Repeated rows are scanned one by one. An empty table gives no rows. Only ``text`` is
read to find secrets; other columns, whatever their names, pass through where rows are kept.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame

from riskstream.llm import storage

KINDS = ("assign", "access", "hex", "cost")
MIN_BITS = 50.0

# fixed values: the patterns of the three base kinds
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS = 6, 20

# credential words of four languages, some of which the base pattern does not know; lower case
CONTEXT_WORDS = (
    "password", "passwd", "passphrase", "passcode", "pwd", "secret", "token", "api_key", "apikey", "api-key",
    "access_key", "access-key", "private_key", "private-key", "credential", "bearer", "authorization",
    "passwort", "kennwort", "contraseña", "contrasena", "mot de passe", "motdepasse",
)
_ANY_WORD = "|".join(re.escape(word) for word in CONTEXT_WORDS)
# after a sign any value counts; after white space or "is" only one with a digit; a value in quotes goes to the closing
# one, any other to white space or the next key, and a scheme before it is no part of it
CONTEXT = re.compile(
    rf"""(?:{_ANY_WORD})s?["']?(\s*(?:[:=]|=>|:=)\s*|\s+(?:is|ist|es|est)\s+|\s+)(?:(?:basic|digest|bearer)\s+)?"""
    r"""(?:"([^"\n]{8,})"|'([^'\n]{8,})'|`([^`\n]{8,})`|["'`]?((?:(?![,;&][\w-]+[=:])[^\s"'`<>]){8,}))""",
    re.IGNORECASE | re.ASCII,
)
#: What may follow an unquoted value and is no part of it.
_TRAILING = ".:!?,;)]}"
_UNQUOTED = 5
# the longest credential word with its plural and a sign behind it
_TAIL = max(map(len, CONTEXT_WORDS)) + 3
_KEYS = tuple(word.encode() for word in CONTEXT_WORDS)

# common passwords and words by frequency, most frequent first
COMMON_WORDS = (
    "password", "admin", "letmein", "welcome", "monkey", "dragon", "master", "login", "hello", "secret", "test",
    "user", "root", "guest", "access", "shadow", "love", "sunshine", "princess", "football", "baseball", "super",
    "default", "change", "changeme", "summer", "winter", "spring", "autumn", "january", "february", "march", "april",
    "june", "july", "august", "september", "october", "november", "december", "monday", "friday", "sunday", "the",
    "and", "you", "my", "is", "not", "this", "that", "your", "key", "token", "pass", "word", "example", "sample",
    "none", "null", "true", "false", "value", "string", "name", "data", "server", "client", "public", "private",
    "company", "office", "home", "house", "computer", "internet", "money", "freedom", "whatever", "trust", "batman",
    "superman", "michael", "jordan", "charlie", "thomas", "ashley", "daniel", "please", "enter", "here", "insert",
)
KEY_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz", "0123456789")

_WORD_BITS = {word: log2(rank + 2) for rank, word in enumerate(COMMON_WORDS)}
_LONGEST_WORD = max(map(len, COMMON_WORDS))
_UNLEET = str.maketrans("4310$5@7", "aeioasat")
_DATE = re.compile(
    r"(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01]))?"
    r"|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)?\d\d"
)
_STEP = {row[k : k + 2] for row in KEY_ROWS for k in range(len(row) - 1)}
_STEP |= {step[::-1] for step in _STEP}


def _brute_bits(character: str) -> float:
    if character.isdigit():
        return log2(10)
    if character.isalpha():
        return log2(26)
    return log2(33)


def _ends(value: str, low: str) -> tuple[list[int], list[int], list[int]]:
    """Per place: the end of the repeat from there, that of the keyboard walk, and the next changed character."""
    n = len(value)
    repeat, walk, changed = [n] * n, [n] * n, [n] * n
    for at in range(n - 1, -1, -1):
        if at + 1 < n:
            repeat[at] = repeat[at + 1] if value[at] == value[at + 1] else at + 1
            walk[at] = walk[at + 1] if low[at : at + 2] in _STEP else at + 1
            changed[at] = changed[at + 1]
        if value[at] != low[at]:
            changed[at] = at
    return repeat, walk, changed


def guess_bits(value: str) -> float:
    """The least cost of any segmentation of ``value``, in bits."""
    low = value.lower() if len(value.lower()) == len(value) else value
    plain = low.translate(_UNLEET)
    repeat, walk, changed = _ends(value, low)

    def spans_from(at: int) -> Iterator[tuple[int, float]]:
        """Ends and bits of the patterns that start at ``at``."""
        for end in range(at + 2, min(len(value), at + _LONGEST_WORD) + 1):
            bits = _WORD_BITS.get(low[at:end])
            leet = 0.0
            if bits is None and (bits := _WORD_BITS.get(plain[at:end])) is not None:
                leet = 1.0
            if bits is not None:
                capitals = sum(c.isupper() for c in value[at:end])
                yield end, bits + leet + (0.0 if capitals in (0, end - at) else 1.0 + log2(1 + capitals))
        if date := _DATE.match(value, at):
            yield date.end(), log2(365 * 120) if date.end() - at > 4 else log2(120)
        if (end := repeat[at]) - at >= 3:
            yield end, _brute_bits(value[at]) + log2(end - at)
        if (end := walk[at]) - at >= 3:
            yield end, log2(len(KEY_ROWS) * 10) + log2(end - at) + (1.0 if changed[at] < end else 0.0)

    cost = [0.0] + [float("inf")] * len(value)
    for at in range(len(value)):
        here = cost[at]
        cost[at + 1] = min(cost[at + 1], here + _brute_bits(value[at]))
        for end, bits in spans_from(at):
            cost[end] = min(cost[end], here + bits + 1.0)  # one bit for taking a pattern here
    return cost[-1]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans, those that overlap or touch as one."""
    merged: list[tuple[int, int]] = []
    for start, end in spans:
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], end))
        else:
            merged.append((start, end))
    return merged


def find(text: str | None, min_bits: float = MIN_BITS) -> list[tuple[str, int, int]]:
    """All spans of a text: kind, start, end."""
    if not text:
        return []
    folded = text.encode("utf-8", "surrogatepass").lower()  # of bytes: A-Z only
    spans = []
    credential = any(key in folded for key in _KEYS)
    if credential:
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    if credential:
        base = _merged(sorted((start, end) for _, start, end in spans))
        at = seen = done = 0
        while m := CONTEXT.search(text, seen):
            start, end = whole = m.span(m.lastindex)
            # the value may be a credential word itself; of one that is a span only the tail can lead further
            seen, tail = start, max(start, end - _TAIL)
            if end <= done:
                seen = tail
                continue
            if m.lastindex == _UNQUOTED:
                end = start + len(text[start:end].rstrip(_TRAILING))
            while at < len(base) and base[at][1] <= start:
                at += 1
            if at < len(base) and base[at][0] <= start and end <= base[at][1]:
                seen = tail
                continue
            signed = m[1].strip().lower() not in ("", "is", "ist", "es", "est")
            value = text[start:end]
            if (signed or any(c.isdigit() for c in value)) and guess_bits(value) >= min_bits:
                spans.append(("cost", start, end))
                seen, done = tail, whole[1]
    return sorted(spans, key=lambda span: (span[1], KINDS.index(span[0]), span[2]))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def scan(docs: DataFrame, min_bits: float = MIN_BITS) -> DataFrame:
    """doc_id, ``spans`` (array of kind, start, end) and ``base_sha256`` (of the fixed kinds) of every row."""

    def run(batches):
        for batch in batches:
            found = [find(text.as_py(), min_bits) for text in batch.column(1)]
            digest = [hashlib.sha256(joined(s for s in row if s[0] != "cost").encode()).hexdigest() for row in found]
            spans = pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in row] for row in found], pa.list_(_SPAN))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), spans, pa.array(digest, pa.string())], names=["doc_id", "spans", "base_sha256"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return storage.texts(docs).select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>, base_sha256 string"
    )


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def redact(docs: DataFrame, mark: str = "[SECRET]", min_bits: float = MIN_BITS) -> DataFrame:
    """``docs`` with every span replaced by ``mark`` (spans that overlap by one mark); other columns as they are."""

    def covered(text: str | None) -> str | None:
        spans = find(text, min_bits)
        if not spans:
            return text
        parts, at = [], 0
        for _, start, end in spans:
            if start >= at:
                parts += [text[at:start], mark]
            at = max(at, end)
        return "".join([*parts, text[at:]])

    place = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = pa.array([covered(text.as_py()) for text in batch.column(place)], pa.string())
            yield batch.set_column(place, batch.schema.field(place), texts.cast(batch.schema.field(place).type))

    return storage.texts(docs).mapInArrow(run, docs.schema)
