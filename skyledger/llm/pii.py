"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, digits, plus signs, schemes,
cue words and the first characters of keys. From an anchor a small parser walks as far as its alphabet goes and
validates what it has. Every parser reads each character of a text a bounded number of
times, so long runs of digits or letters cost no more than others.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import taken

# The kinds in the order of their listing, first the base ones.
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("url", "address", "account", "key")
KINDS = (*BASE_KINDS, *ADDED_KINDS)

#: Words before an identifier, as written in lower case; also found capitalised and in
#: capitals.
CUES = ("account", "iban", "passport", "password", "secret", "ssn", "token", "api_key", "api key")
#: Words that end a postal address.
STREETS = ("street", "avenue", "road", "lane", "boulevard", "drive", "square")
SCHEMES = ("http://", "https://", "ftp://")
# How keys of well-known services begin, and how many letters, digits, hyphens
# and underscores follow at least and at most.
KEY_STARTS = {
    "AKIA": (16, 16),
    "ASIA": (16, 16),
    "AIza": (35, 35),
    "ghp_": (36, 36),
    "github_pat_": (22, 255),
    "glpat-": (20, 64),
    "sk_live_": (16, 255),
    "xoxb-": (20, 255),
    "xoxp-": (20, 255),
}
#: Encoded keys stand between lines that name them; the name ends with KEY.
BLOCK_START, BLOCK_END = "-----BEGIN ", "-----END "

_DIGITS = frozenset("0123456789")
_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_LOCAL = _DIGITS | _LETTERS | frozenset("._%+-")
_LABEL = _DIGITS | _LETTERS | frozenset("-")
_PHONE = _DIGITS | frozenset(" ().-")
_SPACE = frozenset(" \t\n\v\f\r")
_URL_END = _SPACE | frozenset("\"'<>`{}|\\^")
_VALUE = _DIGITS | _LETTERS | frozenset("-_")


@cache
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, words in {
        "@": ["@"],
        "+": ["+"],
        "0": sorted(_DIGITS),
        "url": SCHEMES,
        "account": [f(w) for w in CUES for f in (str, str.capitalize, str.upper)],
        "address": [f(w) for w in STREETS for f in (str, str.capitalize, str.upper)],
        "key": sorted(KEY_STARTS),
        "block": [BLOCK_START],
    }.items():
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def _walk(text: str, at: int, alphabet: frozenset[str]) -> int:
    """The end of the run of ``alphabet`` that starts at ``at``."""
    n = len(text)
    while at < n and text[at] in alphabet:
        at += 1
    return at


def _email(text: str, sign: int, floor: int) -> tuple[int, int] | None:
    start = sign
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    end = _walk(text, sign + 1, _LABEL)
    if start == sign or end == sign + 1:
        return None
    labels = 1
    while end + 1 < len(text) and text[end] == "." and text[end + 1] in _LABEL:
        end = _walk(text, end + 1, _LABEL)
        labels += 1
    return (start, end) if labels > 1 else None


def _ips(text: str, digit: int) -> tuple[list[tuple[int, int]], int]:
    """The groups of digits joined by single dots, four by four; and where they end."""
    groups, at = [], digit
    while True:
        end = _walk(text, at, _DIGITS)
        groups.append((at, end))
        if end + 1 >= len(text) or text[end] != "." or text[end + 1] not in _DIGITS:
            break
        at = end + 1
    fours = [groups[k : k + 4] for k in range(0, len(groups) - 3, 4)]
    # at most 255 without leading zeros' help: parts of any length are compared as numbers
    fits = [f for f in fours if all(len(p := text[a:b].lstrip("0")) <= 3 and int(p or 0) <= 255 for a, b in f)]
    return [(f[0][0], f[3][1]) for f in fits], end


def _card(text: str, digit: int) -> tuple[tuple[int, int] | None, int]:
    """The digits with at most one space or hyphen between two; and where they end."""
    end, n, digits = digit + 1, len(text), [text[digit]]
    while end < n:
        if text[end] in _DIGITS:
            digits.append(text[end])
            end += 1
        elif text[end] in " -" and end + 1 < n and text[end + 1] in _DIGITS:
            digits.append(text[end + 1])
            end += 2
        else:
            break
    if not 14 <= len(digits) <= 19:
        return None, end
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) << (k & 1)
        total += d - 9 * (d > 9)
    return ((digit, end) if total % 10 == 0 else None), end


def _phone(text: str, plus: int) -> tuple[int, int] | None:
    if plus + 1 >= len(text) or text[plus + 1] not in _DIGITS:
        return None
    end = _walk(text, plus + 2, _PHONE)
    while end > plus + 3 and text[end - 1] not in _DIGITS:
        end -= 1
    if end <= plus + 3:
        return None
    digits = sum(c in _DIGITS for c in text[plus:end])
    return (plus, end) if 10 <= digits <= 15 else None


def _url(text: str, start: int, after: int) -> tuple[int, int] | None:
    end, n = after, len(text)
    while end < n and text[end] not in _URL_END:
        end += 1
    while end > after and text[end - 1] in ".,;:!?)]":
        end -= 1
    return (start, end) if end > after else None


def _account(text: str, start: int, after: int) -> tuple[int, int] | None:
    """The identifier after a cue, at most one of ``: = #`` and at most one opening quote or
    bracket: six characters or more that hold a digit."""
    if start and text[start - 1] in _LETTERS:
        return None
    at = _walk(text, after, _SPACE)
    if at < len(text) and text[at] in ":=#":
        at = _walk(text, at + 1, _SPACE)
    if at < len(text) and text[at] in "\"'`([{<":
        at += 1
    end = _walk(text, at, _VALUE)
    fits = at > after and end - at >= 6 and any(c in _DIGITS for c in text[at:end])
    return (at, end) if fits else None


def _address(text: str, start: int, end: int) -> tuple[int, int] | None:
    """A house number of up to five digits, one to four words, and a word for a street."""
    if end < len(text) and text[end] in _LETTERS:
        return None
    at = start
    for words in range(5):
        if not at or text[at - 1] != " ":
            return None
        head, at = at - 1, at - 1
        while at and text[at - 1] not in _SPACE and head - at < 40:
            at -= 1
        word = text[at:head]
        if words and 0 < len(word) <= 5 and all(c in _DIGITS for c in word):
            return at, end
        if not word[:1].isupper():
            return None
    return None


def _key(text: str, start: int, after: int) -> tuple[int, int] | None:
    """A key that stands by itself, of the length that its beginning asks for."""
    if start and text[start - 1] in _VALUE:
        return None
    least, most = KEY_STARTS[text[start:after]]
    end = _walk(text, after, _VALUE)
    return (start, end) if least <= end - after <= most and any(c in _DIGITS for c in text[after:end]) else None


def _block(text: str, start: int, after: int, ends: dict[str, int]) -> tuple[int, int] | None:
    """From the line that begins a key to the next that ends it. ``ends`` remembers where
    that of each name was found last, so that no stretch is searched twice."""
    stop = text.find("-----", after, after + 64)
    if stop < 0 or not text[after:stop].endswith("KEY"):
        return None
    last = f"{BLOCK_END}{text[after:stop]}-----"
    found = ends.get(last, 0)
    if 0 <= found < stop:
        found = ends[last] = text.find(last, stop)
    return (start, found + len(last)) if found >= 0 else None


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all spans, by start and then kind as listed."""
    spans: list[tuple[str, int, int]] = []
    ends: dict[str, int] = {}
    after = dict.fromkeys(("email", "ip", "card", "phone", "url"), 0)  # end of the last walk

    def add(kind: str, span: tuple[int, int] | None) -> None:
        if span:
            spans.append((kind, *span))

    for last, (anchor, width) in _automaton().iter(text):
        start = last + 1 - width
        if anchor == "@":
            span = _email(text, last, after["email"])
            add("email", span)
            after["email"] = span[1] if span else last + 1
        elif anchor == "0":
            if last >= after["ip"]:
                found, after["ip"] = _ips(text, last)
                spans += [("ip", *s) for s in found]
            if last >= after["card"]:
                span, after["card"] = _card(text, last)
                add("card", span)
        elif anchor == "+":
            add("phone", _phone(text, last))
        elif anchor == "url":
            if start >= after["url"]:
                span = _url(text, start, last + 1)
                add("url", span)
                after["url"] = span[1] if span else last + 1
        elif anchor == "account":
            add("account", _account(text, start, last + 1))
        elif anchor == "key":
            add("key", _key(text, start, last + 1))
        elif anchor == "block":
            add("key", _block(text, start, last + 1, ends))
        else:
            add("address", _address(text, start, last + 1))
    order = {kind: k for k, kind in enumerate(KINDS)}
    return sorted(set(spans), key=lambda s: (s[1], order[s[0]], s[2]))


def personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id and ``spans``, an array of (kind, start, end).

    Positions are code points, ends exclusive. Null and empty texts have no spans; other
    columns are ignored. Works row by row: no shuffle.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            found = [
                [{"kind": k, "start": a, "end": b} for k, a, b in find(text)] if text else []
                for text in taken(batch, "text")
            ]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, kind)], ["id", "spans"])

    kept = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    schema = f"id {kept}, spans array<struct<kind: string, start: int, end: int>>"
    return rows.mapInArrow(scan, schema).withColumnRenamed("id", id_column)


