"""Byte-pair encoding by a deterministic automaton over tokens, and decoding by its labels.

The automaton reads tokens. At first it has one state with an arc for every byte symbol.
For each merge (a, b) -> c, in order, the merge gadget changes it: the state that a leads
to is copied without its arc b, a leads to the copy, and wherever an arc a was followed by
b there is now an arc c to where b led. Afterwards a sequence of tokens has a path exactly
if the merges give that sequence, so a word has one path and its arcs are its tokens.

A token's arcs all lead to one state, and an arc c starts wherever an arc a starts at the
time of the merge. So tokens form a tree (the parent of c is a), and an arc b that a state
loses at some merge takes with it the arcs of those tokens that come from b later. With
the later children first, they are an interval of the tree's preorder: a state is a short
sorted list of intervals of tokens that it has no arc for, and the whole automaton two
flat tables. An encoder looks each candidate token up there.
"""

from __future__ import annotations

import json
import re
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skyledger.llm.common import pieces, taken

#: Chunks of text whose ids a worker remembers, and how long they may be.
REMEMBERED, REMEMBERED_CHARS = 1_000_000, 64
#: Texts whose ids are in memory at a time.
TEXTS = 256

# Fixed value: the normaliser that the library describes so.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
# Fixed value: the split that the library describes so.
_SPLIT = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
_SPACES = re.compile("[\t-\r \x85\xa0]+")

#: Follows the last character of a word inside the automaton.
_END = "\x00"


class Automaton:
    """The merges of a vocabulary, compiled."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        made = {a + b for a, b in merges}
        if len(made) < len(merges):
            raise ValueError("two merges make the same token")
        base = [t for t in vocabulary if t not in made]
        # tokens as the characters they read; an end of word is one more character
        reads = {t: t.removesuffix(suffix) + _END if len(t) > 1 and t.endswith(suffix) else t for t in base}
        for a, b in merges:
            reads[a + b] = reads[a] + reads[b]
        self.labels = {number: token for token, number in vocabulary.items()}
        self._order(base, merges, vocabulary)
        self._gadgets(merges, vocabulary)
        #: Every start of a token's characters; with the token's number if it is the whole.
        self.heads: dict[str, int] = {}
        for token, text in reads.items():
            if vocabulary[token] in self.never:
                continue
            for k in range(1, len(text)):
                self.heads.setdefault(text[:k], -1)
            self.heads[text] = vocabulary[token]

    def _order(self, base: list[str], merges: list[tuple[str, str]], vocabulary: dict[str, int]) -> None:
        """Preorder numbers by token number, later children first; and sizes of subtrees."""
        children: dict[str, list[str]] = {}
        for a, b in merges:
            children.setdefault(a, []).append(a + b)
        most = max(vocabulary.values()) + 1
        self.place, size = array("i", [0]) * most, array("i", [1]) * most
        for a, b in reversed(merges):
            size[vocabulary[a]] += size[vocabulary[a + b]]
        at = 0
        for root in base:
            todo = [root]
            while todo:
                token = todo.pop()
                self.place[vocabulary[token]] = at
                at += 1
                todo += children.get(token, ())  # the latest is taken first
        self._size = size

    def _gadgets(self, merges: list[tuple[str, str]], vocabulary: dict[str, int]) -> None:
        size, place = self._size, self.place
        none: tuple[list[int], list[int]] = ([], [])
        state = {number: none for number in vocabulary.values()}
        older = array("i", [0]) * len(size)  # arcs from children that a token has so far
        #: Tokens that no word has, as their parts never meet.
        self.never: set[int] = set()
        for left, right in merges:
            a, b, c = vocabulary[left], vocabulary[right], vocabulary[left + right]
            begins, ends = state[a]
            k = bisect_right(begins, place[b])
            if a in self.never or b in self.never or k and ends[k - 1] > place[b]:
                self.never.add(c)
            else:
                state[c] = state[b]
                until = place[b] + size[b] - older[b]
                state[a] = (begins[:k] + [place[b]] + begins[k:], ends[:k] + [until] + ends[k:])
            older[a] += size[c]
        # flat tables: the intervals of a state lie from first[s] to first[s + 1]
        numbers: dict[int, int] = {}
        self.begins, self.ends, self.first = array("i"), array("i"), array("i", [0])
        self.state = array("i", [0]) * len(size)
        for number, row in state.items():
            if id(row) not in numbers:
                numbers[id(row)] = len(numbers)
                self.begins.extend(row[0])
                self.ends.extend(row[1])
                self.first.append(len(self.begins))
            self.state[number] = numbers[id(row)]

    def follows(self, before: int, token: int) -> bool:
        """Whether the state that ``before`` leads to has an arc for ``token``."""
        s, at = self.state[before], self.place[token]
        low = self.first[s]
        k = bisect_right(self.begins, at, low, self.first[s + 1]) - 1
        return k < low or self.ends[k] <= at

    def encode(self, word: str) -> list[int]:
        """The arcs of the one path that reads a word. Longer arcs are tried first; a place
        that led nowhere from a state is not tried from it again."""
        text, heads, n = word + _END, self.heads, len(word) + 1
        whole = heads.get(text, -1)
        if whole >= 0:
            return [whole]
        path, open_arcs, dead, at = [], [], set(), 0
        while at < n:
            # tokens that read on from here, the shortest first
            found, stop = [], at + 1
            if not path or (at, self.state[path[-1]]) not in dead:
                while (token := heads.get(text[at:stop])) is not None:
                    if token >= 0:
                        found.append(token)
                        found.append(stop)
                    if stop == n:
                        break
                    stop += 1
            while True:  # the longest that has an arc; or back to the place before
                if found:
                    stop, token = found.pop(), found.pop()
                    if not path or self.follows(path[-1], token):
                        path.append(token)
                        open_arcs.append((at, found))
                        at = stop
                        break
                elif path:
                    dead.add((at, self.state[path.pop()]))
                    at, found = open_arcs.pop()
                else:
                    raise ValueError(f"the vocabulary has no tokens for {word!r}")
        return path


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones
    for themselves, the others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _remember(known: dict[str, tuple[int, ...]], text: str, ids: tuple[int, ...]) -> tuple[int, ...]:
    """``ids``; texts that are not too long are remembered, until there are too many."""
    if len(text) <= REMEMBERED_CHARS:
        if len(known) >= REMEMBERED:
            known.clear()
        known[text] = ids
    return ids


class Codec:
    """Encodes and decodes whole texts with a vocabulary file of word-end BPE.

    Normalisation and the split into words are the library's own. Words never hold a
    space, so a text is cut at spaces and each different chunk is split once.
    """

    def __init__(self, vocabulary: str):
        with open(vocabulary, encoding="utf-8") as file:
            told = json.load(file)
        model, added = told["model"], told["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("added tokens must be matched as they stand")
        merges = [tuple(m if isinstance(m, list) else m.split(" ", 1)) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model["end_of_word_suffix"] or "")
        self.added = {t["content"]: t["id"] for t in added}
        self.labels = {**self.automaton.labels, **{number: text for text, number in self.added.items()}}
        texts = sorted(self.added, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, texts)) + ")") if texts else None
        library = Tokenizer.from_file(vocabulary)
        self.plain = told["normalizer"] == _NORMALIZER and told["pre_tokenizer"] == _SPLIT
        self.normalize = library.normalizer.normalize_str if library.normalizer else str
        self.split = library.pre_tokenizer.pre_tokenize_str
        self.known: dict[str, tuple[int, ...]] = {}
        symbols = byte_symbols()
        self.symbols = {k: symbols[k] for k in range(256)}
        self.marked = {mark: tuple(self.automaton.encode(symbols[ord(mark)])) for mark in ".,;:!?"}

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        """The ids of a chunk that is not remembered. Letters are one word; most others are
        letters with one mark behind, which are two."""
        if self.plain and _is_latin(chunk):
            if chunk.isalpha():
                word = chunk.encode().decode("latin-1").translate(self.symbols)
                return _remember(self.known, chunk, tuple(self.automaton.encode(word)))
            head, mark = chunk[:-1], chunk[-1]
            if head.isalpha() and mark in self.marked:
                ids = self.known.get(head)
                return (self._chunk(head) if ids is None else ids) + self.marked[mark]
        return _remember(
            self.known, chunk, tuple(i for word, _ in self.split(chunk) for i in self.automaton.encode(word))
        )

    def _chunks(self, part: str) -> list[str]:
        """The normalised text between spaces. Of the first 256 characters every one is its
        own composed form, and lower case does not depend on its neighbours."""
        if self.plain and _is_latin(part):
            if any(c in part for c in "\x1c\x1d\x1e\x1f"):  # spaces to Python alone
                return _SPACES.split(part.lower())
            return part.lower().split()
        return self.normalize(part).split(" ")

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        known = self.known
        for k, part in enumerate(self.marks.split(text) if self.marks else [text]):
            if k % 2:
                ids.append(self.added[part])
                continue
            for chunk in self._chunks(part):
                if chunk:
                    found = known.get(chunk)
                    ids += self._chunk(chunk) if found is None else found
        return ids

    def decode(self, ids: list[int]) -> str:
        """The arcs' labels with spaces between, as a library without a decoder has it;
        numbers that the vocabulary lacks are left out."""
        labels = self.labels
        return " ".join([labels[i] for i in ids if i in labels])


@lru_cache(maxsize=2)
def codec(vocabulary: str) -> Codec:
    """One per Python worker, however many tasks it runs."""
    return Codec(vocabulary)


def _path(vocabulary: str | None) -> str:
    return vocabulary or public_tokenizers.path("word_bpe_49k.json")


def encoded(docs: DataFrame, vocabulary: str | None = None, text_column: str = "text") -> DataFrame:
    """``docs`` with ``ids``, the token numbers of each whole text, in place of the text.

    Strings of added tokens in a text are those tokens, as the ``tokenizers`` library has
    it by default. Null and empty texts have no ids; repeated rows stay; other columns
    stay, but one named ids is replaced. Works row by row: no shuffle.
    """
    path = _path(vocabulary)
    kept = [c for c in docs.columns if c not in (text_column, "ids")]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in (b for whole in batches for b in pieces(whole, TEXTS)):
            ids = pa.array([coder.encode(t) if t else [] for t in taken(batch, "ids")], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], [*kept, "ids"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*kept).schema)
    rows = docs.select(*kept, F.col(text_column).cast("string").alias("ids"))
    return rows.mapInArrow(encode, f"{fields}ids array<int>")


def decoded(tokens: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``tokens`` (with ``ids``) and ``decoded``, the text of the ids; null ids give an
    empty text, null numbers are left out. A column named decoded is replaced."""
    path = _path(vocabulary)
    kept = [c for c in tokens.columns if c != "decoded"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in (b for whole in batches for b in pieces(whole, TEXTS)):
            texts = pa.array([coder.decode(ids) if ids else "" for ids in taken(batch, "ids")], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*kept, "decoded"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in tokens.select(*kept).schema)
    return tokens.select(*kept).mapInArrow(decode, f"{fields}decoded string")
