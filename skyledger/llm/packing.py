"""Best-fit packing of token pieces into sequences by minimum bin slack.

Minimum bin slack fills one bin at a time: subset-sum dynamic programming over the
lengths still available finds the fullest combination, which is then removed. The
combination depends on the lengths alone, so the search runs on a histogram (at most
``capacity`` counters, whatever the number of pieces), and a combination is removed as
often as its lengths last. Each step uses up at least one length: there are at most
``capacity`` steps. Of the combinations with the longest piece left, the fullest is
taken (the usual MBS' variant: long pieces do not pile up at the end).

Pieces then learn their seat from their rank among the pieces of their length. Ranks
come from counts per written part and length, so no length, however frequent, is
gathered in one task.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import pieces as slices
from skyledger.llm.common import taken, written

CAPACITY = 2048
#: Texts whose ids are in memory at a time.
TEXTS = 256


class _Encoder:
    """Ids of whole texts.

    The byte-level BPE of a ``.tiktoken`` rank file; the special token's string in a text
    is that token, as the ``tokenizers`` library has it by default. The tests hold the
    ids against that library's on the same vocabulary; it takes some five times as long.
    """

    def __init__(self, vocabulary: str):
        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.end = "<|endoftext|>"
        self.encoding = tiktoken.Encoding(
            "pieces",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=ranks,
            special_tokens={self.end: len(ranks)},
        )

    def __call__(self, text: str) -> np.ndarray:
        if self.end in text:
            return np.array(self.encoding.encode(text, allowed_special="all"), "<u4")
        return np.array(self.encoding.encode_ordinary(text), "<u4")


@cache
def _encoder(vocabulary: str) -> _Encoder:
    """One per Python worker, however many tasks it runs."""
    return _Encoder(vocabulary)


def token_pieces(
    docs: DataFrame,
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    separator: int = 0,
) -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, ids.

    A document is its text's ids (a null text is empty) and the ``separator`` id; ``ids``
    holds them as little-endian unsigned 32-bit numbers. A document of more than
    ``capacity`` tokens is cut into pieces of ``capacity``; its first piece takes the
    remainder. Other columns are ignored; repeated rows give repeated pieces.
    """
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    end = np.array([separator], "<u4")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(vocabulary)
        for batch in (b for whole in batches for b in slices(whole, TEXTS)):
            rows = []
            for doc, text in zip(taken(batch, "doc_id"), taken(batch, "text"), strict=True):
                ids = np.append(encode(text or ""), end)
                n = len(ids)
                first = (n - 1) % capacity + 1
                cuts = [0, *range(first, n + 1, capacity)]
                rows += [
                    (doc, k, a, b - a, ids[a:b].tobytes())
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))
                ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                ["doc_id", "piece", "start", "length", "ids"],
            )

    doc = docs.schema["doc_id"].dataType.simpleString()
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        cut, "doc_id bigint, piece int, start bigint, length bigint, ids binary"
    ).withColumn("doc_id", F.col("doc_id").cast(doc))


def combinations(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[tuple[int, int]], int]]:
    """Minimum bin slack over a histogram of lengths: ([(length, copies), ...], bins)."""
    left = {length: n for length, n in histogram.items() if n}
    found = []
    while left:
        longest = max(left)
        room = capacity - longest
        # sums[k]: bit s is set if the first k lengths (longest first) can add up to s
        order, sums, reached = [], [1], 1
        for length in sorted(left, reverse=True):
            copies = min(left[length] - (length == longest), room // length)
            if copies <= 0:
                continue
            step, todo = 1, copies
            while todo:  # copies 1, 2, 4, ... and the rest reach every multiple
                step = min(step, todo)
                reached |= reached << (step * length)
                todo -= step
                step *= 2
            reached &= (1 << (room + 1)) - 1
            order.append((length, copies))
            sums.append(reached)
            if reached >> room & 1:
                break
        rest, used = reached.bit_length() - 1, {longest: 1}
        for k in range(len(order), 0, -1):
            length, copies = order[k - 1]
            for n in range(copies + 1):  # as few of the shorter lengths as will do
                if rest >= n * length and sums[k - 1] >> (rest - n * length) & 1:
                    break
            rest -= n * length
            if n:
                used[length] = used.get(length, 0) + n
        bins = min(left[length] // n for length, n in used.items())
        for length, n in used.items():
            left[length] -= n * bins
            if not left[length]:
                del left[length]
        found.append((sorted(used.items(), reverse=True), bins))
    return found


class _Seats:
    """Sequence and offset of the r-th piece of each length."""

    def __init__(self, found: list[tuple[list[tuple[int, int]], int]]):
        rows, taken, base = [], {}, 0
        for used, bins in found:
            offset = 0
            for length, copies in used:
                rows.append((length, taken.get(length, 0), copies, base, offset))
                taken[length] = taken.get(length, 0) + copies * bins
                offset += length * copies
            base += bins
        rows.sort()
        self.length, self.first, self.copies, self.base, self.offset = np.array(rows, np.int64).reshape(-1, 5).T

    def __call__(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # the last row of the same length whose first rank is not above
        key = (self.length.astype(np.uint64) << np.uint64(48)) + self.first.astype(np.uint64)
        want = (length.astype(np.uint64) << np.uint64(48)) + rank.astype(np.uint64)
        at = np.searchsorted(key, want, side="right") - 1
        copy = rank - self.first[at]
        return self.base[at] + copy // self.copies[at], self.offset[at] + copy % self.copies[at] * length


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (any columns; ``length`` from 1 to ``capacity``) with the sequence that
    each goes to and its offset there.

    Sequences are filled without gaps. No pieces give no rows; equal rows are pieces of
    their own. The driver sees the histogram only. A length out of range is an error;
    columns named sequence_id or offset are replaced. Ranks are counted where the pieces
    are written, so that only the join with the counts of the parts moves them.
    """
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    # whatever the columns are called, they travel as one
    kept = pieces.select("length", F.struct(*columns).alias("piece"))
    kind = kept.schema["piece"].dataType.simpleString()

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            lengths = batch.column("length").cast(pa.int64())
            own = np.clip(pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False), 0, capacity)
            # the place of each row among those of its length
            order = np.argsort(own, kind="stable")
            first = np.flatnonzero(np.diff(own[order], prepend=-1))
            run = np.diff(np.append(first, len(own)))
            place = np.empty(len(own), np.int64)
            place[order] = np.arange(len(own)) - np.repeat(first, run) + seen[own[order]]
            seen += np.bincount(own, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [lengths, pa.array([part] * len(own), pa.int32()), pa.array(place), batch.column("piece")],
                ["length", "part", "place", "piece"],
            )

    numbered = written(kept.mapInArrow(number, f"length bigint, part int, place bigint, piece {kind}"), "pieces")
    cells = numbered.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    if any(length is None or not 0 < length <= capacity for length in histogram):
        raise ValueError(f"a piece has no length from 1 to {capacity}")
    seats = _Seats(combinations(histogram, capacity))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    ranked = numbered.join(cells.select("length", "part", before.alias("before")), ["length", "part"]).select(
        "piece", "length", (F.col("before") + F.col("place")).alias("rank")
    )

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = seats(length, rank)
            yield pa.RecordBatch.from_arrays(
                [batch.column("piece"), pa.array(sequence), pa.array(offset)], ["piece", "sequence_id", "offset"]
            )

    seated = ranked.mapInArrow(seat, f"piece {kind}, sequence_id bigint, offset bigint")
    return seated.select("piece.*", "sequence_id", "offset")
