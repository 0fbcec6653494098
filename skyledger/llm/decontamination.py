"""Benchmark decontamination by greedy string tiling.

Tiles are the longest common runs of words that no earlier tile covers, taken again and
again down to SEED words; Karp-Rabin hashes find them. What counts is how much of a
benchmark item the tiles from one document cover, so passages in another order are
caught too. Documents and items meet on the hashes of SEED words: without a shared seed
there is no tile, and an item whose shared seeds cover too little needs no tiling.

The benchmark is the query set: it is taken in blocks of a bounded number of words, and
every block is held against all documents, without a shuffle.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import taken, written
from skyledger.llm.word_hashes import separators, shingles, word_lists

#: Words of a seed, and so of the shortest tile; percent of an item's words that count
#: as contamination.
SEED, PERCENT = 5, 75
#: Words of the benchmark that go to the tasks at a time (8 bytes each).
BLOCK_WORDS = 2_000_000
#: Length at which tiling starts to look; longer matches are found from it.
FIRST_LENGTH = 16

_ALNUM = separators(alphanumeric=True)


def word_hashes(texts: list[str | None]) -> list[np.ndarray]:
    """Hashes of the words of each text: runs of letters and digits, in lower case."""
    return [w for _, w in word_lists([(t or "").lower() for t in texts], _ALNUM)]


def _scan(
    item: np.ndarray, text: np.ndarray, used: np.ndarray, gone: np.ndarray, length: int
) -> list[tuple[int, int, int]]:
    """(length, place in the item, place in the text) of all unmarked common runs of at
    least ``length`` words, each as long as it goes, the longest first."""
    if min(len(item), len(text)) < length:
        return []
    free = lambda marks: np.convolve(marks, np.ones(length, int), "valid") == 0
    places = defaultdict(list)
    hashes = shingles(text, length)
    for j in np.flatnonzero(free(gone)):
        places[int(hashes[j])].append(int(j))
    hashes, found = shingles(item, length), []
    for i in np.flatnonzero(free(used)):
        for j in places.get(int(hashes[i]), ()):
            n = 0
            while (
                i + n < len(item)
                and j + n < len(text)
                and item[i + n] == text[j + n]
                and not used[i + n]
                and not gone[j + n]
            ):
                n += 1
            if n >= length:
                found.append((n, int(i), j))
    return sorted(found, key=lambda m: (-m[0], m[1], m[2]))


def tiles(item: np.ndarray, text: np.ndarray, gone: np.ndarray | None = None, least: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (length, place in the item, place in the text) of each tile.
    ``gone`` marks words of the text that no tile may use."""
    used, gone = np.zeros(len(item), bool), np.zeros(len(text), bool) if gone is None else gone.copy()
    out, length = [], max(least, FIRST_LENGTH)
    while True:
        found = _scan(item, text, used, gone, length)
        if found and found[0][0] > 2 * length:
            length = found[0][0]
            continue
        for n, i, j in found:
            if not used[i : i + n].any() and not gone[j : j + n].any():
                used[i : i + n] = True
                gone[j : j + n] = True
                out.append((n, i, j))
        if found:
            continue  # what the new marks have cut short may still hold a match
        if length == least:
            return out
        length = max(least, length // 2)


class _Block:
    """Some items of the benchmark, by the hashes of their seeds."""

    def __init__(self, ids: list, copies: list[int], words: list[np.ndarray], percent: int):
        self.ids, self.copies, self.words, self.percent = ids, copies, words, percent
        seeds: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = defaultdict(list)
        for k, w in enumerate(words):
            if len(w):
                width = min(SEED, len(w))
                h = shingles(w, width)
                seeds[width].append((h, np.full(len(h), k), np.arange(len(h))))
        self.seeds = {}
        for width, parts in seeds.items():
            hashes, items, places = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.argsort(hashes, kind="stable")
            self.seeds[width] = hashes[order], items[order], places[order]

    def _candidates(self, words: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(item, seed width, places in the text) where shared seeds cover enough."""
        for width, (hashes, items, places) in self.seeds.items():
            if len(words) < width:
                continue
            own = shingles(words, width)
            low = np.searchsorted(hashes, own, side="left")
            hit = np.flatnonzero(hashes[np.minimum(low, len(hashes) - 1)] == own)
            if not len(hit):
                continue
            high = np.searchsorted(hashes, own[hit], side="right")
            n = high - low[hit]
            at = np.repeat(low[hit] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            item, where = items[at], np.repeat(hit, n)
            for k in np.unique(item):
                mine = item == k
                cover = np.zeros(len(self.words[k]) + 1, int)
                starts = np.unique(places[at][mine])
                np.add.at(cover, starts, 1)
                np.add.at(cover, starts + width, -1)
                if 100 * (np.cumsum(cover) > 0).sum() >= self.percent * len(self.words[k]):
                    yield int(k), width, np.unique(where[mine])

    def leaks(self, words: np.ndarray) -> list[tuple[object, int, int, int]]:
        """(item id, words, covered words, tiles) of every item that is covered enough."""
        out = []
        for k, width, where in self._candidates(words):
            # only words under a shared seed can be in a tile; the rest is cut away
            near = np.zeros(len(words) + 1, int)
            np.add.at(near, where, 1)
            np.add.at(near, where + width, -1)
            keep = np.flatnonzero(np.cumsum(near)[:-1] > 0)
            breaks = np.flatnonzero(np.diff(keep) > 1) + 1
            text = np.insert(words[keep], breaks, 0)
            gone = np.insert(np.zeros(len(keep), bool), breaks, True)
            found = tiles(self.words[k], text, gone, width)
            covered = sum(n for n, _, _ in found)
            if 100 * covered >= self.percent * len(self.words[k]):
                out += [(self.ids[k], len(self.words[k]), covered, len(found))] * self.copies[k]
        return out


def _blocks(items: DataFrame, percent: int) -> Iterator[_Block]:
    """The benchmark in blocks of some BLOCK_WORDS words; one at a time is on the driver.
    Equal items are one, with the number of its copies, so no hash holds many words."""
    sized = items.select(
        F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"), F.length("text").alias("chars")
    ).where("text is not null").groupBy("item_id", "text", "chars").agg(F.count("*").alias("copies"))
    # a word has a character and a separator at least
    blocks = max(1, math.ceil((sized.agg(F.sum("chars")).first()[0] or 0) / 2 / BLOCK_WORDS))
    placed = sized.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    for block in range(blocks):
        rows = placed.where(F.col("block") == block).select("item_id", "text", "copies").collect()
        yield _Block(
            [r["item_id"] for r in rows], [r["copies"] for r in rows], word_hashes([r["text"] for r in rows]), percent
        )


def leaks(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, item_words, covered, tiles): one row per row of ``docs`` and item
    whose tiles cover at least ``percent`` % of the item's words.

    ``items`` has item_id and text. An item of fewer than SEED words is a seed as a whole;
    one without words is never covered. Null texts hold nothing; repeated rows of either
    side give repeated rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    doc, item = (d.schema[c].dataType.simpleString() for d, c in ((docs, "doc_id"), (items, "item_id")))
    kind = f"doc_id {doc}, item_id string, item_words bigint, covered bigint, tiles bigint"
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = spark.createDataFrame([], kind).schema
    found = None
    for block in _blocks(items, percent):
        sent = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, 256):
                    batch = whole.slice(at, 256)
                    out = [
                        (k, *leak)
                        for k, words in enumerate(word_hashes(taken(batch, "text")))
                        for leak in sent.value.leaks(words)
                    ]
                    if out:
                        place, *columns = zip(*out, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column("doc_id").take(pa.array(place)),
                                pa.array(columns[0], pa.string()),
                                *(pa.array(c, pa.int64()) for c in columns[1:]),
                            ],
                            ["doc_id", "item_id", "item_words", "covered", "tiles"],
                        )

        some = rows.mapInArrow(search, schema)
        found = some if found is None else found.unionByName(some)
    return found.withColumn("item_id", F.col("item_id").cast(item))


def without_leaks(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` (all columns) whose text covers no item, as in ``leaks``."""
    spark = docs.sparkSession
    for number, block in enumerate(_blocks(items, percent)):
        if number:  # a task holds one block
            docs = written(docs, "clean-so-far")
        sent = spark.sparkContext.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, 256):
                    batch = whole.slice(at, 256)
                    good = [not sent.value.leaks(w) for w in word_hashes(taken(batch, "text"))]
                    yield batch.filter(pa.array(good, pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
