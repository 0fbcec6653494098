"""Collocations from streams of phrase counts that are kept in order.

Counting works like an external sort. Tasks count the phrases of a block of text and
write them sorted; the runs of all tasks are dealt into ranges and sorted, equal phrases
stand side by side and are added up. Longer phrases are counted only where the words, and
then the pairs of words, at their places are frequent, since a phrase is never more
frequent than its parts.

The counts of frequent phrases are kept in two orders: of the phrase (prefix order) and
of its words backwards (suffix order). A phrase asks for the count of its first words in
the first and for that of its last words in the second. Questions and counts are merged
in lockstep: both are dealt into the same ranges and sorted, and one pass lets the count
that stands before a question answer it. A key that very many ask for may extend over
several ranges; each range hands its last count on to the following ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import scratch, taken, written
from skyledger.llm.word_hashes import chunks, mix, stream, words_of

#: A phrase has two to LONGEST words and occurs at least LEAST times.
LONGEST, LEAST = 4, 30
#: A phrase goes if a longer one with its words has this share (in percent) of its count.
ABSORBED_PERCENT = 80
#: A score is the share of the phrase in the counts of its parts, in SCALE units.
SCALE = 2_000_000
#: Texts are counted together up to about this many bytes.
BLOCK_BYTES = 16 << 20
#: Bits of the filter of frequent parts: 16 for each, at most MOST_BITS (8 MiB). It lets
#: all frequent ones pass and, the more there are, the more others too; those are sorted
#: in vain and change no result.
BITS_EACH, MOST_BITS = 16, 1 << 26

# What ends a piece and what else ends a word.
_PIECE_ENDS, _WORD_ENDS = b".,;:!?\n\v\f\r", b" \t"
_ENDS_PIECE = np.zeros(256, bool)
_ENDS_PIECE[list(_PIECE_ENDS)] = True
_ENDS_WORD = _ENDS_PIECE.copy()
_ENDS_WORD[list(_WORD_ENDS)] = True
_LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 0x100))

_COUNTS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])
_COUNTS_DDL = "lang string, phrase string, n bigint"


class _Block:
    """The words of some texts in one language, and which of them stand in one piece."""

    def __init__(self, texts: list[str]):
        hashes, words, piece, base = [], [], [], 0
        for _, _, raw, _ in chunks(texts):
            found, starts, ends = words_of(raw, _ENDS_WORD)
            hashes.append(found)
            words.append((raw.translate(_LOWER), starts, ends))
            ended = np.cumsum(_ENDS_PIECE[np.frombuffer(raw, np.uint8)])
            piece.append(ended[starts] + base)
            base += len(raw) + 1
        piece = np.concatenate(piece)
        known, first, number = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        cuts = np.cumsum([len(s) for _, s, _ in words])
        texts = []
        for at, part in zip(first.tolist(), np.searchsorted(cuts, first, side="right").tolist(), strict=True):
            raw, starts, ends = words[part]
            k = at - int(cuts[part - 1]) if part else at
            texts.append(raw[starts[k] : ends[k]])
        # words are numbered in their order, so that phrases come out in theirs
        order = np.array(sorted(range(len(texts)), key=texts.__getitem__), np.int64)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.words = pa.array([texts[k].decode("utf-8", "replace") for k in order.tolist()], pa.string())
        self.hashes = known[order]
        self.number = rank[number]
        self.goes_on = np.append(piece[1:] == piece[:-1], False)

    def __len__(self) -> int:
        return len(self.number)

    def pairs(self, both: np.ndarray) -> np.ndarray:
        """Where a frequent word is followed by another in its piece."""
        fits = both[self.number]
        return fits & np.append(fits[1:], False) & self.goes_on

    def counts(self, ids: np.ndarray, places: np.ndarray, words: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Phrases, counts and the number of the phrase at each place; ``ids`` are numbers
        of the phrases with a word less, at all places."""
        most = int(ids.max(initial=0)) + 1
        code = ids[places] * most + ids[places + 1]
        _, first, number, n = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
        at = places[first]
        parts = [self.words.take(pa.array(self.number[at + k])) for k in range(words)]
        following = np.zeros(len(ids), np.int64)
        following[places] = number
        return pc.binary_join_element_wise(*parts, " "), n, following


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, _Block]]:
    """(lang, block) of at most about BLOCK_BYTES of text at a time."""
    held: dict[str, list[str]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(taken(batch, "lang"), taken(batch, "text"), strict=True):
            held.setdefault(lang, []).append(text)
            size += len(text)
            if size >= BLOCK_BYTES:
                yield from ((k, _Block(v)) for k, v in held.items())
                held, size = {}, 0
    yield from ((k, _Block(v)) for k, v in held.items())


def _rows(lang: str, phrases: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    langs = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(n), np.int8)))
    return pa.RecordBatch.from_arrays([langs, phrases, pa.array(n, pa.int64())], schema=_COUNTS)


def _hash(lang: str) -> np.uint64:
    return words_of(b"." + lang.encode("utf-8", "surrogatepass") + b".", np.zeros(256, bool))[0][0]


class _Filter:
    """Which 64-bit keys may be among the given ones; all of those are."""

    PROBES = 4

    def __init__(self, bits: int):
        self.bits, self.field = bits, np.zeros(bits // 8, np.uint8)

    def places(self, keys: np.ndarray) -> list[np.ndarray]:
        other = mix(keys.copy()) | np.uint64(1)
        return [(keys + np.uint64(k) * other) & np.uint64(self.bits - 1) for k in range(self.PROBES)]

    def holds(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for at in self.places(keys):
            found &= (self.field[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return found


def _keys(lang: str, *hashes: np.ndarray) -> np.ndarray:
    """A key for each phrase from the hashes of its words."""
    key = np.full(len(hashes[0]), _hash(lang), np.uint64)
    for one in hashes:
        key = mix(key * stream(7, 1) + one)
    return key


def _filter_of(phrases: DataFrame, words: int) -> _Filter:
    """The filter of (lang, phrase) rows of so many words. Tasks name the bits, Spark puts
    them together; the driver sees the field of bits only."""
    bits = 1 << 10
    total = phrases.count()
    while bits < min(MOST_BITS, BITS_EACH * total):
        bits *= 2
    empty = _Filter(bits)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for lang, phrase in zip(taken(batch, "lang"), taken(batch, "phrase"), strict=True):
                by_lang.setdefault(lang, []).append(phrase)
            for lang, own in by_lang.items():
                found = words_of("\n".join(own).encode("utf-8", "surrogatepass"), _ENDS_WORD)[0].reshape(-1, words)
                at = np.unique(np.concatenate(empty.places(_keys(lang, *found.T))))
                masks = (np.uint64(1) << (at & np.uint64(63))).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array(masks)], ["word", "mask"]
                )

    named_bits = phrases.select("lang", "phrase").mapInArrow(named, "word bigint, mask bigint")
    field = named_bits.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    words_at = empty.field.view(np.int64)
    words_at[field["word"].to_numpy()] = field["mask"].to_numpy()
    return empty


def counted(records: DataFrame, least: int = 1) -> DataFrame:
    """(lang, phrase, n) with the sum of ``n`` of equal phrases, from ``least`` on."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_row: tuple[str, str, int] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            lang, phrase, n = (batch.column(c) for c in ("lang", "phrase", "n"))
            other = np.ones(batch.num_rows, bool)
            if batch.num_rows > 1:
                other[1:] = pc.or_(
                    pc.not_equal(phrase[1:], phrase[:-1]), pc.not_equal(lang[1:], lang[:-1])
                ).to_numpy(zero_copy_only=False)
            at = np.flatnonzero(other)
            sums = np.add.reduceat(n.to_numpy(), at)
            if open_row and open_row[:2] == (lang[0].as_py(), phrase[0].as_py()):
                sums[0] += open_row[2]
            elif open_row:
                yield pa.RecordBatch.from_pylist([dict(zip(_COUNTS.names, open_row, strict=True))], schema=_COUNTS)
            last = int(at[-1])
            open_row = (lang[last].as_py(), phrase[last].as_py(), int(sums[-1]))
            done = np.flatnonzero(sums[:-1] >= least)
            where = pa.array(at[done])
            yield pa.RecordBatch.from_arrays(
                [lang.take(where), phrase.take(where), pa.array(sums[done], pa.int64())], schema=_COUNTS
            )
        if open_row:
            yield pa.RecordBatch.from_pylist([dict(zip(_COUNTS.names, open_row, strict=True))], schema=_COUNTS)

    in_order = records.repartitionByRange("lang", "phrase").sortWithinPartitions("lang", "phrase")
    return in_order.mapInArrow(added, _COUNTS_DDL).where(F.col("n") >= least)


def frequent_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n) of all phrases of one to four words with ``least`` occurrences, as
    a written table, and (lang, n) of all words.

    ``docs`` has lang and text, neither of them null.
    """

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, block in _blocks(batches):
            yield _rows(lang, block.words, np.bincount(block.number, minlength=len(block.words)))

    with scratch():
        words = written(docs.mapInArrow(single, _COUNTS_DDL), "word-runs")
        totals = written(words.groupBy("lang").agg(F.sum("n").alias("n")), "word-totals", keep=True)
        common = written(counted(words, least), "frequent-words", keep=True)
    known_words = _filter_of(common, 1)

    def double(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, block in _blocks(batches):
            places = np.flatnonzero(block.pairs(known_words.holds(_keys(lang, block.hashes))))
            if len(places):
                phrases, n, _ = block.counts(block.number, places, 2)
                yield _rows(lang, phrases, n)

    with scratch():
        runs = written(docs.mapInArrow(double, _COUNTS_DDL), "pair-runs")
        pairs = written(counted(runs, least), "frequent-pairs", keep=True)
    known_pairs = _filter_of(pairs, 2)

    def longer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, block in _blocks(batches):
            hashes = block.hashes[block.number]
            places = np.flatnonzero(block.pairs(known_words.holds(_keys(lang, block.hashes))))
            places = places[known_pairs.holds(_keys(lang, hashes[places], hashes[places + 1]))]
            ids = np.zeros(len(block), np.int64)
            ids[places] = np.unique(
                block.number[places] * len(block.words) + block.number[places + 1], return_inverse=True
            )[1]
            for words in range(3, LONGEST + 1):
                places = places[np.isin(places + 1, places, assume_unique=True)]
                if not len(places):
                    break
                phrases, n, ids = block.counts(ids, places, words)
                yield _rows(lang, phrases, n)

    with scratch():
        runs = written(docs.mapInArrow(longer, _COUNTS_DDL), "phrase-runs")
        long_ones = written(counted(runs, least), "frequent-phrases", keep=True)
    return common.unionByName(pairs).unionByName(long_ones), totals


def lockstep(counts: DataFrame, questions: DataFrame) -> DataFrame:
    """``questions`` (lang, key and any other columns) with ``found``, the ``n`` of the
    row of ``counts`` (lang, key, n; one row a key) with their lang and key.

    Every question must have an answer.
    """
    others = [c for c in questions.columns if c not in ("lang", "key")]
    columns = ["lang", "key", "asks", *others, "found"]
    kinds = {f.name: f.dataType.simpleString() for f in questions.schema}
    answers = counts.select(
        "lang",
        "key",
        F.lit(False).alias("asks"),
        *(F.lit(None).cast(kinds[c]).alias(c) for c in others),
        F.col("n").alias("found"),
    )
    asked = questions.select("lang", "key", F.lit(True).alias("asks"), *others, F.lit(None).cast("bigint").alias("found"))
    order = ["lang", "key", "asks", *others]

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the last count: a batch of one row
        for batch in batches:
            given = pa.Table.from_batches([batch] if last is None else [last, batch]).combine_chunks()
            asks = given["asks"].to_numpy(zero_copy_only=False)
            at = np.maximum.accumulate(np.where(asks, -1, np.arange(len(asks))))
            counts_at = pa.array(np.where(at < 0, 0, at), mask=at < 0)
            fits = np.ones(len(asks), bool)
            for column in ("lang", "key"):
                same = pc.equal(given[column], given[column].take(counts_at)).fill_null(True)
                fits &= same.to_numpy(zero_copy_only=False) if isinstance(same, pa.Array) else same.to_numpy()
            if not fits.all():
                raise ValueError("a part of a frequent phrase has no count")
            full = given.set_column(given.num_columns - 1, "found", given["found"].take(counts_at))
            yield from full.filter(pa.array(asks)).combine_chunks().to_batches()
            if at[-1] >= 0:
                last = given.slice(int(at[-1]), 1).combine_chunks().to_batches()[0]
        if last is not None:
            yield last  # for the ranges that follow

    ddl = f"lang string, key string, asks boolean, {''.join(f'`{c}` {kinds[c]}, ' for c in others)}found bigint"
    with scratch():
        both = written(answers.unionByName(asked).select(*columns), "questions")
        in_order = both.repartitionByRange(*order).sortWithinPartitions(*order)
        merged = written(in_order.mapInArrow(answered, ddl), "answers", keep=True)
    # one row for each range at most
    handed_on = merged.where("not asks").select("lang", "key", F.col("found").alias("_handed_on"))
    asked = merged.where("asks").drop("asks")
    late = asked.where("found is null").drop("found").join(F.broadcast(handed_on), ["lang", "key"])
    return asked.where("found is not null").unionByName(late.withColumnRenamed("_handed_on", "found"))


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    lang_column: str = "lang",
    text_column: str = "text",
) -> DataFrame:
    """The phrases of ``docs``: lang, phrase, words, a, k, l, r, score, absorbed.

    Words are cut at spaces, tabs and what ends a piece, with A-Z lower-cased; a phrase
    lies in one piece. ``a``, ``l`` and ``r`` count the phrase, its first k words and the
    others, of the cut with the lowest score (ties: the smallest k). ``absorbed`` tells
    whether a longer phrase with its words has 80 % of its count. A null lang is ``und``,
    a null text is empty, repeated rows count as often as they stand, other columns are
    ignored. Of a phrase of m words only those of m + 1 words are asked: between a phrase
    and a longer one that absorbs it stands one of m + 1 words with at least that count.
    """
    return scored(frequent_phrases(_texts(docs, lang_column, text_column), least)[0])


def _texts(docs: DataFrame, lang_column: str = "lang", text_column: str = "text") -> DataFrame:
    return docs.select(
        F.coalesce(F.col(lang_column).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )


def scored(phrases: DataFrame) -> DataFrame:
    """``collocations`` from (lang, phrase, n) of all frequent phrases and their parts."""
    words = F.size(F.split("phrase", " "))
    backwards = lambda c: F.array_join(F.reverse(F.split(c, " ")), " ")
    cuts = (
        phrases.withColumn("words", words)
        .where("words > 1")
        .select("lang", "phrase", "words", F.col("n").alias("a"), F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    )
    in_prefix_order = phrases.select("lang", F.col("phrase").alias("key"), "n")
    in_suffix_order = phrases.select("lang", backwards("phrase").alias("key"), "n")
    left = lockstep(in_prefix_order, cuts.withColumn("key", F.expr("substring_index(phrase, ' ', k)")))
    rest = F.expr("substring_index(phrase, ' ', k - words)")
    asked = left.drop("key").withColumnRenamed("found", "l").withColumn("key", backwards(rest))
    both = lockstep(in_suffix_order, asked).drop("key").withColumnRenamed("found", "r")
    exact = f"(cast(a as decimal(20, 0)) * {SCALE}) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))"
    weakest = both.withColumn("score", F.expr(exact)).groupBy("lang", "phrase").agg(
        F.max("words").alias("words"),
        F.max("a").alias("a"),
        F.min(F.struct("score", "k", "l", "r")).alias("cut"),
    )
    # a longer phrase adds a word after its first words, or before its last ones
    extended = (
        both.where("words > 2 and k = words - 1")
        .select("lang", F.expr("substring_index(phrase, ' ', k)").alias("phrase"), "a")
        .unionByName(both.where("words > 2 and k = 1").select("lang", rest.alias("phrase"), "a"))
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    percent = lambda name: F.col(name).cast("decimal(20, 0)")
    absorbed = F.coalesce(percent("longer") * 100 >= percent("a") * ABSORBED_PERCENT, F.lit(False))
    return weakest.join(extended, ["lang", "phrase"], "left").select(
        "lang", "phrase", "words", "a", "cut.k", "cut.l", "cut.r", "cut.score", absorbed.alias("absorbed")
    )


def best_collocations(docs: DataFrame, most: int, least: int = LEAST) -> DataFrame:
    """Of each lang the first ``most`` phrases that are not absorbed, by score and a
    (descending) and the phrase: lang, rank, phrase, a, l, r, n, score; n counts all words
    of the lang. See ``collocations``."""
    phrases, totals = frequent_phrases(_texts(docs), least)
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = scored(phrases).where("not absorbed").withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= most)
    return first.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
