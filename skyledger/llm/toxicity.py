"""Toxicity by compression distance.

Two zstandard dictionaries, one trained on words typical of toxic documents and one on
ordinary words, compress every window (a word) of a text. A window that the toxic one
makes shorter speaks for toxicity; how strongly is calibrated per pair of (toxic length,
gain) on labelled rows that trained neither dictionary.

Windows of a few bytes are below what zstandard can show by itself: it stores short
blocks raw and looks for no match in the last eight bytes. So each window stands between
two copies of a fixed context that ends both dictionaries, and both share one body of
ordinary text: what is left of the difference is the window's own.
"""

from __future__ import annotations

import heapq
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import pieces, taken, written

#: Bounds of what is fitted on: labelled documents of each class that train the
#: dictionaries, that calibrate, words typical of toxic text and ordinary words.
TRAIN_TOXIC, TRAIN_ORDINARY = 1_500, 6_000
CALIBRATE_TOXIC, CALIBRATE_ORDINARY = 1_000, 4_000
TYPICAL_WORDS, ORDINARY_WORDS = 512, 8_192
#: A word is typical if a likelihood-ratio test of its document counts says so; 30 is a
#: chance of 4e-8, so that among millions of words few are typical by chance. With few
#: labels hardly any word gets there; the best LEAST_TYPICAL ones are taken all the same,
#: and the calibration tells what they are worth.
TYPICAL_RATIO, LEAST_TYPICAL = 30.0, 32
DICTIONARY_BYTES = 4_096
#: A longer word is several windows.
WINDOW_CHARS = 48
#: The strongest windows of a text count.
STRONGEST = 4
#: Words whose weight a worker remembers; it starts anew beyond that.
REMEMBERED = 500_000

_WORD = re.compile(rf"\w{{1,{WINDOW_CHARS}}}")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def fold(doc_id: Column) -> Column:
    """0 to 3, from the CRC-32 of the id as text; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    context: bytes
    #: Weight of each (toxic length, gain) that was seen.
    weights: tuple[tuple[tuple[int, int], float], ...] = ()
    #: Of the intercept, the strongest window and the sum of the strongest.
    coefficients: tuple[float, float, float] = (0.0, 0.0, 0.0)


class _Scorer:
    def __init__(self, model: Model):
        self.toxic, self.ordinary = _compressor(model.toxic), _compressor(model.ordinary)
        self.context, self.weights = model.context, dict(model.weights)
        self.coefficients = model.coefficients
        self.known: dict[str, float] = {}

    def cell(self, word: str) -> tuple[int, int]:
        window = b"%b %b %b" % (self.context, word.encode("utf-8", "replace"), self.context)
        short = len(self.toxic.compress(window))
        return min(short, 40), max(-2, min(10, len(self.ordinary.compress(window)) - short))

    def features(self, text: str | None) -> tuple[float, float]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, found = self.known, []
        for word in words(text):
            weight = known.get(word)
            if weight is None:
                weight = known[word] = self.weights.get(self.cell(word), 0.0)
            if weight > 0:
                found.append(weight)
        best = heapq.nlargest(STRONGEST, found)
        return (best[0], sum(best)) if best else (0.0, 0.0)

    def score(self, text: str | None) -> float:
        a, b, c = self.coefficients
        strongest, total = self.features(text)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * strongest + c * total))))


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    body = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    parameters = zstandard.ZstdCompressionParameters(
        window_log=15,
        hash_log=13,
        chain_log=13,
        search_log=4,
        min_match=4,
        target_length=16,
        strategy=zstandard.STRATEGY_GREEDY,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        write_content_size=0,
        write_checksum=0,
        write_dict_id=0,
    )
    body.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(compression_params=parameters, dict_data=body)


@lru_cache(maxsize=2)
def _scorer(model: Model) -> _Scorer:
    """One per Python worker, however many tasks it runs; those of former models go."""
    return _Scorer(model)


def _trained(samples: list[str]) -> bytes:
    """The content of a dictionary of DICTIONARY_BYTES; few samples stand for themselves."""
    windows = [f" {word} ".encode("utf-8", "replace") for word in samples]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, windows, level=3).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(windows))[-DICTIONARY_BYTES:]


def _dictionaries(typical: list[tuple[str, int]], common: list[tuple[str, int]]) -> Model:
    draw = random.Random(1)

    def drawn(pairs: list[tuple[str, int]], n: int) -> list[str]:
        return draw.choices([w for w, _ in pairs], [c for _, c in pairs], k=n)

    repeated = [word for word, n in typical for _ in range(n)]
    draw.shuffle(repeated)
    context = "  ".join(drawn(common, 8)).encode("utf-8", "replace") + b"  plain context  "
    toxic, other, body = _trained(repeated), _trained(drawn(common, 60_000)), _trained(drawn(common, 80_000))
    same = min(len(toxic), len(other))  # the body is as far from the end in both
    return Model(toxic[-same:] + body + context, other[-same:] + body + context, context)


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts of a bounded sample of labelled rows outside the held-out fold, with toxic
    and whether they calibrate: those with the smallest hashes of each kind. A document
    with several labels counts by the highest; equal texts count once."""
    known = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .withColumn("_fold", fold(F.col("doc_id")))
        .where("_fold <> 2")
        .select("doc_id", (F.col("toxic") > 0).alias("toxic"), (F.col("_fold") == 3).alias("calibrates"))
    )
    bounds = {
        (True, False): TRAIN_TOXIC,
        (False, False): TRAIN_ORDINARY,
        (True, True): CALIBRATE_TOXIC,
        (False, True): CALIBRATE_ORDINARY,
    }
    chosen = None
    for (toxic, calibrates), most in bounds.items():
        kind = known.where((F.col("toxic") == toxic) & (F.col("calibrates") == calibrates))
        some = kind.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        chosen = some if chosen is None else chosen.unionByName(some)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    # at most 12,500 rows of an id and two flags
    joined = texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic", "calibrates")
    return written(joined.dropDuplicates(["text", "toxic", "calibrates"]), "labelled")


def fit(docs: DataFrame, labels: DataFrame) -> Model | float:
    """The model, or the constant score 0 where nothing can be learned: where one of the
    classes has no labelled text, or no word is more frequent among toxic texts. Nulls and
    repeated rows of the labels are as in ``_labelled``; nothing else is read of them."""
    sample = _labelled(docs, labels)
    shares = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(shares) < 2:
        return 0.0

    def distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in zip(taken(batch, "text"), taken(batch, "toxic"), strict=True):
                own = sorted(set(words(text)))
                yield pa.RecordBatch.from_pydict({"word": own, "toxic": [toxic] * len(own)}, _WORDS)

    train = sample.where("not calibrates")
    sizes = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    a_all, b_all = max(1, sizes.get(True, 0)), max(1, sizes.get(False, 0))
    counts = written(
        train.select("text", "toxic")
        .mapInArrow(distinct_words, "word string, toxic boolean")
        .groupBy("word")
        .agg(F.count_if("toxic").alias("a"), F.count_if(~F.col("toxic")).alias("b")),
        "words",
    )

    def likelihood(x: str, n: int, p: str) -> str:
        return f"(if({x} = 0, 0, {x} * ln({p})) + if({x} = {n}, 0, ({n} - {x}) * ln(1 - {p})))"

    pooled = f"((a + b) / {a_all + b_all})"
    ratio = (
        f"2 * ({likelihood('a', a_all, f'(a / {a_all})')} + {likelihood('b', b_all, f'(b / {b_all})')}"
        f" - {likelihood('a', a_all, pooled)} - {likelihood('b', b_all, pooled)})"
    )
    ranked = (
        counts.where(f"a >= 2 and a * {b_all} > b * {a_all}")
        .withColumn("ratio", F.expr(ratio))
        .orderBy(F.desc("ratio"), "word")
        .limit(TYPICAL_WORDS)
        .collect()
    )
    typical = [r for k, r in enumerate(ranked) if k < LEAST_TYPICAL or r["ratio"] >= TYPICAL_RATIO]
    common = counts.where("b > 0").orderBy(F.desc("b"), F.xxhash64("word"), "word").limit(ORDINARY_WORDS).collect()
    if not typical or not common:
        return 0.0
    bare = _dictionaries([(r["word"], r["a"]) for r in typical], [(r["word"], r["b"]) for r in common])
    return _calibrated(sample.where("calibrates"), bare)


_WORDS = pa.schema([("word", pa.string()), ("toxic", pa.bool_())])


def _calibrated(held: DataFrame, bare: Model) -> Model:
    """Weights of the cells and coefficients, from texts that trained no dictionary."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(bare)
        for batch in batches:
            for text, toxic in zip(taken(batch, "text"), taken(batch, "toxic"), strict=True):
                own = sorted({scorer.cell(w) for w in set(words(text))})
                yield pa.RecordBatch.from_pydict(
                    {"short": [s for s, _ in own], "gain": [g for _, g in own], "toxic": [toxic] * len(own)},
                    pa.schema([("short", pa.int32()), ("gain", pa.int32()), ("toxic", pa.bool_())]),
                )

    texts = held.select("text", "toxic")
    sizes = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    seen = texts.mapInArrow(cells, "short int, gain int, toxic boolean").groupBy("short", "gain").agg(
        F.count_if("toxic").alias("a"), F.count_if(~F.col("toxic")).alias("b")
    )
    a_all, b_all = sizes.get(True, 0) + 1, sizes.get(False, 0) + 1
    weights = tuple(
        sorted(
            ((r["short"], r["gain"]), math.log((r["a"] + 0.1) / a_all) - math.log((r["b"] + 0.1) / b_all))
            for r in seen.collect()
            if r["gain"] > 0
        )
    )
    weighted = Model(bare.toxic, bare.ordinary, bare.context, weights)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(weighted)
        for batch in batches:
            found = [scorer.features(t) for t in taken(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found]), pa.array([f[1] for f in found]), batch.column("toxic")],
                ["strongest", "total", "toxic"],
            )

    # one row of two numbers per calibrating text, of which there is a bounded number
    rows = texts.mapInArrow(features, "strongest double, total double, toxic boolean").collect()
    coefficients = _logistic(
        np.array([(1.0, r["strongest"], r["total"]) for r in rows]).reshape(-1, 3),
        np.array([float(r["toxic"]) for r in rows]),
    )
    return Model(bare.toxic, bare.ordinary, bare.context, weights, coefficients)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton's method, with a small ridge for separable data."""
    w, ridge = np.zeros(3), 0.05
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge * np.eye(3), x.T @ (p - y) + ridge * w)
        w = w - np.clip(step, -5, 5)
    return tuple(float(v) for v in w)


#: Texts that a worker holds at once beside their batch.
TEXTS_AT_ONCE = 500


def _scored(batches: Iterator[pa.RecordBatch], scorer: _Scorer, columns: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, TEXTS_AT_ONCE):
            found = pa.array([scorer.score(t) for t in taken(part, "text")], pa.float64())
            yield pa.RecordBatch.from_arrays([*part.columns, found], [*columns, "score"])


def score(docs: DataFrame, model: Model | float) -> DataFrame:
    """``docs`` with ``score``, 0 to 1. Every window of every text is compressed.

    Only the text counts; null and empty texts have no windows and get the score of a
    text without signs. Works row by row: no shuffle. A column named score is replaced.
    """
    docs = docs.drop("score")
    if isinstance(model, float):
        return docs.withColumn("score", F.lit(model))
    columns = docs.columns

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _scored(batches, _scorer(model), columns)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(scored, f"{kinds}, score double")
