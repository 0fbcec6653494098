"""Collocations: streams of counts in plain Python, hot keys over many ranges, edge rows.
The query has an SQL twin."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from skyledger.llm import collocations
from skyledger.llm.collocations import best_collocations, counted, frequent_phrases, lockstep


def counts_of(texts, least):
    """(lang, phrase) -> count of all phrases up to four words, and words of each lang."""
    found, totals = Counter(), Counter()
    for lang, text in texts:
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\n\v\f\r]", lowered):
            words = re.findall(r"[^ \t]+", piece)
            totals[lang or "und"] += len(words)
            for m in range(1, 5):
                for i in range(len(words) - m + 1):
                    found[lang or "und", " ".join(words[i : i + m])] += 1
    return {k: n for k, n in found.items() if n >= least}, {k: n for k, n in totals.items() if n}


@pytest.fixture
def texts():
    draw = random.Random(9)
    words = ["the", "of", "x\x01", "x", "é", "A", "a", "new", "york", "\xa0", "big"]
    made = ["".join(draw.choice(words) + draw.choice([" ", " ", "\t ", ", ", ".\n"]) for _ in range(60)) for _ in range(60)]
    return [(draw.choice(["en", "de", None, "und"]), t) for t in made] + [("en", None), (None, ""), ("en", " \t.")]


def test_counts_equal_plain_ones(spark, texts, monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 500)
    monkeypatch.setattr(collocations, "MOST_BITS", 64)  # the filter lets most pass
    docs = spark.createDataFrame([(lang or "und", t or "") for lang, t in texts], "lang string, text string").repartition(4)
    phrases, totals = frequent_phrases(docs, 5)
    want, words = counts_of(texts, 5)
    assert {(r["lang"], r["phrase"]): r["n"] for r in phrases.collect()} == want
    assert {r["lang"]: r["n"] for r in totals.collect()} == words


def test_ranking_equals_plain_one(spark, texts):
    docs = spark.createDataFrame([(lang, t, "x", 1) for lang, t in texts], "lang string, text string, phrase string, n int")
    f, totals = counts_of(texts, 5)
    want = []
    for lang in totals:
        rows = []
        for (own, phrase), a in f.items():
            words = phrase.split(" ")
            if own != lang or len(words) == 1:
                continue
            if any(
                own == other and 100 * n >= 80 * a and f" {phrase} " in f" {longer} " and len(longer.split(" ")) > len(words)
                for (other, longer), n in f.items()
            ):
                continue
            cuts = [
                (2_000_000 * a // (l + r), k, l, r)
                for k in range(1, len(words))
                for l, r in [(f[lang, " ".join(words[:k])], f[lang, " ".join(words[k:])])]
            ]
            score, _, l, r = min(cuts)
            rows.append((-score, -a, phrase.encode(), phrase, a, l, r, score))
        for rank, (*_, phrase, a, l, r, score) in enumerate(sorted(rows)[:6], 1):
            want.append((lang, rank, phrase, a, l, r, totals[lang], score))
    got = [tuple(r) for r in best_collocations(docs, 6, 5).collect()]
    assert sorted(got) == sorted(want)
    assert best_collocations(docs.limit(0), 6).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    big = 8 * 10**18
    rows = [("en", "a", big), ("en", "b", big + 1), ("en", "a b", big - 1)]
    out = collocations.scored(spark.createDataFrame(rows, "lang string, phrase string, n bigint")).first()
    assert out["score"] == 2_000_000 * (big - 1) // (2 * big + 1)


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_lockstep_with_a_key_over_many_ranges(spark, parts):
    counts = [("en", k, n) for n, k in enumerate(["a", "hot", "z"], 1)] + [("de", "hot", 9)]
    questions = [("en", "hot", f"q{k}") for k in range(2_000)] + [("de", "hot", "d"), ("en", "z", "z"), ("en", "a", None)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = lockstep(
            spark.createDataFrame(counts, "lang string, key string, n bigint"),
            spark.createDataFrame(questions, "lang string, key string, who string"),
        ).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    known = {(lang, k): n for lang, k, n in counts}
    assert sorted((r["lang"], r["key"], str(r["who"]), r["found"]) for r in out) == sorted(
        (lang, k, str(who), known[lang, k]) for lang, k, who in questions
    )


def test_equal_phrases_are_added_across_batches(spark):
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rows = [(lang, f"p{k % 11}", k) for k in range(400) for lang in ("de", "en")]
        got = counted(spark.createDataFrame(rows, "lang string, phrase string, n bigint").repartition(3), 7_000).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    want = Counter()
    for lang, phrase, n in rows:
        want[lang, phrase] += n
    assert {(r["lang"], r["phrase"]): r["n"] for r in got} == {k: n for k, n in want.items() if n >= 7_000}
