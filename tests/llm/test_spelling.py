"""Spelling variants against plain Python, and on edge rows. The query has an SQL twin."""

from __future__ import annotations

import random

import pytest

from skyledger.llm import spelling


def one_edit(a, b):
    if a == b:
        return False
    p = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[p + 1 :] == b[p + 1 :] or a[p + 1 :] == b[p:] or a[p:] == b[p + 1 :]


def plain(counts, ratio=10):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, form[w], root(w), counts[w], len(near[w]), counts.get(form[w])) for w in counts}


def found(spark, counts):
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(3)
    return {tuple(r) for r in spelling.variants(words).collect()}


@pytest.mark.parametrize("seed, letters", [(1, "ab"), (2, "aé÷"), (3, "abcdefg")])
def test_variants_of_random_words(spark, seed, letters):
    draw = random.Random(seed)
    words = {"".join(draw.choices(letters, k=draw.randint(2, 8))) for _ in range(250)}
    counts = {w: draw.choice([2, 3, 20, 30, 400]) for w in words}
    assert found(spark, counts) == plain(counts)


def test_long_and_repeated_letters(spark):
    long = "".join(random.Random(5).choices("abcdef", k=30_000))
    words = ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "baaaaaaa", "aaaaaaab", "aaabaaaa", "aa", "ab", "b" * 40, "b" * 41]
    words += [long, long[:15_000] + "x" + long[15_001:], long[1:], long + "y", "q" + long, long[:-2]]
    counts = {w: 2 + 19 * (k % 2) for k, w in enumerate(words)}
    assert found(spark, counts) == plain(counts)


def test_one_prefix_in_front_of_all_words(spark):
    """A node that every word passes is no bucket whose pairs are looked at."""
    draw = random.Random(7)
    counts = {"prefix" + "".join(draw.choices("abcdefgh", k=5)): draw.choice([2, 50]) for _ in range(400)}
    assert found(spark, counts) == plain(counts)


def test_words_of_edge_rows(spark, rows):
    texts = [None, "", "Running, RUNNING running7 running_x", "run", "Ünüsual ünüsual", "abcdefg" * 9_000, "abcdefg" * 9_000]
    docs = rows(texts, [1, 2, 3, 4, 5, 6, None])
    got = {r["word"]: r["n"] for r in spelling.words_of(docs).collect()}
    # A-Z alone are lowered: the capital letter outside stays another one
    assert got == {"running": 4, "abcdefg" * 9_000: 2}
    assert spelling.words_of(docs.limit(0)).count() == 0
    assert found(spark, {}) == set() == {tuple(r) for r in spelling.variants(spelling.words_of(docs.limit(0))).collect()}
