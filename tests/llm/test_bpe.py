"""The tokenization automaton against the tokenizers library."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skyledger.llm import bpe
from skyledger.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def library():
    return LIBRARY


def ids_of(library, text):
    return library.encode(text, add_special_tokens=False).ids


def test_query_equals_the_library_on_the_whole_table(spark, sf_dir, library):
    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for row in texts:
        ids = ids_of(library, row["text"] or "")
        plain = library.decode(ids, skip_special_tokens=False)
        want.append((row["doc_id"], len(ids), digest(" ".join(map(str, ids))), digest(plain)))
    got = [tuple(r) for r in QUERIES["op12_bpe_codec"](spark, sf_dir).collect()]
    assert sorted(got) == sorted(want)


ODD = [
    "",
    "  ",
    "<|startoftext|>Hi <|endoftext|>x<|endoftext|",
    "<|endoftext|><|endoftext|>",
    "ΑΣ ΣΑΣ İI ﬁ ẞ K Å é",
    "a\xa0b c\x1c\x1dd\x85e﻿",
    "</w> <w> \x00\x01a",
    "he'll they've'rex ''s's't",
    "12345 ١٢٣ Ⅷ½ ²",
    "漢字かな हिन्दी 👩‍👩‍👧 \U0010ffff",
    "a" * 20_000,
    "ab" * 9_000 + " " + "!" * 9_000,
    "thethethe" * 3_000,
]


@pytest.mark.parametrize("text", ODD, ids=range(len(ODD)))
def test_odd_texts(library, text):
    codec = bpe.codec(PATH)
    assert codec.encode(text) == ids_of(library, text)
    assert codec.decode(codec.encode(text)) == library.decode(ids_of(library, text), skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40) | st.text("aeinth '.,\n<|>startofend", max_size=60))
def test_any_text(text):
    assert bpe.codec(PATH).encode(text) == ids_of(LIBRARY, text)


def merged(word, merges):
    """The merges applied one after the other, as they are defined."""
    parts = list(word)
    for a, b in merges:
        k = 0
        while k < len(parts) - 1:
            if parts[k] == a and parts[k + 1] == b:
                parts[k : k + 2] = [a + b]
            k += 1
    return parts


@pytest.mark.parametrize("seed", range(40))
def test_automaton_of_random_merges(seed):
    """Every word up to seven letters, on merge lists without any order of frequency."""
    draw = random.Random(seed)
    tokens, merges = list("ab"), []
    while len(merges) < 12:
        a, b = draw.choice(tokens), draw.choice(tokens)
        if a + b not in tokens:
            tokens.append(a + b)
            merges.append((a, b))
    vocabulary = {t: k for k, t in enumerate(tokens + ["a$", "b$"])}
    automaton = bpe.Automaton(vocabulary, merges, "$")
    for n in range(1, 8):
        for code in range(2**n):
            word = "".join("ab"[code >> k & 1] for k in range(n))
            # the last letter ends a word and so merges with nothing here
            want = [*merged(word[:-1], merges), word[-1] + "$"]
            assert [automaton.labels[i] for i in automaton.encode(word)] == want


def test_two_merges_of_one_token_are_refused():
    vocabulary = {t: k for k, t in enumerate(["a", "aa", "aaa"])}
    with pytest.raises(ValueError, match="same token"):
        bpe.Automaton(vocabulary, [("a", "a"), ("a", "aa"), ("aa", "a")], "")


def test_edge_rows_and_other_columns(spark, library):
    texts = [None, "", "Hello world", "Hello world", "x" * 50_000]
    data = [(7, t, "mine", "other") for t in texts] + [(None, "Hello", None, None)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, ids string, decoded string")
    rows = bpe.decoded(bpe.encoded(docs)).collect()
    assert [r["ids"] for r in rows] == [ids_of(library, t or "") for _, t, *_ in data]
    assert [r["decoded"] for r in rows] == [library.decode(r["ids"], skip_special_tokens=False) for r in rows]
    assert rows[0].asDict().keys() == {"doc_id", "ids", "decoded"}
    assert bpe.decoded(bpe.encoded(docs.limit(0))).collect() == []
    loose = spark.createDataFrame([(1, None), (2, [320, None, 99_999_999])], "doc_id int, ids array<int>")
    assert [r["decoded"] for r in bpe.decoded(loose).collect()] == ["", library.id_to_token(320)]
