"""The operators against plain Python, and on edge rows."""

from __future__ import annotations

import random
import re
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from compare import compare, connect
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from skyledger.llm import (
    chat,
    decontamination,
    line_dedup,
    near_duplicates,
    packing,
    pii,
    quality,
    toxicity,
    url_filter,
    warc,
)
from skyledger.llm.queries import ORACLE, QUERIES

DRAW = random.Random(5)
VOCABULARY = ["".join(DRAW.choices("abcdeéü", k=DRAW.randint(2, 7))) for _ in range(400)]


def prose(n: int, seed: int) -> str:
    draw = random.Random(seed)
    words = [draw.choice(VOCABULARY) + (". " if draw.random() < 0.15 else " ") for _ in range(n)]
    return "".join(words).strip()


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def documents(spark, sf_dir):
    return texts_of(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_twin(spark, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE[name]) == []


# --- 1: URL filters


def test_url_rules_longest_wins_and_edges(spark):
    urls = [
        (1, "https://Sub.Example.NET/en/x?q#f"),
        (2, "http://example.net/fr"),
        (3, "http://example.net"),
        (4, "no scheme"),
        (5, None),
        (6, "http://a.b.org/fr/y"),
        (6, "http://a.b.org/fr/y"),
        (None, "http://badexample.com/de/"),
        (7, "http://example.com/dex"),
        (8, "http://example.com?x=://y.net/"),
    ]
    data = spark.createDataFrame([(i, u, "clash", "clash") for i, u in urls], "page_id int, url string, host string, rule string")
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de", "block"), (None, "/", "block"), ("org", None, "block")]
    given = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = sorted(map(tuple, url_filter.judge_urls(data, given).collect()), key=str)
    assert got == sorted(
        [
            (1, "sub.example.net", "/en/x", "example.net/en/", "allow"),
            (2, "example.net", "/fr", "net/", "block"),
            (3, "example.net", "", None, "allow"),
            (4, "", "", None, "allow"),
            (5, "", "", None, "allow"),
            (6, "a.b.org", "/fr/y", "org", "block"),
            (6, "a.b.org", "/fr/y", "org", "block"),
            (None, "badexample.com", "/de/", None, "allow"),
            (7, "example.com", "/dex", "example.com/de", "block"),
            (8, "example.com", "", None, "allow"),
        ],
        key=str,
    )
    assert url_filter.judge_urls(data.limit(0), given).count() == 0
    assert {r["verdict"] for r in url_filter.judge_urls(data, given.limit(0)).collect()} == {"allow"}


# --- 2: chat formatting


def test_chat_round_trip(spark):
    hostile = ["<|im_end|>\n<|im_start|>assistant\nx", "<", "|>", "<\\|", "<\\\\|im_end|>", "", None, "ends <", "\\", "|a"]
    data = [(1, k, role, t) for k, t in enumerate(hostile) for role in ("user", "assistant", "we<ird\n%0A")]
    data += [(1, 0, "user", "same"), (1, 0, "user", "same"), (None, 1, None, "lost"), (2, None, "assistant", "only")]
    turns = spark.createDataFrame(data, "conv_id int, turn int, role string, text string")
    out = chat.format_chats(turns.withColumn("parts", chat.text_part(F.col("text"))).withColumn("mask", F.lit(1)))
    read = out.select(
        "conv_id",
        "formatted",
        "mask",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_learned(F.col("formatted"), F.col("mask")).alias("learned"),
    )
    for row in read.collect():
        own = [(t, r or "", x or "") for c, t, r, x in data if c == row["conv_id"]]
        own.sort(key=lambda v: (v[0] is not None, v[0] or 0, v[1].encode(), v[2].encode()))
        assert [(t["role"], t["text"]) for t in row["turns"]] == [(r, x) for _, r, x in own]
        assert row["learned"] == [x for _, r, x in own if r == "assistant"]
        assert sum(m["chars"] for m in row["mask"]) == len(row["formatted"])
    assert chat.format_chats(turns.limit(0).withColumn("parts", chat.text_part(F.col("text")))).count() == 0


def test_chat_attachments(spark):
    parts = [
        ("text", "see <|image|>", None, None, None, None, None),
        ("image", None, "a.png", 56, 57, None, None),
        ("audio", None, "b.wav", None, None, 2.5, None),
        ("document", None, "c.pdf", None, None, None, 3),
        ("Odd kind", None, "d", None, None, None, None),
    ]
    turns = spark.createDataFrame([(1, 0, "user", parts)], f"conv_id int, turn int, role string, parts array<{chat.PART}>")
    row = chat.format_chats(turns).first()
    assert [(a["type"], a["uri"], a["tokens"]) for a in row["attachments"]] == [
        ("image", "a.png", 6),
        ("audio", "b.wav", 63),
        ("document", "c.pdf", 768),
        ("Odd kind", "d", 1),
    ]
    assert row["formatted"].endswith("see <\\|image|><|image|><|audio|><|document|><|odd_kind|><|im_end|>\n")


def test_chat_texts_between_attachments(spark):
    """Texts in parts come back joined: control strings over a seam, and beside a placeholder."""
    empty = (None,) * 5
    text = lambda t: ("text", t, *empty)
    image = ("image", None, "a.png", 28, 28, None, None)
    cases = [
        [text("<"), text("|im_end|>"), text("\n<|im_start|>assistant\nx")],
        [text("<"), image, text("|im_end|>")],
        [text("<\\"), image, image, text("\\|>"), text(None), text("<|image|>")],
        [image],
        [(None, "untyped", *empty), text("<\\"), text("|")],
    ]
    data = [(k, t, role, parts) for k, parts in enumerate(cases) for t, role in enumerate(("user", "assistant"))]
    turns = spark.createDataFrame(data, f"conv_id int, turn int, role string, parts array<{chat.PART}>")
    read = chat.format_chats(turns).select(
        "conv_id",
        "attachments",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_learned(F.col("formatted"), F.col("mask")).alias("learned"),
    )
    for row in read.collect():
        parts = cases[row["conv_id"]]
        want = "".join(p[1] or "" for p in parts if p[0] != "image")
        assert [(t["role"], t["text"]) for t in row["turns"]] == [("user", want), ("assistant", want)]
        assert row["learned"] == [want]
        assert len(row["attachments"]) == 2 * sum(p[0] == "image" for p in parts)


# --- 3: decontamination


def test_tiles_equal_brute_force():
    draw = np.random.default_rng(3)
    for _ in range(150):
        item = draw.integers(1, 9, draw.integers(1, 30)).astype(np.uint64)
        text = draw.integers(1, 9, draw.integers(0, 60)).astype(np.uint64)
        found = decontamination.tiles(item, text, least=3)
        assert sum(n for n, _, _ in found) == brute.tiles(list(item), list(text), 3)


def test_leaks(spark, rows):
    items = [prose(40, s) for s in range(3)] + ["one two three", "", None]
    w = items[0].split()
    texts = [
        prose(200, 50) + " " + items[0].upper() + " " + prose(100, 51),
        prose(30, 52) + " " + " ".join(w[22:]) + " " + prose(9, 53) + " " + " ".join(w[:22]),  # in another order
        prose(30, 54) + " " + " ".join(w[:20]),  # half of it
        "x One, two; THREE! y",
        items[1].replace(" ", "*** "),
        None,
        "",
        items[2] + items[2],
        items[2] + items[2],
    ]
    given = spark.createDataFrame([(k, t, "c") for k, t in enumerate(items)], "item_id int, text string, covered string")
    docs = rows(texts, [0, 1, 2, 3, 4, 5, 6, 7, 7])
    found = decontamination.leaks(docs, given)
    assert sorted((r["doc_id"], r["item_id"]) for r in found.collect()) == [(0, 0), (1, 0), (3, 3), (4, 1), (7, 2), (7, 2)]
    assert sorted(r["doc_id"] for r in decontamination.without_leaks(docs, given).collect()) == [2, 5, 6]
    assert decontamination.leaks(docs, given.limit(0)).count() == 0
    assert decontamination.leaks(docs.limit(0), given).count() == 0


def test_leaks_in_several_blocks(spark, rows, monkeypatch):
    items = [prose(30, s) for s in range(20)]
    given = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    docs = rows([prose(50, 99) + " " + x for x in items])
    whole = sorted(map(tuple, decontamination.leaks(docs, given).collect()))
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 200)
    assert sorted(map(tuple, decontamination.leaks(docs, given).collect())) == whole
    assert {(i, i) for i in range(20)} <= {r[:2] for r in whole}
    assert decontamination.without_leaks(docs, given).count() == 0


# --- 4: near duplicates


def near(docs):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates.near_duplicates(docs).collect()}


def edited(text: str, n: int, seed: int) -> str:
    draw, words = random.Random(seed), text.split()
    for k in draw.sample(range(len(words)), n):
        words[k] = "edit" + str(draw.random())
    return " ".join(words)


def test_near_duplicates_equal_brute_force(rows):
    base = prose(120, 1)
    texts = [edited(base, n, n) for n in range(12) for _ in range(2)] + [prose(60, s) for s in range(10)]
    texts += ["a b", "A  b", "a", "", None, " \t", prose(5000, 3), prose(4990, 3), "a b c d e", "a b c d e f"]
    got = near(rows(texts))
    assert {i: v[:2] for i, v in got.items()} == brute.near_groups(dict(enumerate(texts)))
    assert all(kept == (i == c) for i, (_, c, kept) in got.items())


def test_crowded_buckets_equal_brute_force(rows, monkeypatch):
    monkeypatch.setattr(near_duplicates, "CROWD", 3)
    monkeypatch.setattr(near_duplicates, "BLOCK_BYTES", 4000)
    base = prose(60, 2)
    texts = [base + " " + prose(n % 37 + 1, n) for n in range(80)]
    got = near(rows(texts))
    assert {i: v[:2] for i, v in got.items()} == brute.near_groups(dict(enumerate(texts)))


def test_near_duplicates_edge_rows(spark, rows):
    assert near(rows([])) == {}
    docs = rows(["same words here again now"] * 3 + [None], [None, 5, 5, 6])
    got = sorted(map(tuple, near_duplicates.near_duplicates(docs).select("doc_id", "component_id", "kept").collect()), key=str)
    assert got == [(5, 5, True), (5, 5, True), (6, 6, True), (None, 5, False)]


def test_near_duplicates_of_the_table(spark, sf_dir):
    texts = documents(spark, sf_dir)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op4_near_duplicates"](spark, sf_dir).collect()}
    assert got == brute.near_groups(texts)


# --- 5: personal data


def test_base_spans_equal_patterns(spark, sf_dir):
    draw = random.Random(8)
    texts = ["".join(draw.choices("ab@..--+ 0123456789()_%\né", k=draw.randint(0, 90))) for _ in range(4000)]
    texts += ["4539 1488 0343 6467", "+1 (714) 555-9345.", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "300.1.1.1 0001.2.3.4", "+1 ", "@", "1" * 5000]
    texts += list(documents(spark, sf_dir).values())
    for text in texts:
        found = [s for s in pii.find(text) if s[0] in pii.BASE_KINDS]
        assert found == brute.base_spans(text), text


def test_added_spans():
    def kinds(text, kind):
        return [text[a:b] for k, a, b in pii.find(text) if k == kind]

    assert kinds("see (https://a.b/c?d=1), http://", "url") == ["https://a.b/c?d=1"]
    assert kinds('token = "x" Account: AB12-9981, tokens12345', "account") == ["AB12-9981"]
    assert kinds("at 12 Old Mill Road, 7 road", "address") == ["12 Old Mill Road"]


def test_personal_data_query(spark, sf_dir, rows):
    texts = documents(spark, sf_dir)
    for r in QUERIES["op5_personal_data"](spark, sf_dir).collect():
        spans = brute.base_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == brute.sha256(brute.listed(spans))
        assert [r[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(s[0] == k for s in spans) for k in pii.BASE_KINDS]
        assert [s for s in r["spans"].split(",") if s.split(":")[0] in pii.BASE_KINDS] == [f"{k}:{a}:{b}" for k, a, b in spans]
    got = pii.personal_data(rows([None, "", "é a@b.co"], [1, 1, None])).collect()
    assert sorted(len(r["spans"]) for r in got) == [0, 0, 1]
    assert pii.personal_data(rows([])).count() == 0


# --- 6: quality rules


def test_measures_equal_brute_force(spark, sf_dir, rows):
    texts = documents(spark, sf_dir)
    for r in QUERIES["op6_quality_rules"](spark, sf_dir).collect():
        want = brute.measures(texts[r["doc_id"]])
        assert tuple(r[f] for f in quality.FEATURES[:5]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])
    odd = [None, "", " \n", "a b c a b c", "a a a a a", "x\nx\n \n \nx", "#*$ <b>", "é " * 4]
    for r in quality.features(rows(odd)).collect():
        assert tuple(r[f] for f in quality.FEATURES[:5]) == brute.measures(odd[r["doc_id"]])


def test_binomial_bound(spark):
    from math import comb

    cases = [(0, 10, 0.05), (3, 1000, 0.01), (5, 4000, 0.01), (40, 6000, 0.01), (200, 30000, 0.01)]
    for k, n, p in cases:
        got = spark.range(1).select(
            quality.binomial_at_most(F.col("id") * 0.0 + float(k), F.col("id") * 0.0 + float(n), p)
        ).first()[0]
        want = sum(comb(n, i) * p**i * (1 - p) ** (n - i) if n < 1000 else np.exp(_log_pmf(i, n, p)) for i in range(k + 1))
        assert got == pytest.approx(want, rel=1e-8)


def _log_pmf(k, n, p):
    from math import lgamma, log

    return lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * log(p) + (n - k) * log(1 - p)


def test_quality_keeps_good_documents(spark, rows):
    texts = [prose(80, s) if s % 4 else "# " * 60 + prose(60, s) for s in range(2000)]
    docs = rows(texts)
    labels = spark.createDataFrame([(s, int(s % 4 > 0), "c") for s in range(2000)] + [(None, 1, "c"), (3, None, "c")], "doc_id bigint, quality int, kept string")
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(docs, labels, risk=0.1).collect()}
    good = [kept[s] for s in range(2000) if s % 4]
    assert sum(good) >= 0.9 * len(good)
    assert not any(kept[s] for s in range(0, 2000, 4))
    none = quality.judge(docs, labels.limit(0)).where("kept = base_failed")
    assert none.count() == 0
    assert quality.judge(rows([]), labels).count() == 0


def test_quality_rules_fire_with_some_hundred_labels(spark, rows):
    """400 good and 60 bad labelled documents beside a large stratum, at the default risk."""
    texts = [prose(80, s) if s % 8 else "# " * 40 + prose(80, s) for s in range(460)]
    texts += [prose(80, s) for s in range(460, 1500)]
    docs = rows(texts).withColumn("lang", F.when(F.col("doc_id") < 460, "small").otherwise("large"))
    labels = spark.createDataFrame([(s, int(s >= 460 or s % 8 > 0)) for s in range(1500)], "doc_id bigint, quality int")
    got = {r["doc_id"]: r for r in quality.judge(docs, labels).collect()}
    bad = [s for s in range(460) if s % 8 == 0]
    assert not any(got[s]["kept"] or got[s]["base_failed"] for s in bad)
    assert all("symbols" in got[s]["rejected_by"] for s in bad)
    for part in (range(460), range(460, 1500)):
        good = [bool(got[s]["rejected_by"]) for s in part if s >= 460 or s % 8]
        assert sum(good) <= quality.RISK * len(good)


# --- 7: toxicity


def test_toxicity_learns_words(spark, rows):
    draw = random.Random(4)

    def toxic(s):
        words = prose(80, s).split()
        for k in range(4):
            words[draw.randrange(80)] = draw.choice(["zarquon", "vogonic", "grebulon"])
        return " ".join(words)

    texts = [toxic(s) if s % 3 == 0 else prose(80, s) for s in range(1200)]
    docs = rows(texts)
    labels = spark.createDataFrame([(s, int(s % 3 == 0), "c") for s in range(1200)], "doc_id bigint, toxic int, score string")
    model = toxicity.fit(docs, labels)
    held = {s for s in range(1200) if zlib.crc32(str(s).encode()) % 4 == 2}
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert all((got[s] >= 0.3) == (s % 3 == 0) for s in held)
    assert {r["doc_id"] for r in docs.where(toxicity.fold(F.col("doc_id")) == 2).collect()} == held
    edge = [r["score"] for r in toxicity.score(rows([None, "", "x" * 100_000], [1, 1, None]), model).collect()]
    assert all(0 <= s < 0.3 for s in edge)
    assert toxicity.score(rows([]), model).count() == 0


@pytest.mark.parametrize("label, score", [(None, 0.0), (0, 0.0), (1, 0.0)])
def test_toxicity_without_two_classes(spark, rows, label, score):
    labels = spark.createDataFrame([(1, label), (2, label)], "doc_id bigint, toxic int")
    docs = rows([prose(20, 1)] * 3)
    assert {r["score"] for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()} == {score}


# --- 8: archives


def test_archives_round_trip(spark, tmp_path):
    big = "é" * 600
    payloads = [(1, big), (2, big), (3, big), (4, "small"), (5, "small"), (6, None), (7, "\r\n\r\nWARC/1.1\r\nWARC-Type: x\r\n\r\n" * 50), (8, ""), (3, big), (None, big)]
    pages = spark.createDataFrame(
        [(i, f"http://b{(i or 0) % 2}.a.com/x\r\ny" if i != 4 else None, p, 1000 - (i or 0), "c") for i, p in payloads],
        "page_id bigint, url string, payload string, at int, digest_ string",
    ).withColumn("timestamp", F.timestamp_seconds("at"))
    path = str(tmp_path / "archives")
    warc.write_archives(warc.with_revisits(pages), path)
    index = warc.merged_index(warc.read_captures(spark, path)).collect()
    got = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in index), key=str)
    want = [(i, len((p or "").encode()), "revisit" if i in (1, 2) else "response", 3 if i in (1, 2) else None) for i, p in payloads]
    assert got == sorted(want, key=str)
    order = [(r["url_key"], r["timestamp"], r["page_id"] or -1) for r in sorted(index, key=lambda r: (r["range"], r["place"]))]
    assert order == sorted(order)
    warc.write_archives(warc.with_revisits(pages.limit(0)), str(tmp_path / "none"))
    assert warc.merged_index(warc.read_captures(spark, str(tmp_path / "none"))).count() == 0


def test_index_in_several_ranges(spark, sf_dir, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "RANGE_ROWS", 10)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").withColumnRenamed("html", "payload")
    pages = pages.withColumn("timestamp", F.timestamp_seconds("page_id")).repartition(5)
    warc.write_archives(warc.with_revisits(pages), str(tmp_path / "a"))
    index = warc.merged_index(warc.read_captures(spark, str(tmp_path / "a"))).collect()
    order = [(r["url_key"], r["timestamp"], r["page_id"]) for r in sorted(index, key=lambda r: (r["range"], r["place"]))]
    assert order == sorted(order) and len(order) == pages.count()
    assert len({r["range"] for r in index}) > 3
    everywhere = warc.numbered(warc.merged_index(warc.read_captures(spark, str(tmp_path / "a")))).collect()
    everywhere.sort(key=lambda r: r["place"])
    assert [r["place"] for r in everywhere] == list(range(len(order)))
    assert [(r["url_key"], r["timestamp"], r["page_id"]) for r in everywhere] == order
    assert warc.numbered(warc.merged_index(warc.read_captures(spark, str(tmp_path / "a")).limit(0))).count() == 0


def test_loser_tree():
    draw = random.Random(2)
    for runs in range(1, 12):
        lists = [sorted(draw.choices(range(20), k=draw.randint(0, 15))) for _ in range(runs)]
        merged = [lists[r][k] for r, k in warc.LoserTree(lists)]
        assert merged == sorted(x for part in lists for x in part)


# --- 9: line deduplication


def held_against_brute(texts, got):
    inside = brute.repeats(texts, line_dedup.GRAM_WORDS, True)
    always = brute.repeats(texts, line_dedup.GRAM_WORDS + line_dedup.WINDOW_WORDS, False)
    for i, text in texts.items():
        parts = brute.line_list(text or "")
        most = "".join(x for k, x in enumerate(parts) if k not in inside[i])
        least = "".join(x for k, x in enumerate(parts) if k not in always[i])
        if not inside[i]:
            assert got[i] == text
        assert len(most) <= len(got[i] or "") <= len(least)
    return always


def test_line_dedup_of_the_table(spark, sf_dir):
    texts = documents(spark, sf_dir)
    got = texts_of(QUERIES["op9_line_dedup"](spark, sf_dir))
    assert any(held_against_brute(texts, got).values())


def test_line_dedup_edges(rows, monkeypatch):
    passage = prose(70, 7) + "."
    texts = [
        "First. " + passage + "\nOwn end.",
        "Second\x01. " + passage + "\nOther end.",
        prose(60, 8),
        passage + " " + passage,
        None,
        "",
        "short line. " * 3,
        prose(9000, 9),
        passage,
    ]
    for bound in (line_dedup.BROADCAST_BYTES, 0):
        monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", bound)
        out = line_dedup.without_repeats(rows(texts).withColumn("removed", F.lit("clash")))
        got = texts_of(out)
        held_against_brute(dict(enumerate(texts)), got)
        assert got[0] == texts[0] and got[8] == ""
        assert got[1] == "Second\x01. Other end."
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "n", "row", "removed"]
    assert line_dedup.without_repeats(rows([])).count() == 0


def test_line_dedup_keeps_equal_rows(rows):
    text = prose(100, 3)
    out = line_dedup.without_repeats(rows([text, text, text, text], [1, 1, None, 2])).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], r["text"] == text) for r in out if r["doc_id"]) == [(False, 1, False), (False, 1, False), (False, 2, False)]
    assert [r["text"] for r in out if r["doc_id"] is None] == [text]


def plain(n, seed):
    return " ".join(random.Random(seed).choices(VOCABULARY, k=n))


def test_line_dedup_of_copies_between_commas(rows):
    """60 words that begin and end within a sentence, with an edit in the middle of another one."""
    clauses = [plain(5, 100 + k) for k in range(12)]
    copied = ", ".join(clauses) + ", "
    texts = [f"{plain(9, 1)}, {copied}{plain(8, 2)}.", f"{plain(7, 3)}, {copied}{plain(6, 4)}."]
    edited = clauses[:9] + ["edit"] + clauses[9:]
    texts.append(f"{plain(9, 5)}; {', '.join(edited)}, {plain(6, 6)}.")
    got = texts_of(line_dedup.without_repeats(rows(texts)))
    assert got[0] == texts[0]
    assert got[1] == f"{plain(7, 3)}, {plain(6, 4)}."
    assert got[2] == f"{plain(9, 5)}; edit, {', '.join(clauses[9:])}, {plain(6, 6)}."


@pytest.mark.parametrize("tail", [1, 6, 20, 63, 64, 70, 700])
def test_line_dedup_goes_on_until_lines_differ(rows, tail):
    """A line of 30 words between ``tail`` lines of one word, in two documents and twice in a third."""
    short = [f"{w}{k}.\n" for k, w in enumerate(random.Random(tail).choices(VOCABULARY, k=tail))]
    run = "".join([*short, plain(30, 1), ".\n", *reversed(short)])
    texts = [f"one\n{run}two\n", f"three\n{run}four\n", f"five\n{run}six\n{run}seven\n", run]
    got = texts_of(line_dedup.without_repeats(rows(texts)))
    assert got == {0: texts[0], 1: "three\nfour\n", 2: "five\nsix\nseven\n", 3: ""}


def test_line_dedup_removes_all_of_long_runs(spark, sf_dir, monkeypatch):
    """Over the table with lines that end at any punctuation: all of every run of 40 words goes."""
    texts = documents(spark, sf_dir)
    got = texts_of(QUERIES["op9_line_dedup"](spark, sf_dir))
    inside = brute.repeats(texts, line_dedup.GRAM_WORDS, True)
    always = brute.repeats(texts, 40, False)
    assert any(always.values())
    for i, text in texts.items():
        parts = brute.line_list(text or "")
        most = "".join(x for k, x in enumerate(parts) if k not in inside[i])
        least = "".join(x for k, x in enumerate(parts) if k not in always[i])
        assert len(most) <= len(got[i] or "") <= len(least), i


def test_line_dedup_counts_words_between_tabs(rows):
    """60 words on ten lines of a table whose columns tabs part."""
    block = "".join(plain(6, k).replace(" ", "\t") + "\n" for k in range(10))
    got = texts_of(line_dedup.without_repeats(rows([f"one\n{block}two\n", f"three\n{block}four\n"])))
    assert got == {0: f"one\n{block}two\n", 1: "three\nfour\n"}


# --- 10: packing


def test_packing_equals_tokenizer(spark, sf_dir):
    texts = documents(spark, sf_dir)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = {}
    for r in QUERIES["op10_best_fit_packing"](spark, sf_dir).collect():
        found.setdefault(r["doc_id"], []).append(r)
    for i, text in texts.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        at = 0
        for k, r in enumerate(sorted(found[i], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at)
            own = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(own)
            at += r["length"]
        assert at == len(ids)


def test_tokens_of_odd_texts():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = packing._encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    draw = random.Random(6)
    texts = ["", "a <|endoftext|> b<|endoftext|>\n c", "  x \n y ", "日本語　テスト 😀", "don't we'LL 12 34.5", "\x1c\x85 \xa0b"]
    texts += ["".join(draw.choices("ab '\n\té1Ⅷ.<|>endoftxsl　​😀", k=40)) for _ in range(500)]
    for text in texts:
        assert list(encode(text)) == tokenizer.encode(text, add_special_tokens=False).ids


def filled(out, capacity):
    by = {}
    for r in out.collect():
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return by


def test_packing_fills_sequences(spark):
    draw = random.Random(1)
    lengths = [min(100, int(draw.lognormvariate(3, 1)) + 1) for _ in range(3000)] + [33] * 1500
    pieces = spark.createDataFrame([(k, n, "c", 1) for k, n in enumerate(lengths)], "id int, length bigint, offset string, piece int")
    out = packing.pack(pieces.repartition(5), 100)
    assert out.count() == len(lengths)
    decreasing = []  # bins of first fit, longest first
    for n in sorted(lengths, reverse=True):
        k = next((k for k, room in enumerate(decreasing) if room >= n), len(decreasing))
        decreasing[k:] = [(decreasing[k] if k < len(decreasing) else 100) - n, *decreasing[k + 1 :]]
    assert len(filled(out, 100)) <= len(decreasing)
    assert packing.pack(pieces.limit(0), 100).count() == 0
    with pytest.raises(ValueError):
        packing.pack(pieces, 99)


def test_pieces_of_edge_rows(rows):
    out = packing.token_pieces(rows([None, "", "word " * 5000], [1, 1, None])).collect()
    assert sorted(r["length"] for r in out if r["doc_id"] == 1) == [1, 1]
    long = sorted((r["piece"], r["start"], r["length"]) for r in out if r["doc_id"] is None)
    assert [n for _, _, n in long[1:]] == [2048] * (len(long) - 1) and long[1][1] == long[0][2]
    assert packing.token_pieces(rows([])).count() == 0


# --- the pipeline


def test_pipeline_stages(spark, sf_dir, rows):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line dedup", "near dedup", "decontamination", "packing"]
    base = prose(100, 1)
    odd = rows([base, edited(base, 2, 1), base, None, "", prose(60, 5), prose(60, 5)], [3, 2, 1, 4, None, 6, 6]).select(*docs.columns)
    assert sorted(r["doc_id"] or 0 for r in corpus_pipeline.one_of_each_group(spark, odd, sf_dir).collect()) == [0, 1, 4, 6]
    lines = corpus_pipeline.without_repeated_lines(spark, odd, sf_dir)
    assert all(r["n_chars"] == len(r["text"] or "") for r in lines.collect())
    assert sorted(r["doc_id"] or 0 for r in lines.where("length(text) > 50").collect())[:1] == [1]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for given in (odd, docs.limit(0)):
            assert stage(spark, given, sf_dir).columns == docs.columns


def test_pipeline_packs_what_is_left(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
    out = corpus_pipeline.run(spark, sf_dir)
    assert {r["doc_id"] for r in docs.select("doc_id").collect()} == {r["doc_id"] for r in out.select("doc_id").collect()}
    filled(out, packing.CAPACITY)
