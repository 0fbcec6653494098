"""Steps of the line deduplication: compiled, cut alike, and no further than the next run."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import functions as F

from skyledger.llm import line_dedup
from skyledger.llm.common import meet

HASHED = "row bigint, doc bigint, h array<bigint>, w array<tinyint>"


def shown(df, mode):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def test_fingerprints_are_compiled(spark, tmp_path):
    path = str(tmp_path / "h")
    spark.createDataFrame([(1, 1, list(range(40)), [3] * 40)], HASHED).write.parquet(path)
    plan = shown(line_dedup._fingerprints(spark.read.schema(HASHED).parquet(path)), "codegen")
    assert "lambdafunction" not in plan
    assert all(int(n) < 8_000 for n in re.findall(r"maxMethodCodeSize:(\d+)", plan))


def grams(h, w):
    """The same by plain loops: places of the window minima and the lines of their grams."""
    found = set()
    for i in range(len(h)):
        words, size = 0, 0
        while words < line_dedup.WINDOW_WORDS and size < 4:
            words, size = words + (w[i + size] if i + size < len(w) else 0), size + 1
        window = h[i : i + size]
        at = i + window.index(min(window))
        words, stop = 0, at
        while words < line_dedup.GRAM_WORDS and stop < len(h) and stop - at < line_dedup.GRAM_WORDS:
            words, stop = words + w[stop], stop + 1
        if words >= line_dedup.GRAM_WORDS:
            found.add((at, stop, tuple(h[at:stop])))
    return found


def test_fingerprints_equal_plain_loops(spark):
    import random

    draw = random.Random(3)
    docs = []
    for k in range(60):
        n = draw.choice([1, 2, 5, 30, 80])
        docs.append((k, k, [draw.randint(-9, 9) for _ in range(n)], [draw.choice([1, 1, 2, 3, 6, 17, 30]) for _ in range(n)]))
    got = {}
    for r in line_dedup._fingerprints(spark.createDataFrame(docs, HASHED)).collect():
        got.setdefault(r["row"], []).append((r["at"], r["stop"], r["fp"]))
    by_lines = {}
    for row, _, h, w in docs:
        assert sorted(x[:2] for x in got.get(row, [])) == sorted(x[:2] for x in grams(h, w)), row
        for at, stop, fp in got.get(row, []):
            assert by_lines.setdefault(tuple(h[at:stop]), fp) == fp
    assert len(set(by_lines.values())) == len(by_lines)


def test_lines_are_hashed_and_cut_alike(rows):
    odd = ["", "\n", "\n\na", "a. ", "x! \ny", "\x01. q\n z. ", "\x01 😀 a 😀 b, c", "😀 a 😀 b, c", ". . . ", "𠀀 a. b", "  \n "]
    pieces = F.split("text", line_dedup._LAST)
    for r in rows(odd).select("text", line_dedup.lines(F.col("text")).alias("l"), pieces.alias("p")).select(
        "text", "l", line_dedup._bare(F.col("p")).alias("bare")
    ).collect():
        assert "".join(r["l"]) == r["text"]
        assert [x.replace("\n", "").strip(" ") for x in r["l"]] == r["bare"]


def test_extension_ends_at_the_next_run(spark):
    matches = [(7, 1, 0, 0, 5), (7, 1, 0, 4, 9), (7, 1, 0, 9, 12), (7, 1, 0, 30, 34), (7, 1, 2, 13, 15), (7, 1, 0, 40, 41)]
    out = line_dedup._diagonals(spark.createDataFrame(matches, "row bigint, source bigint, shift int, start int, stop int"))
    assert sorted((r["shift"], r["start"], r["stop"], r["behind"], r["ahead"]) for r in out.collect()) == [
        (0, 0, 12, None, 18), (0, 30, 34, 18, 6), (0, 40, 41, 6, None), (2, 13, 15, None, None)
    ]


def lists(spark, pairs):
    return spark.createDataFrame(pairs, "room int, left array<bigint>, right array<bigint>")


def test_agreeing_elements_equal_plain_loops(spark):
    import random
    from itertools import takewhile

    draw = random.Random(5)
    for most in (1, 8, 64):
        pairs = []
        for k in range(200):
            left = [draw.randint(0, 9) for _ in range(draw.choice([0, 1, most // 2, most - 1, most, most]))]
            right = left[: draw.randint(0, len(left))] if k % 3 else list(left)
            right += [draw.randint(0, 9) for _ in range(draw.randint(0, most - len(right)))]
            pairs.append((k, left, right))
        for r in line_dedup._agreeing(lists(spark, pairs), most).collect():
            assert r["same"] == len(list(takewhile(lambda p: p[0] == p[1], zip(r["left"], r["right"], strict=False))))


def test_agreeing_elements_are_found_by_compiled_code(spark, tmp_path):
    path = str(tmp_path / "p")
    lists(spark, [(1, list(range(512)), list(range(512)))]).write.parquet(path)
    pairs = spark.read.schema("room int, left array<bigint>, right array<bigint>").parquet(path)
    plan = shown(line_dedup._agreeing(pairs, 512), "codegen")
    assert "lambdafunction" not in plan
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", plan)]
    assert sizes and all(n < 8_000 for n in sizes)


def test_unrepeated_fingerprints_are_not_sorted(spark):
    left = spark.range(50).selectExpr("id % 10 as fp", "id as row")
    right = spark.range(5).selectExpr("id as fp", "5L as n")
    met = meet(left, right, ["fp"], "n", 50, "inner", "shuffle_hash")
    assert met.count() == 25
    assert "ShuffledHashJoin" in shown(met, "simple")


RUNS = "row bigint, source bigint, shift int, start int, stop int"


def test_ends_within_what_goes_anyway_are_not_compared(spark, monkeypatch):
    """A copy of two texts: each of its runs ends where the other begins, or with the text."""
    first, second = list(range(100, 130)), list(range(200, 230))
    docs = [(1, 1, first + second, [3] * 60), (2, 2, second + [7], [3] * 31), (3, 3, first + second, [3] * 60)]
    diagonals = [(3, 1, 0, 0, 30), (3, 2, 30, 28, 60)]
    labels = []
    written = line_dedup.written
    monkeypatch.setattr(line_dedup, "written", lambda df, label, keep=False: labels.append(label) or written(df, label, keep))
    out = line_dedup._further(
        spark.createDataFrame(docs, HASHED), line_dedup._diagonals(spark.createDataFrame(diagonals, RUNS))
    )
    assert out.count() == 0
    assert "parts" not in labels


def test_extensions_cover_what_plain_loops_do(spark, monkeypatch):
    import random

    monkeypatch.setattr(line_dedup, "FURTHER", 2)
    monkeypatch.setattr(line_dedup, "FURTHER_YET", 2)
    draw = random.Random(11)
    text = [draw.randint(0, 3) for _ in range(60)]
    docs, matches = {}, []
    for row in range(30):
        start = draw.randint(0, 30)
        h = [x if draw.random() < 0.93 else 9 for x in text[start : start + draw.randint(1, 40)]]
        docs[row] = h if draw.random() < 0.8 else h + h
    for _ in range(1500):
        row, source = draw.randrange(30), draw.randrange(30)
        shift, at = draw.randint(-25, 25), draw.randrange(len(docs[row]))
        stop = at
        while stop < min(len(docs[row]), at + 4) and 0 <= stop - shift < len(docs[source]) and docs[row][stop] == docs[source][stop - shift]:
            stop += 1
        if stop - at > 1 and (row, 0) != (source, shift):
            matches.append((row, source, shift, at, stop))
    diagonals = line_dedup._diagonals(spark.createDataFrame(matches, RUNS)).localCheckpoint()
    covered, inside = set(), set()
    for r in diagonals.collect():
        h, s, k = docs[r["row"]], docs[r["source"]], r["shift"]
        at, stop = r["start"], r["stop"]
        inside |= {(r["row"], i) for i in range(at, stop)}
        while at > 0 and at - k > 0 and h[at - 1] == s[at - 1 - k] and (r["behind"] is None or r["start"] - at < r["behind"]):
            at -= 1
        while stop < len(h) and stop - k < len(s) and h[stop] == s[stop - k] and (r["ahead"] is None or stop - r["stop"] < r["ahead"]):
            stop += 1
        covered |= {(r["row"], i) for i in range(at, stop)}
    hashed = spark.createDataFrame([(row, row, h, [3] * len(h)) for row, h in docs.items()], HASHED)
    got = {(r["row"], i) for r in line_dedup._further(hashed, diagonals).collect() for i in range(*r["run"])}
    assert covered > inside
    assert got | inside == covered
