"""Spelling variants: words one edit apart, found by a frontier of states in a trie.

The trie's edges are a table (node, first character, label, child). A node is the hash of
the characters up to it; only nodes where words part or end are kept, so a label may hold
many characters and the levels are as few as the places where words part. A state is a
word, the node where it stands in the trie, what is left of it to read, and whether the
edit has been made.

A word reads itself without an edit, so its states without one are the nodes on its own
path. Where another edge leaves that path, the edit is made: the word's character is
replaced, left out or put in front of the edge's, and the edge's label must read on.
States then meet the edges level by level; a state that ends with its word at a node where
a word ends has found a neighbour.

A word of n characters that differs by one edit keeps its first n // 2 characters or its
last ones. So there are two tries, of words forwards and backwards, and edits are made
from n // 2 on only: near the root, where every node has an edge for every letter, no
state is split. What both find counts once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import scratch, taken, written
from skyledger.llm.word_hashes import mix, stream

# The letters of a run, and how many a word has at least.
LETTERS, LEAST_LETTERS = r"A-Za-z\x{00C0}-\x{00FF}", 7
#: A word counts from so many occurrences on.
LEAST = 2
#: A form is so many times as frequent as its variant.
FORM_RATIO = 10

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def damaged(key: Column, run: Column, one_in: int) -> Column:
    """``run``, without one character where ``one_in`` divides the CRC-32 of key:run; the
    place is the CRC-32 modulo the length."""
    crc = F.crc32(F.concat(key.cast("string"), F.lit(":"), run).cast("binary"))
    at = F.pmod(crc, F.char_length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(crc % one_in == 0, cut).otherwise(run)


def words_of(docs: DataFrame, damage: int | None = None, least: int = LEAST) -> DataFrame:
    """(word, n) of all words of LEAST_LETTERS or more that occur ``least`` times or more.

    Words are maximal runs of letters of the texts (null: none), A-Z lower-cased. With
    ``damage``, one run in so many of each document (``doc_id``; null as the text null)
    loses a character first.
    """
    runs = F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"[{LETTERS}]{{{LEAST_LETTERS},}}"), F.lit(0))
    each = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("doc_id"), F.explode(runs).alias("run"))
    word = F.translate("run", _UPPER, _LOWER)
    if damage:
        each = each.select("doc_id", word.alias("run"))
        word = damaged(F.col("doc_id"), F.col("run"), damage)
    counted = each.select(word.alias("word")).where(F.char_length("word") >= LEAST_LETTERS)
    return counted.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


_PATHS = pa.schema(
    [
        ("word", pa.string()),
        ("n", pa.int64()),
        ("back", pa.bool_()),
        ("first", pa.int32()),
        ("nodes", pa.list_(pa.int64())),
        ("letters", pa.list_(pa.int32())),
    ]
)
_PATHS_DDL = "word string, n bigint, back boolean, first int, nodes array<bigint>, letters array<int>"


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every word forwards and backwards, with the nodes on its path from one character
    before its middle on, and the letter that follows each (-1 at the end). A node is the
    sum of its characters' hashes times powers."""
    for batch in batches:
        if not batch.num_rows:
            continue
        words = taken(batch, "word")
        sizes = np.array([len(w) for w in words])
        starts = np.cumsum(sizes) - sizes
        total = int(sizes.sum())
        letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        place = np.arange(total) - np.repeat(starts, sizes)
        powers = np.full(int(sizes.max()) + 1, 0x5851F42D4C957F2D, np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        firsts = sizes // 2 - 1
        # one node more than letters from the first on
        counts = sizes - firsts + 1
        offsets = np.append(0, np.cumsum(counts))
        depth = np.arange(offsets[-1]) - np.repeat(offsets[:-1], counts) + np.repeat(firsts, counts)
        at = np.repeat(starts, counts) + depth
        ended = depth == np.repeat(sizes, counts)
        for back in (False, True):
            own = letters if not back else letters[np.repeat(starts + sizes - 1, sizes) - place]
            # characters of both directions are told apart, and so are the tries
            values = mix(own.astype(np.uint64) + stream(11 + back, 1)) * powers[place]
            sums = np.append(np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64))
            nodes = mix(sums[at] - np.repeat(sums[starts], counts) + depth.astype(np.uint64)).view(np.int64)
            following = np.where(ended, -1, np.append(own, -1)[np.where(ended, total, at)]).astype(np.int32)
            index = pa.array(offsets.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([w[::-1] for w in words] if back else words, pa.string()),
                    batch.column("n").cast(pa.int64()),
                    pa.array([back] * len(words)),
                    pa.array(firsts.astype(np.int32)),
                    pa.ListArray.from_arrays(index, pa.array(nodes)),
                    pa.ListArray.from_arrays(index, pa.array(following)),
                ],
                schema=_PATHS,
            )


def _trie(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges, states without an edit) of both tries, as written tables.

    Edges: node, ch, label, child, the count of the word that ends at the child, and the
    letters that go on from there. States: word, back, at, node, and the count of the word
    that ends at the node.
    """
    with scratch():
        paths = written(words.mapInArrow(_paths, _PATHS_DDL), "paths")
        steps = paths.select(
            "word", "n", "back", "first", F.posexplode(F.arrays_zip("nodes", "letters")).alias("place", "step")
        ).select("word", "n", "back", (F.col("first") + F.col("place")).alias("at"), "step.nodes", "step.letters")
        nodes = written(
            steps.groupBy(F.col("nodes").alias("node"))
            .agg(
                F.min("letters").alias("low"),
                F.max("letters").alias("high"),
                F.max(F.when(F.col("letters") == -1, F.col("n"))).alias("end_n"),
            )
            .where("low = -1 or low <> high")
            .select("node", "end_n"),
            "nodes",
        )
        met = steps.select("word", "back", "at", F.col("nodes").alias("node")).join(nodes, "node")
        stops = F.sort_array(F.collect_list(F.struct("at", "node", "end_n")))
        stopped = written(met.groupBy("word", "back").agg(stops.alias("stops")), "stops")
        # from each stop of a path to the next; the last is the word's own end
        edge = F.expr(
            """explode(transform(slice(stops, 1, size(stops) - 1), (s, i) -> struct(
                 s.node as node,
                 substring(word, s.at + 1, stops[i + 1].at - s.at) as label,
                 stops[i + 1].node as child, stops[i + 1].end_n as end_n)))"""
        )
        every = stopped.where("size(stops) > 1").select(edge.alias("e")).select("e.*")
        # all words on an edge have the same label and child
        edges = written(
            every.withColumn("ch", F.substring("label", 1, 1))
            .groupBy("node", "ch")
            .agg(*(F.max(c).alias(c) for c in ("label", "child", "end_n"))),
            "bare-edges",
        )
        onward = edges.groupBy("node").agg(F.array_join(F.collect_list("ch"), "").alias("onward"))
        known = edges.join(onward.withColumnRenamed("node", "child"), "child", "left")
        states = stopped.select("word", "back", F.explode("stops").alias("s")).where("s.at >= char_length(word) div 2")
        return (
            written(known.withColumn("onward", F.coalesce("onward", F.lit(""))), "edges", keep=True),
            written(states.select("word", "back", "s.*"), "first-states", keep=True),
        )


#: A state may end where a word ends, and go on where an edge begins with its next letter.
_ALIVE = "if(rest = '', end_n is not null, instr(onward, substring(rest, 1, 1)) > 0)"


def neighbours(words: DataFrame) -> DataFrame:
    """(word, near, near_n) of all pairs one inserted, deleted or replaced character apart,
    in both orders, from (word, n) with each word once and no word of less than two."""
    with scratch():
        edges, states = _trie(words)
        # a word that ends one character before this one does
        shorter = states.where("end_n is not null and at = char_length(word) - 1")
        found = [shorter.select("word", "back", F.expr("substring(word, 1, at)").alias("near"), "end_n")]

        def split(met: DataFrame, level: int) -> DataFrame:
            """Those that have found a neighbour are noted, the others go on."""
            stored = written(met.where(_ALIVE).drop("onward"), f"frontier-{level}")
            found.append(stored.where("rest = ''").select("word", "back", "near", "end_n"))
            return stored.where("rest <> ''").drop("end_n")

        # one letter of the word, of the edge or of both is passed over: what is left then has
        # to begin with the label, and with a letter that goes on from the child
        far = "char_length(word)"
        leaving = (
            states.select("word", "back", "at", "node", F.expr(f"substring(word, at + 1, {far})").alias("own"))
            .join(edges.select("*", F.expr("substring(label, 2, char_length(label))").alias("tail")), "node")
            .where("ch <> substring(own, 1, 1)")
            .select(
                *("word", "back", "at", "own", "ch", "child", "end_n", "onward"),
                F.expr(f"substring(own, 2, {far})").alias("less"),
                "tail",
                F.expr("char_length(tail)").alias("read"),
            )
        )
        alive = lambda letter: f"if({letter} = '', end_n is not null, instr(onward, {letter}) > 0)"
        replaced = f"own <> '' and startswith(less, tail) and {alive('substring(less, read + 1, 1)')}"
        put_in = f"startswith(own, tail) and {alive('substring(own, read + 1, 1)')}"
        left_out = (
            "own <> '' and substring(less, 1, 1) = ch and startswith(substring(less, 2, read), tail) and "
            + alive("substring(less, read + 2, 1)")
        )
        edited = leaving.where(f"({replaced}) or ({put_in}) or ({left_out})").select(
            "*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("edit")
        ).where(f"case edit when 0 then {replaced} when 1 then {put_in} else {left_out} end")
        level = 0
        frontier = split(
            edited.select(
                "word",
                "back",
                F.expr(
                    """concat(substring(word, 1, at), if(edit = 2, '', ch), if(edit = 1, own, less))"""
                ).alias("near"),
                F.col("child").alias("node"),
                F.expr(
                    f"""case edit when 1 then substring(own, read + 1, {far})
                        when 0 then substring(less, read + 1, {far}) else substring(less, read + 2, {far}) end"""
                ).alias("rest"),
                "end_n",
                "onward",
            ),
            level,
        )
        while not frontier.isEmpty():
            level += 1
            ahead = frontier.withColumn("ch", F.substring("rest", 1, 1)).join(edges, ["node", "ch"])
            frontier = split(
                ahead.where(F.startswith("rest", "label")).select(
                    "word",
                    "back",
                    "near",
                    F.col("child").alias("node"),
                    F.expr("substring(rest, char_length(label) + 1, char_length(rest))").alias("rest"),
                    "end_n",
                    "onward",
                ),
                level,
            )
        pairs = found[0]
        for more in found[1:]:
            pairs = pairs.unionByName(more)
        # forwards finds all that agree up to the middle; backwards those come again
        turned = lambda c: F.when(F.col("back"), F.reverse(c)).otherwise(F.col(c))
        half = F.expr("char_length(word) div 2")
        agree = F.substring("word", F.lit(1), half) == F.substring("near", F.lit(1), half)
        both = pairs.select(turned("word").alias("word"), turned("near").alias("near"), F.col("end_n").alias("near_n"), "back")
        return written(both.where(~F.col("back") | ~agree).drop("back"), "neighbours", keep=True)


def variants(words: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (word, n).

    A form is the near word of largest n (ties: the smallest word), if that has ``ratio``
    times the word's n; root is where forms lead to in the end. Forms are ever more
    frequent, so few rounds of jumps find all roots.
    """
    with scratch():
        words = written(words, "words", keep=True)
        best = neighbours(words).groupBy("word").agg(
            F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
        )
        fits = -F.col("best.less") >= F.col("n") * ratio
        formed = written(
            words.join(best, "word", "left").select(
                "word",
                F.when(fits, F.col("best.near")).alias("form"),
                "n",
                F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                F.when(fits, -F.col("best.less")).alias("form_n"),
            ),
            "forms",
            keep=True,
        )
        jumps = written(formed.where("form is not null").select("word", F.col("form").alias("root")), "jumps", keep=True)
        while True:
            further = jumps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
            if jumps.join(further, "root", "left_semi").isEmpty():
                break
            jumps = written(
                jumps.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")), "jumps", keep=True
            )
    return formed.join(jumps, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
