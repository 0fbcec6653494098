"""Near-duplicate documents by MinHash with tensored banding.

A plain scheme of 144 tables with four minima each takes 576 minima per document. Here
two collections of twelve keys, each of two minima, are made (48 minima), and every pair
of a key of the first and a key of the second is a table: 144 tables from twelve times
fewer minima. A pair of texts that are 75 % alike shares no table with a chance of 1e-4.

Texts with equal shingle sets are one class. Classes meet on a key of the first
collection; inside such a bucket those that also share a key of the second (so, a
table), whose sizes allow the similarity and whose minima do not rule it out are compared
by their full sets. A crowded bucket is searched whole instead, in blocks of bounded
size, and yields a spanning forest of its links; so copies without number do not turn
into pairs without number. Links make components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import meet, scratch, taken, written
from skyledger.llm.components import components
from skyledger.llm.word_hashes import mix, shingles, stream, word_lists

WIDTH, PERCENT = 5, 75
#: Keys of each collection and minima in a key.
KEYS, MINIMA = 12, 2
#: Of all minima, as many must agree before full sets are fetched: at 75 % alike, 36 of
#: 48 do on average, fewer than 21 with a chance of 1e-7.
AGREE = 21
#: A bucket with more classes is searched in blocks; of about so many bytes of hashes.
CROWD, BLOCK_BYTES = 64, 16 << 20

_SKETCH = 2 * KEYS * MINIMA


@cache
def _parameters() -> tuple[np.ndarray, np.ndarray]:
    return stream(7, _SKETCH) | np.uint64(1), stream(8, _SKETCH)


def _sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    return [np.unique(shingles(words, width)) for _, words in word_lists(texts)]


def _minima(sets: list[np.ndarray]) -> np.ndarray:
    """_SKETCH 32-bit minima of every (non-empty) set."""
    joined = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), _SKETCH), "<u4")
    for k, (a, b) in enumerate(zip(*_parameters(), strict=True)):
        out[:, k] = np.minimum.reduceat((joined * a + b) >> np.uint64(32), starts)
    return out


def _first_keys(minima: np.ndarray) -> np.ndarray:
    """The keys of the first collection."""
    wide = minima[:, : KEYS * MINIMA].astype(np.uint64).reshape(-1, KEYS, MINIMA)
    key = wide[:, :, 0]
    for k in range(1, MINIMA):
        key = mix(key) + wide[:, :, k]
    return mix(key).view(np.int64)


def _class_ids(sets: list[np.ndarray]) -> list[bytes]:
    """128 bits that depend on the set alone."""
    joined = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    sums = np.stack([np.add.reduceat(joined, starts), np.add.reduceat(mix(joined ^ stream(9, 1)), starts)], axis=1)
    return [row.tobytes() for row in sums]


def _sketches(docs: DataFrame, id_column: str, text_column: str, width: int) -> DataFrame:
    """doc, text hash, set size, class, minima and first keys of every row; the last
    three are null for a text without words."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                sets = _sets(taken(batch, "text"), width)
                full = [k for k, s in enumerate(sets) if len(s)]
                ids, keys, minima = [None] * len(sets), [None] * len(sets), [None] * len(sets)
                if full:
                    some = [sets[k] for k in full]
                    found = _minima(some)
                    for k, i, m, a in zip(full, _class_ids(some), found, _first_keys(found), strict=True):
                        ids[k], minima[k], keys[k] = i, m.tobytes(), a
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc"),
                        batch.column("text_hash"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array(minima, pa.binary()),
                        pa.array(keys, pa.list_(pa.int64())),
                    ],
                    ["doc", "text_hash", "n", "class", "minima", "keys"],
                )

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(
        F.col(id_column).alias("doc"),
        F.xxhash64(F.col(text_column).cast("string")).alias("text_hash"),
        F.col(text_column).cast("string").alias("text"),
    )
    return rows.mapInArrow(
        sketch, f"doc {kind}, text_hash bigint, n bigint, class binary, minima binary, keys array<bigint>"
    )


def _streamed(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups of rows with equal keys out of a sorted stream, many at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(k)[-1].as_py() for k in keys]
        same = np.ones(batch.num_rows, bool)
        for k, v in zip(keys, last, strict=True):
            same &= np.asarray(pc.equal(batch.column(k), pa.scalar(v, batch.column(k).type)))
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if held and (cut or [held[-1].column(k)[-1].as_py() for k in keys] != last):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)] if cut else held)
            held = []
        elif cut:
            yield pa.Table.from_batches([batch.slice(0, cut)])
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _pairs_of_buckets(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of classes inside buckets of at most CROWD classes, each pair in
    the first bucket that it shares."""
    for rows in _streamed(batches, ["place", "key"]):
        place, key = rows["place"].to_numpy(), rows["key"].to_numpy()
        n, ids = rows["n"].to_numpy(), rows["class"].to_pylist()
        minima = np.frombuffer(b"".join(rows["minima"].to_pylist()), "<u4").reshape(-1, 2, KEYS, MINIMA)
        x_out, y_out = [], []
        for lag in range(1, len(ids)):
            x = np.flatnonzero((place[lag:] == place[:-lag]) & (key[lag:] == key[:-lag]))
            if not len(x):
                break
            y = x + lag
            x, y = (v[100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])] for v in (x, y))
            equal = minima[x] == minima[y]
            keys = equal.all(axis=3)
            first = keys[:, 0].argmax(axis=1) == place[x]
            good = keys[:, 1].any(axis=1) & first & (equal.sum(axis=(1, 2, 3)) >= AGREE)
            x_out += x[good].tolist()
            y_out += y[good].tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array([ids[k] for k in x_out], pa.binary()), pa.array([ids[k] for k in y_out], pa.binary())],
            ["x", "y"],
        )


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def _confirmed(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = [
            _alike(np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8"), percent)
            for a, b in zip(taken(batch, "x_set"), taken(batch, "y_set"), strict=True)
        ]
        yield batch.select(["x", "y"]).filter(pa.array(good, pa.bool_()))


def _links_of_block(ids: list[bytes], sets: list[np.ndarray], percent: int) -> list[tuple[bytes, bytes]]:
    """A spanning forest of the links among the sets: every link's ends are connected.

    A set of which over 100 - ``percent`` % is in no other set has no link and leaves;
    what is then alone leaves too, until nothing changes. The rest are compared by
    counting shared hashes, with sets of their own component left out.
    """
    ids, sets = list(ids), list(sets)
    while True:
        sizes = np.array([len(s) for s in sets])
        if len(sets) < 2:
            return []
        joined = np.concatenate(sets)
        order = np.argsort(joined, kind="stable")
        owner = np.repeat(np.arange(len(sets)), sizes)
        starts = np.flatnonzero(np.r_[True, np.diff(joined[order]) != 0])
        counts = np.diff(np.r_[starts, len(order)])
        rank = np.empty(len(order), np.int64)
        rank[order] = np.repeat(np.arange(len(starts)), counts)
        shared = np.add.reduceat((counts[rank] > 1).astype(np.int64), np.r_[0, np.cumsum(sizes)[:-1]])
        stay = 100 * shared >= percent * sizes
        if stay.all():
            break
        ids = [i for i, s in zip(ids, stay, strict=True) if s]
        sets = [x for x, s in zip(sets, stay, strict=True) if s]
    owners, offsets = owner[order], np.r_[0, np.cumsum(sizes)]
    label = np.arange(len(sets))
    found = []
    for x in range(len(sets) - 1):
        own = rank[offsets[x] : offsets[x + 1]]
        own = own[counts[own] > 1]
        n, first = counts[own], starts[own]
        at = np.repeat(first - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        common = np.bincount(owners[at], minlength=len(sets))
        linked = 100 * common >= percent * (sizes[x] + sizes - common)
        linked[: x + 1] = False
        for y in np.flatnonzero(linked & (label != label[x])):
            if label[y] != label[x]:
                found.append((ids[x], ids[y]))
                label[label == label[y]] = label[x]
    return found


def _links_of_crowds(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for rows in _streamed(batches, ["place", "key", "low", "high"]):
        place, key = rows["place"].to_numpy(), rows["key"].to_numpy()
        low, high = rows["low"].to_numpy(), rows["high"].to_numpy()
        same = (np.diff(place) == 0) & (np.diff(key) == 0) & (np.diff(low) == 0) & (np.diff(high) == 0)
        cuts = [0, *(np.flatnonzero(~same) + 1).tolist(), len(place)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            part = rows.slice(a, b - a)
            sets = [np.frombuffer(s, "<u8") for s in part["set"].to_pylist()]
            links = _links_of_block(part["class"].to_pylist(), sets, percent)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in links], pa.binary()), pa.array([y for _, y in links], pa.binary())],
                ["x", "y"],
            )


def _class_sets(docs: DataFrame, wanted: DataFrame, id_column: str, text_column: str, width: int) -> DataFrame:
    """(class, set) of the wanted classes, from one text of each."""
    texts = docs.select(
        F.col(id_column).alias("doc"),
        F.xxhash64(F.col(text_column).cast("string")).alias("text_hash"),
        F.col(text_column).cast("string").alias("text"),
    )
    same = F.col("doc").eqNullSafe(F.col("rep.doc")) & (F.col("text_hash") == F.col("rep.text_hash"))
    found = texts.join(wanted.select("class", "rep"), same).groupBy("class").agg(F.min("text").alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                sets = [s.astype("<u8").tobytes() for s in _sets(taken(batch, "text"), width)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("class"), pa.array(sets, pa.binary())], ["class", "set"]
                )

    return found.mapInArrow(hashed, "class binary, set binary")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``text_hash``, ``n_shingles``,
    ``component_id``, ``kept``.

    Words are as in ``word_hashes``; a text with fewer than ``width`` words is one
    shingle, one without words none, and linked with nothing. Two texts are linked if
    their shingle sets share at least ``percent`` % of their union; ``component_id`` is
    the smallest id that links reach, ``kept`` marks rows that have it. Rows with equal
    ids are told apart by their text. Null ids come last: a component of null ids only has
    a null id, and its rows are kept. Other columns are ignored.
    """
    with scratch():
        sketches = written(_sketches(docs, id_column, text_column, width), "sketches")
        classes = written(
            sketches.where("n > 0")
            .groupBy("class")
            .agg(
                F.min("doc").alias("first_id"),
                F.count("*").alias("copies"),
                F.min(F.struct("doc", "text_hash")).alias("rep"),
                F.max("n").alias("n"),
                F.max("minima").alias("minima"),
                F.max("keys").alias("keys"),
            ),
            "classes",
        )
        keys = classes.select("class", "n", F.posexplode("keys").alias("place", "key"))
        buckets = written(
            keys.groupBy("place", "key").agg(F.count("*").alias("members"), F.sum("n").alias("hashes")).where("members > 1"),
            "buckets",
        )
        many = KEYS * classes.count()
        shared = written(
            meet(keys.drop("n"), buckets, ["place", "key"], "members", many, "inner"), "shared-buckets"
        )
        small = shared.where(F.col("members") <= CROWD).join(classes.select("class", "n", "minima"), "class")
        pairs = written(
            small.select("place", "key", "class", "n", "minima")
            .repartition("place", "key")
            .sortWithinPartitions("place", "key", "class")
            .mapInArrow(lambda b: _pairs_of_buckets(b, percent), "x binary, y binary"),
            "pairs",
        )
        crowds = shared.where(F.col("members") > CROWD)
        wanted = (
            pairs.select(F.col("x").alias("class"))
            .unionByName(pairs.select(F.col("y").alias("class")))
            .unionByName(crowds.select("class"))
            .distinct()
            .join(classes.select("class", "rep"), "class")
        )
        sets = written(_class_sets(docs, wanted, id_column, text_column, width), "class-sets")
        confirmed = (
            pairs.join(sets.select(F.col("class").alias("y"), F.col("set").alias("y_set")), "y")
            .join(sets.select(F.col("class").alias("x"), F.col("set").alias("x_set")), "x")
            .mapInArrow(lambda b: _confirmed(b, percent), "x binary, y binary")
        )
        blocks = F.ceil(8 * F.col("hashes") / F.lit(BLOCK_BYTES)).cast("int")
        own = F.pmod(F.xxhash64("class"), "blocks").cast("int")
        placed = (
            crowds.withColumn("blocks", blocks)
            .withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("place", "key", "class", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
        )
        crowded = (
            placed.join(sets, "class")
            .repartition("place", "key", "low", "high")
            .sortWithinPartitions("place", "key", "low", "high")
            .mapInArrow(lambda b: _links_of_crowds(b, percent), "x binary, y binary")
        )
        roots = components(confirmed.unionByName(crowded))
        members = written(roots.join(classes.select(F.col("class").alias("x"), "first_id"), "x"), "members")
        firsts = (
            members.groupBy("root")
            .agg(F.min("first_id").alias("least"), F.count("*").alias("members"))
            .join(classes.select(F.col("class").alias("root"), F.col("first_id").alias("root_id")), "root")
            .select("root", F.least("least", "root_id").alias("component_id"), "members")
        )
        firsts = written(firsts, "firsts")
        named = meet(members.select("x", "root"), firsts, ["root"], "members", members.count(), "inner").select(
            F.col("x").alias("class"), "component_id"
        )
        named = named.unionByName(firsts.select(F.col("root").alias("class"), "component_id"))
        labels = classes.select("class", "first_id", "copies").join(named, "class", "left")
        labels = written(
            labels.select("class", "copies", F.coalesce("component_id", "first_id").alias("component_id")), "labels", keep=True
        )
        narrow = written(sketches.select("doc", "text_hash", "n", "class"), "classes-of-rows", keep=True)
    full = meet(narrow.where("n > 0"), labels, ["class"], "copies", narrow.count(), "inner")
    empty = narrow.where("n = 0").withColumn("component_id", F.col("doc"))
    out = full.select("doc", "text_hash", "n", "component_id").unionByName(
        empty.select("doc", "text_hash", "n", "component_id")
    )
    return out.select(
        F.col("doc").alias(id_column),
        "text_hash",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("doc").eqNullSafe(F.col("component_id")).alias("kept"),
    )
