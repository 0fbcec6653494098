"""Repeated runs of lines, found by winnowing and removed, in DataFrame functions only.

A line ends at a line break or at a punctuation mark or symbol with a space. Winnowing
keeps, of the lines that start within WINDOW_WORDS words of each line, the one with the
least hash; its fingerprint is the hash of the lines from there on, up to GRAM_WORDS
words. Two copies of a run of GRAM_WORDS + WINDOW_WORDS words hold the same such window
and so the same fingerprint, wherever they stand. Fingerprints meet by hash; the lines of
every later one go. Matches of one document with one source at one distance are joined;
then each is extended both ways until its lines differ from those around the source, where
this reaches lines that would stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import meet, scratch, written

#: A repeated run of fewer words than GRAM_WORDS is never removed, one of GRAM_WORDS +
#: WINDOW_WORDS or more always (a blank line counts as a word); only where the first
#: occurrence of one of its fingerprints stands in other surroundings, lines at the ends of
#: the run that are in no fingerprint may stay.
GRAM_WORDS, WINDOW_WORDS = 24, 16
#: Up to this size what is removed is sent to all tasks, and texts stay where they are;
#: beyond it both are shuffled.
BROADCAST_BYTES = 64 << 20

#: The sign beyond 16 bits, a symbol itself, makes Java look back by code points.
_END = "[\\p{P}\\p{S}\U0001f600]"
#: The last character of a line that ends within a text. It is looked for first, as few
#: characters are one; then what stands before it. Most spaces follow a plain letter, which
#: is told sooner than that no mark stands there.
_LAST = rf"[ \n](?<![a-zA-Z0-9] )(?<=\n|{_END} )"
_MARK = "\x01"


def lines(text: Column) -> Column:
    """The lines of a text; put together they are the text.

    A mark set after every line end makes for a plain split; a text that holds the mark
    itself is split between characters, which takes longer.
    """
    marked = F.split(F.regexp_replace(text, _LAST, f"$0{_MARK}"), _MARK)
    between = F.split(text, rf"(?<=\n)|(?<={_END} )")
    return F.filter(F.when(F.contains(text, F.lit(_MARK)), between).otherwise(marked), lambda line: line != "")


#: More words of a line than this make no difference.
_MOST_WORDS = 100


def _bare(pieces: Column) -> Column:
    """The lines without line breaks and outer spaces, of a text split at ``_LAST``: nothing
    is a line after the last line end."""
    ended = F.when(F.get(pieces, F.size(pieces) - 1) == "", 1).otherwise(0)
    return F.transform(F.slice(pieces, 1, F.size(pieces) - ended), lambda line: F.trim(line))


def _words(line: Column) -> Column:
    """Its white space plus one: words also end at tabs and the like."""
    spaces = F.octet_length(line) - F.octet_length(F.translate(line, " \t\v\f\r", ""))
    return spaces + 1


def _words_apart(line: Column) -> Column:
    """``_words`` of a line without tabs and the like, for less."""
    spaces = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit("")))
    return spaces + 1


def _keys(docs: DataFrame, id_column: str, text_column: str) -> tuple[Column, Column]:
    """128 bits for the id and text of a row; equal rows are one document."""
    doc, text = F.col(id_column), F.col(text_column).cast("string")
    return F.xxhash64(doc, text), F.xxhash64(F.lit(1), text, doc)


#: Lines compared at first beyond both ends of an area of matches; FURTHER_YET times as many each time
#: that all of them agree (both powers of two). Every time reads all lines again, and few
#: texts have more than some hundred.
FURTHER, FURTHER_YET = 8, 64


#: Lines of a gram that one compiled method looks at: Java leaves large ones uncompiled.
_LINES_AT_ONCE = 8


def _with(df: DataFrame, *keep: str, **values: Column) -> DataFrame:
    """``keep`` and ``values``, which are computed once a row: no later filter or expression
    takes them in, and what follows is compiled as a method of its own."""
    return df.select(*keep, F.inline(F.array(F.struct(*(value.alias(name) for name, value in values.items())))))


def _fingerprints(hashed: DataFrame) -> DataFrame:
    """(fp, row, doc, at, stop) of the window minima of every document.

    A window has as many lines as start within WINDOW_WORDS words, four at most. Lines are
    rows here that look into the arrays of their document: unlike lambdas over arrays, all of
    it is compiled. Windows begin and end in order, and so do their minima: a line is the
    minimum of some window just if it differs from that of the window before.
    """

    def hash_at(place: Column) -> Column:
        return F.get("h", place)

    def words_at(place: Column) -> Column:
        # bounded here and not line by line in a lambda, as this is compiled
        return F.least(F.coalesce(F.get("w", place).cast("int"), F.lit(0)), F.lit(_MOST_WORDS))

    i, at, doc = F.col("i"), F.col("at"), ("row", "doc", "h", "w")
    near = hashed.select(*doc, F.posexplode("h").alias("i", "x")).select(
        *doc,
        "i",
        *(F.coalesce(hash_at(i + k), F.lit((1 << 63) - 1)).alias(f"h{k + 1}") for k in range(-1, 4)),
        *(words_at(i + k).alias(f"w{k + 1}") for k in range(-1, 3)),
    )

    def ahead(first: int) -> list[Column]:
        """Hashes after the first of the window that begins with column ``first``; the
        largest number stands for those beyond it."""
        found, words = [], F.lit(0)
        for k in range(first, first + 3):
            words = words + F.col(f"w{k}")
            hashes = F.when(words < WINDOW_WORDS, F.col(f"h{k + 1}")).otherwise((1 << 63) - 1)
            found.append(hashes.alias(f"from{first}_{k - first + 1}"))
        return found

    def minimum(first: int) -> Column:
        """Lines from that window's first to its least hash, the first such."""
        own, one, two, three = F.col(f"h{first}"), *(F.col(f"from{first}_{k}") for k in (1, 2, 3))
        return (
            F.when((own <= one) & (own <= two) & (own <= three), 0)
            .when((one <= two) & (one <= three), 1)
            .when(two <= three, 2)
            .otherwise(3)
        )

    windows = near.select(*doc, "i", "h0", "h1", *ahead(0), *ahead(1))
    before = F.when(i > 0, i - 1 + minimum(0)).otherwise(-1)
    grams = _with(windows, *doc, at=i + minimum(1), before=before).where("at <> before")
    grams = grams.select(*doc, "at", F.lit(0).alias("words"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("gram"))
    # a gram goes on while it has fewer words than it needs; every line has a word at least
    for start in range(0, GRAM_WORDS, _LINES_AT_ONCE):
        block = range(start, min(start + _LINES_AT_ONCE, GRAM_WORDS))
        words, sums = F.col("words"), []
        for k in block:
            words = words + words_at(at + k)
            sums.append(words.alias(f"words{k}"))
        more = [F.col(name) < GRAM_WORDS for name in ("words", *(f"words{k}" for k in block[:-1]))]
        # xxhash64 passes over nulls
        gram = F.xxhash64("gram", *(F.when(m, hash_at(at + k)) for m, k in zip(more, block, strict=True)))
        grams = _with(
            grams.select(*doc, "at", "words", "n", "gram", *sums),
            *doc,
            "at",
            words=F.col(f"words{block[-1]}"),
            n=F.col("n") + sum((F.when(m, 1).otherwise(0) for m in more[1:]), F.when(more[0], 1).otherwise(0)),
            gram=F.when(more[0], gram).otherwise(F.col("gram")),
        )
    found = grams.where(F.col("words") >= GRAM_WORDS)
    return found.select(F.col("gram").alias("fp"), "row", "doc", "at", (at + F.col("n")).alias("stop"))


def _joined(runs: Column) -> Column:
    """Sorted (start, stop) with those that meet or overlap made one."""
    none = F.array().cast("array<struct<start: int, stop: int>>")
    closed = lambda a: F.when(a["stop"] > 0, F.array_append(a["out"], F.struct(a["start"].alias("start"), a["stop"].alias("stop")))).otherwise(a["out"])
    state = lambda start, stop, out: F.struct(start.alias("start"), stop.alias("stop"), out.alias("out"))
    return F.aggregate(
        runs,
        state(F.lit(0), F.lit(0), none),
        lambda a, r: F.when(
            (a["stop"] > 0) & (r["start"] <= a["stop"]), state(a["start"], F.greatest(a["stop"], r["stop"]), a["out"])
        ).otherwise(state(r["start"], r["stop"], closed(a))),
        closed,
    )


def _numbered(runs: DataFrame, *by: str) -> DataFrame:
    """``runs`` with ``run``: those that meet or overlap, of the same ``by``, have one number."""
    order = Window.partitionBy(*by).orderBy("start", "stop")
    reached = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("start") <= reached, 0).otherwise(1)
    number = F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return runs.withColumn("opens", opens).withColumn("run", number).drop("opens")


def _diagonals(matches: DataFrame) -> DataFrame:
    """(row, source, shift, start, stop, behind, ahead) of ``matches`` with those that meet or
    overlap made one, of one row with one source at one shift. ``behind`` and ``ahead`` are the
    lines up to the runs of the same before and after; null if there are none."""
    apart = _numbered(matches, "row", "source", "shift").groupBy("row", "source", "shift", "run").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop")
    )
    following = Window.partitionBy("row", "source", "shift").orderBy("run")
    return apart.select(
        "row",
        "source",
        "shift",
        "start",
        "stop",
        (F.col("start") - F.lag("stop").over(following)).alias("behind"),
        (F.lead("start").over(following) - F.col("stop")).alias("ahead"),
    )


def _agreeing(pairs: DataFrame, most: int) -> DataFrame:
    """``pairs`` with ``same``, how many of the first elements of the arrays ``left`` and
    ``right`` agree; they have ``most``, a power of two, at most.

    Halves are compared as a whole, then halves of the half that differs: unlike a lambda over
    pairs of elements, all of it is compiled.
    """
    found = _with(pairs, *pairs.columns, same=F.expr(f"if(size(left) = {most} and left = right, {most}, 0)"))
    step = most // 2
    while step:
        # of slices that agree one is as long as the other
        longer = f"same + {step} <= size(left) and slice(left, same + 1, {step}) = slice(right, same + 1, {step})"
        found = _with(found, *pairs.columns, same=F.expr(f"if({longer}, same + {step}, same)"))
        step //= 2
    return found


def _part(at: str, most: int) -> str:
    """The lines ``h`` from ``at`` on, with ``back`` backwards, ``most`` of them at most."""
    behind = f"reverse(slice(h, greatest({at} - {most}, 0) + 1, least({at}, {most})))"
    return f"if(back, {behind}, slice(h, {at} + 1, {most}))"


def _beyond_areas(hashed: DataFrame, diagonals: DataFrame) -> DataFrame:
    """(row, source, own, other, back, room, same) of the ends of runs from which lines go on
    agreeing that are in no run yet; ``same`` of them do, of FURTHER compared.

    Runs of a row cover areas, whatever their sources. What agrees beyond an end adds
    something only if it reaches the lines beyond its area; so these are compared at once, and
    the lines up to there, which go anyway, by one hash of them all (``inner``). Where the
    area ends with the text, as in most copies, nothing is left to compare. A row has no
    more runs than lines.
    """
    area = Window.partitionBy("row", "run")
    areas = _numbered(diagonals, "row").select(
        *diagonals.columns, F.min("start").over(area).alias("first"), F.max("stop").over(area).alias("last")
    )
    inner = "xxhash64(slice(h, least({0}, {1}) + 1, abs({0} - {1})))"
    ends = written(
        hashed.select("row", "h")
        .join(areas.hint("shuffle_hash"), "row")
        .select(
            "row",
            "source",
            "shift",
            "h",
            F.expr(
                """inline(array(
                     named_struct('at', start, 'own', first, 'back', true, 'room', behind - (start - first)),
                     named_struct('at', stop, 'own', last, 'back', false, 'room', ahead - (last - stop))))"""
            ),
        )
        .where("(room is null or room > 0) and if(back, own > 0 and own > shift, own < size(h) and own >= shift)")
        .selectExpr(
            "row",
            "source",
            "own",
            "at - shift as met",
            "own - shift as other",
            "back",
            "room",
            f"{inner.format('at', 'own')} as inner",
            f"{_part('own', FURTHER)} as left",
        ),
        "ends",
    )
    total = ends.count()
    places = ends.groupBy("source", "met", "other", "back").agg(F.count("*").alias("n"))
    theirs = written(
        hashed.selectExpr("row as source", "h")
        .join(places.hint("shuffle_hash"), "source")
        .selectExpr(
            *places.columns, f"{inner.format('met', 'other')} as inner", f"{_part('other', FURTHER)} as right"
        ),
        "sources",
    )
    met = meet(ends, theirs.withColumnRenamed("inner", "theirs"), ["source", "met", "other", "back"], "n", total, "inner")
    met = met.where("inner = theirs and get(left, 0) = get(right, 0)")
    kept = ["row", "source", "own", "other", "back", "room"]
    agreeing = _agreeing(met.select(*kept, "left", "right"), FURTHER)
    return written(agreeing.select(*kept, F.least("same", "room").alias("same")), "compared")


def _further(hashed: DataFrame, diagonals: DataFrame) -> DataFrame:
    """(row, run) of the lines that go on agreeing at an end of a run and are in no run yet,
    maybe with some that are. ``own`` and ``other`` are places in the row and in its source;
    lines are compared forth from there or, with ``back``, backwards, ``room`` of them at most:
    behind a gap begins the next run at the same shift, which has ends of its own."""

    def agreed(compared: DataFrame) -> DataFrame:
        run = "named_struct('start', if(back, own - same, own), 'stop', if(back, own, own + same))"
        return compared.where("same > 0").select("row", F.expr(run).alias("run"))

    def going_on(compared: DataFrame, most: int) -> DataFrame:
        step = F.when(F.col("back"), -F.col("same")).otherwise(F.col("same"))
        return compared.where((F.col("same") == most) & ((F.col("room") > most) | F.col("room").isNull())).select(
            "row",
            "source",
            (F.col("own") + step).alias("own"),
            (F.col("other") + step).alias("other"),
            "back",
            (F.col("room") - most).alias("room"),
        )

    most = FURTHER
    compared = _beyond_areas(hashed, diagonals)
    grown = agreed(compared)
    ends = going_on(compared, most)
    while not ends.isEmpty():
        most *= FURTHER_YET
        total = ends.count()
        places = ends.selectExpr("row", "own as at", "back").unionByName(
            ends.selectExpr("source as row", "other as at", "back")
        )
        parts = written(
            hashed.select("row", "h")
            .join(places.groupBy("row", "at", "back").agg(F.count("*").alias("n")).hint("shuffle_hash"), "row")
            .selectExpr("row", "at", "back", "n", f"{_part('at', most)} as part"),
            "parts",
        )
        mine = parts.select("row", F.col("at").alias("own"), "back", F.col("n").alias("n"), F.col("part").alias("left"))
        theirs = parts.select(
            F.col("row").alias("source"), F.col("at").alias("other"), "back", "n", F.col("part").alias("right")
        )
        both = meet(ends, mine, ["row", "own", "back"], "n", total, "inner").drop("n")
        both = meet(both, theirs, ["source", "other", "back"], "n", total, "inner").drop("n")
        agreeing = _agreeing(both, most).withColumn("same", F.least("same", "room"))
        compared = written(agreeing.select(*ends.columns, "same"), "compared")
        grown = grown.unionByName(agreed(compared))
        ends = going_on(compared, most)
    return grown


def _one_of_equal_rows(hashed: DataFrame) -> DataFrame:
    """``hashed`` without rows whose id and text an earlier row has."""
    narrow = hashed.select("k1", "k2", "row")
    equal = written(
        narrow.groupBy("k1", "k2").agg(F.min("row").alias("kept"), F.count("*").alias("n")).where("n > 1"), "equal-rows"
    )
    if equal.isEmpty():
        return hashed
    extra = meet(narrow, equal, ["k1", "k2"], "n", narrow.count(), "inner").where("row <> kept").select("row")
    return written(hashed.join(written(extra, "extra-rows"), "row", "left_anti"), "lines")


def repeated_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(k1, k2, runs) of the documents that repeat something, by ``_keys``; ``runs`` has
    (start, stop) of lines to remove, in order and apart, stop exclusive.

    The first occurrence is the one with the smallest id (null ids first), then by row,
    then by place in the text.
    """
    k1, k2 = _keys(docs, id_column, text_column)
    text = F.col(text_column).cast("string")
    tabs = F.greatest(*(F.contains(text, F.lit(c)) for c in "\t\v\f\r")).alias("tabs")
    # as elements of an array of one they are computed once; as plain columns they would be
    # put in place of their names wherever a lambda uses them
    pieces = F.explode(F.array(F.split(text, _LAST))).alias("pieces")
    bare = F.explode(F.array(_bare(F.col("pieces")))).alias("bare")
    # the row number is stored with the lines, and so the same for all who read them
    hashed = written(
        docs.select(k1.alias("k1"), k2.alias("k2"), F.col(id_column).alias("doc"), tabs, pieces)
        .select("k1", "k2", "doc", "tabs", bare)
        .select(
            "k1",
            "k2",
            "doc",
            F.transform("bare", lambda line: F.xxhash64(line)).alias("h"),
            F.when(F.col("tabs"), F.transform("bare", _words)).otherwise(F.transform("bare", _words_apart)).alias("w"),
            F.monotonically_increasing_id().alias("row"),
        )
        .where("size(h) > 0"),
        "lines",
    )
    hashed = _one_of_equal_rows(hashed)
    with scratch():
        found = written(_fingerprints(hashed), "fingerprints")
        firsts = written(
            found.groupBy("fp").agg(F.min(F.struct("doc", "row", "at")).alias("first"), F.count("*").alias("n")).where("n > 1"),
            "first-occurrences",
        )
        # a hash table of the few repeated fingerprints saves sorting all others
        met = meet(found.drop("doc"), firsts, ["fp"], "n", found.count(), "inner", "shuffle_hash")
        matches = met.where("row <> first.row or at <> first.at").select(
            "row",
            F.col("first.row").alias("source"),
            (F.col("at") - F.col("first.at")).alias("shift"),
            F.col("at").alias("start"),
            "stop",
        )
        diagonals = written(_diagonals(matches), "diagonals", keep=True)
    found_runs = diagonals.select("row", F.struct("start", "stop").alias("run")).unionByName(_further(hashed, diagonals))
    runs = found_runs.groupBy("row").agg(_joined(F.sort_array(F.collect_set("run"))).alias("runs"))
    return runs.join(hashed.select("row", "k1", "k2"), "row").select("k1", "k2", "runs")


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with its text cut, and ``removed``, the number of lines that went.

    Texts that repeat nothing stay as they are, to the byte; null texts stay null; a
    text of which everything is repeated becomes empty. Equal rows (id and text) are one
    document and cut alike. Other columns stay; one named removed is replaced.
    """
    docs = docs.drop("removed")
    with scratch():
        runs = written(repeated_runs(docs, id_column, text_column), "repeated-runs", keep=True)
    size = runs.agg(F.coalesce(F.sum(64 + 24 * F.size("runs")), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        runs = F.broadcast(runs)
    k1, k2 = _keys(docs, id_column, text_column)
    joined = docs.withColumn("_k1", k1).withColumn("_k2", k2).join(
        runs.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("runs").alias("_runs")),
        ["_k1", "_k2"],
        "left",
    )
    own = lines(F.col(text_column).cast("string"))
    gone = F.aggregate("_runs", F.lit(0), lambda n, r: n + r["stop"] - r["start"])
    left = F.filter(own, lambda line, i: ~F.exists("_runs", lambda r: (i >= r["start"]) & (i < r["stop"])))
    text = F.when(F.col("_runs").isNull(), F.col(text_column)).otherwise(F.array_join(left, ""))
    removed = F.when(F.col("_runs").isNull(), 0).otherwise(gone)
    names = [c if c != text_column else text.alias(text_column) for c in docs.columns]
    return joined.select(*names, removed.cast("long").alias("removed"))
