"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Every rule measures how far a document is above what good ones have, in units of their
spread; the furthest rule is the document's level. A quarter of the labelled holdout gives
those units, by stratum, and the other part tests cutoffs of the level. A cutoff is
certified if, were its rate of rejecting good documents above RISK, as few rejections as
were seen would have a binomial probability of at most DELTA over the number of strata.
Cutoffs are tested from the strictest down and the first failure ends the sequence, so
each has the whole error probability. All rules together reject at most RISK of a stratum's
good documents, with probability 1 - DELTA over all strata; a stratum without a certified
cutoff rejects nothing. With no good document rejected, a cutoff needs 217 tested good
documents in each of four strata (317 in each of 30), some 290 (425) with the quarter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import written

#: Allowed share of good documents rejected in a stratum, and the chance of exceeding it.
RISK, DELTA = 0.02, 0.05
#: Steps of each rule's value, and levels of a document.
STEPS = 64
#: Levels per spread of the good documents, and the part of the holdout that gives it.
FINENESS, LEARNING = 4, 4

#: Rules: the value as SQL over the features, and the step between cutoffs.
RULES = {
    "symbols": ("n_symbols / n_words", 0.05),
    "duplicate_lines": ("n_dup_lines / n_lines", 1 / 64),
    "repeated_words": ("n_repeat_words / n_words", 1 / 64),
    "long_words": ("word_chars / n_words", 0.5),
    "short_words": ("greatest(0, 16 - word_chars / n_words)", 0.25),
    "brevity": ("64 - least(64, n_words / 4)", 1.0),
}

_SPACE = r"[\x20\x09-\x0D]+"
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once per row. As a plain column it would be
    put in place of its name wherever a lambda uses it, and computed for every element."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def features(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with FEATURES of every whole text; a null text has none of anything.

    Words are runs without space, tab and line ends. ``n_repeat_words`` counts words in
    windows of three that the text has twice or more; windows and lines are told apart by
    64-bit hashes. Columns of these names are replaced.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    filled = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    names = [c for c in docs.columns if c not in FEATURES]
    base = docs.select(*names)
    split = _once(base, "_words", words)
    split = _once(split, "_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    split = _once(
        split,
        "_windows",
        F.expr(
            """if(size(_hashes) < 3, cast(array() as array<bigint>), transform(sequence(0, size(_hashes) - 3),
               i -> xxhash64(_hashes[i], _hashes[i + 1], _hashes[i + 2])))"""
        ),
    )
    split = _once(split, "_lines", F.transform(filled, lambda line: F.xxhash64(line)))
    # windows in order of hash and place: those with a neighbour of the same hash repeat
    split = _once(
        split,
        "_sorted",
        F.expr(
            """if(size(array_distinct(_windows)) = size(_windows),
                  cast(array() as array<struct<h: bigint, i: int>>),
                  sort_array(transform(_windows, (h, i) -> named_struct('h', h, 'i', i))))"""
        ),
    )
    split = _once(
        split,
        "_repeated",
        F.expr(
            """sort_array(transform(filter(
                 transform(_sorted, (x, k) -> named_struct('i', x.i, 'twice',
                   (k > 0 and x.h = _sorted[greatest(k, 1) - 1].h)
                   or (k + 1 < size(_sorted) and x.h = _sorted[least(k + 1, size(_sorted) - 1)].h))),
                 x -> x.twice), x -> x.i))"""
        ),
    )
    covered = F.expr(
        """aggregate(_repeated, named_struct('end', 0, 'n', 0L),
             (a, i) -> named_struct('end', i + 3, 'n', a.n + i + 3 - greatest(a.end, i)), a -> a.n)"""
    )
    return split.select(
        *names,
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
    )


def base_failed() -> Column:
    """Too short, or more than half of the words repeated."""
    return F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")


def steps() -> Column:
    """For each rule, which step (0 to STEPS) the document reaches; null without words."""
    reached = [
        F.expr(f"least({STEPS}, cast(floor(({value}) / {step}) as int))").alias(name)
        for name, (value, step) in RULES.items()
    ]
    return F.when(F.col("n_words") > 0, F.struct(*reached))


def binomial_at_most(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X of ``n`` trials of chance ``p``, for k below the mean (1 above).

    The largest term comes from log-factorials, the rest from ratios of neighbours; terms
    fall at least as fast as a Gaussian's, so those beyond ten deviations are left out.
    """

    def log_factorial(x: Column) -> Column:
        exact = F.log(F.factorial(F.least(x, F.lit(20)).cast("int")).cast("double"))
        series = x * F.log(x) - x + F.log(2 * F.pi() * x) / 2 + 1 / (12 * x) - 1 / (360 * F.pow(x, F.lit(3)))
        return F.when(x <= 20, exact).otherwise(series)

    log_term = (
        log_factorial(n) - log_factorial(k) - log_factorial(n - k) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p))
    )
    terms = F.least(k, F.ceil(10 * F.sqrt(n)) + 50).cast("int")
    total = F.aggregate(
        F.sequence(F.lit(0), terms),
        F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")),
        lambda a, j: F.struct(
            (a["term"] * (k - j) * F.lit(1 - p) / ((n - k + j + 1) * F.lit(p))).alias("term"),
            (a["sum"] + a["term"]).alias("sum"),
        ),
        lambda a: a["sum"],
    )
    return F.when(k >= n * p, 1.0).otherwise(F.exp(log_term) * total)


def _levels() -> Column:
    """Rule to level (0 to STEPS) of ``_steps``, by the ``_units`` of the stratum."""
    each = [
        f"""'{name}', least({STEPS}, greatest(0, cast(floor({FINENESS} * (_steps.{name} - _units['{name}'][1])
            / greatest(1, _units['{name}'][1] - _units['{name}'][0])) as int)))"""
        for name in RULES
    ]
    return F.expr(f"map({', '.join(each)})")


def certified_cutoffs(labelled: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(_stratum, _units, _cutoff): of every stratum with good labels to learn from, the
    median and the share ``1 - risk`` of their steps by rule, and the lowest certified
    cutoff of the level, if any.

    ``labelled`` has doc_id, _stratum, good (boolean) and ``_steps``. Counts are taken over
    all labelled rows; what follows works on at most STEPS + 1 counts per rule and stratum.
    """
    good = labelled.where("good and _steps is not null")
    learns = F.pmod(F.xxhash64("doc_id"), F.lit(LEARNING)) == 0
    units = written(
        good.where(learns)
        .select("_stratum", F.explode(F.array(*(
            F.struct(F.lit(name).alias("rule"), F.col(f"_steps.{name}").alias("step")) for name in RULES
        ))).alias("x"))
        .groupBy("_stratum", "x.rule", "x.step")
        .agg(F.count("*").alias("n"))
        .groupBy("_stratum", "rule")
        .agg(F.expr(f"percentile(step, array(0.5, {1 - risk}), n)").alias("unit"))
        .groupBy("_stratum")
        .agg(F.map_from_entries(F.collect_list(F.struct("rule", "unit"))).alias("_units")),
        "units",
    )
    level = F.array_max(F.map_values(_levels()))
    whole = written(
        good.where(~learns)
        .join(units, "_stratum")
        .select("_stratum", level.alias("level"))
        .groupBy("_stratum", "level")
        .agg(F.count("*").alias("n"))
        .groupBy("_stratum")
        .agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("level", "n"))).alias("by_level"))
        # fewer could not be certified if there were no other stratum; their number tells nothing of rejections
        .where(F.pow(F.lit(1 - risk), F.col("total")) <= delta),
        "label-counts",
    )
    strata = max(1, whole.count())
    tried = whole.withColumn("cutoff", F.explode(F.sequence(F.lit(1), F.lit(STEPS)))).withColumn(
        "rejected",
        F.expr("aggregate(map_values(map_filter(by_level, (s, n) -> s >= cutoff)), 0L, (a, n) -> a + n)"),
    )
    passes = (
        binomial_at_most(F.col("rejected").cast("double"), F.col("total").cast("double"), risk) <= delta / strata
    )
    # the cutoff above the first failure from the top
    cutoffs = tried.groupBy("_stratum").agg(
        (F.coalesce(F.max(F.when(~passes, F.col("cutoff"))), F.lit(0)) + 1).alias("_cutoff")
    )
    return units.join(cutoffs.where(F.col("_cutoff") <= STEPS), "_stratum", "left")


def judge(
    docs: DataFrame,
    labels: DataFrame,
    text_column: str = "text",
    stratum_column: str = "lang",
    risk: float = RISK,
    delta: float = DELTA,
) -> DataFrame:
    """The rows of ``docs`` without the text, with FEATURES, ``base_failed``,
    ``rejected_by`` (rules) and ``kept``.

    ``labels`` has doc_id and quality; a document labelled good once is good, and rows
    without an id or label do not count. A null stratum is a stratum; one without enough
    labels (see above) has no cutoff. Texts are measured once and not shuffled. Cutoffs are
    a row per stratum with labelled documents, so their side of the join is small.
    """
    stratum = F.coalesce(F.col(stratum_column).cast("string"), F.lit("\0none"))
    measured = written(
        features(docs, text_column).drop(text_column).withColumn("_stratum", stratum).withColumn("_steps", steps()),
        "measures",
    )
    known = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg((F.max("quality") > 0).alias("good"))
    )
    labelled = measured.select("doc_id", "_stratum", "_steps").join(known, "doc_id")
    met = measured.join(certified_cutoffs(labelled, risk, delta), "_stratum", "left").withColumn("_levels", _levels())
    fired = F.filter(
        F.array(*(F.when(F.col("_levels")[name] >= F.col("_cutoff"), F.lit(name)) for name in RULES)),
        lambda x: x.isNotNull(),
    )
    return (
        met.withColumn("base_failed", base_failed())
        .withColumn("rejected_by", fired)
        .withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
        .drop("_stratum", "_steps", "_units", "_levels", "_cutoff")
    )
