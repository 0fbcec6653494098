"""Operators against plain Python on small inputs, hot keys included."""

from __future__ import annotations

import hashlib
import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skyledger.functions.hashing import stable_int
from skyledger.functions.missions import mission_profile
from skyledger.functions.numbers import half_even
from skyledger.functions.scoring import success_probability, temperature_factor, wind_factor
from skyledger.functions.text import fixed, grouped, shortened
from skyledger.operators.filters import global_filter
from skyledger.operators.indexing import with_row_index
from skyledger.operators.joins import fan_out_left_join, literal_lookup
from skyledger.operators.latest import latest_run, newest_per_key
from skyledger.operators.quantiles import exact_quantiles
from skyledger.operators.topk import keep_top, top_n, with_remainder


def evaluate(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


def test_fan_out_join_divides_hot_keys_without_losing_rows(spark):
    left = [(k, f"l{k}") for k in range(6)] + [(0, "again"), (None, "no key")]
    right = [(0, i % 3) for i in range(300)] + [(1, 7), (1, 7), (2, 8), (9, 9), (None, 1)]
    joined = fan_out_left_join(
        spark.createDataFrame(left, "k INT, name STRING"),
        spark.createDataFrame(right, "k INT, v INT").repartition(5),
        "k",
        rows_per_task=50,
    )
    expected = Counter()
    for key, name in left:
        matches = [v for k, v in right if key is not None and k == key]
        for value in matches or [None]:
            expected[(key, name, value)] += 1
    assert Counter((r["k"], r["name"], r["v"]) for r in joined.collect()) == expected


def test_literal_lookup_keeps_unmatched_rows(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k STRING")
    out = literal_lookup(df, [("a", 1)], "k STRING, v INT", "k").collect()
    assert Counter((r["k"], r["v"]) for r in out) == Counter({("a", 1): 1, ("z", None): 1, (None, None): 1})


def linear(values, p):
    values = sorted(values)
    position = (len(values) - 1) * p
    low = int(position)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (position - low)


@pytest.mark.parametrize("parts", [1, 7])
def test_quantiles_are_exact_however_groups_are_dealt(spark, parts):
    source = random.Random(3)
    data = {
        "normal": [source.gauss(0, 1) for _ in range(997)],
        "ties": [1.0] * 700 + [source.choice([0.0, 2.0]) for _ in range(300)],
        "single": [4.5],
        "pair": [1.0, 2.0],
    }
    rows = [(g, v) for g, values in data.items() for v in values] + [("normal", None), ("other", 1.0)]
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    out = exact_quantiles(df, "g", list(data), "v", probs).collect()
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {r["g"] for r in out} == set(data)
    for row in out:
        values = data[row["g"]]
        assert row["total"] == len(values)
        for i, p in enumerate(probs):
            assert row[f"q{i}"] == pytest.approx(linear(values, p), abs=1e-12)
        if len(values) > 1:
            assert row["q2"] == pytest.approx(statistics.median(values))


def test_row_index_is_gapless_with_a_hot_order_key(spark):
    rows = [("2020-01-01", i) for i in range(500)] + [(f"2020-02-{d:02d}", d) for d in range(1, 29)]
    df = spark.createDataFrame(rows, "day STRING, id INT").repartition(7)
    out = with_row_index(df, "pos", "day", "id").collect()
    placed = {r["pos"]: (r["day"], r["id"]) for r in out}
    assert [placed[i] for i in range(len(rows))] == sorted(rows)


def test_top_ties_go_to_the_lower_key(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), ("d", 1)], "k STRING, n INT")
    assert [r["k"] for r in top_n(df, 2, "n", "k").collect()] == ["c", "a"]
    facts = spark.createDataFrame([("a", 1, 3), ("a", 2, 2), ("b", 1, 5), ("c", 1, 1)], "k STRING, y INT, n INT")
    kept = keep_top(facts, 1, "k", F.sum("n")).collect()
    assert {(r["k"], r["y"]) for r in kept} == {("a", 1), ("a", 2)}


def test_remainder_row_exists_even_when_empty(spark):
    df = spark.createDataFrame([("a", 3), ("b", 2), ("c", 1)], "k STRING, n BIGINT")
    assert {tuple(r) for r in with_remainder(df, 2, "k", "n", "rest").collect()} == {
        ("a", 3), ("b", 2), ("rest", 1)}
    assert ("rest", 0) in {tuple(r) for r in with_remainder(df, 5, "k", "n", "rest").collect()}


def test_runs(spark):
    df = spark.createDataFrame(
        [("1", "a", "old"), ("2", "a", "new"), ("1", "b", "only"), ("2", None, "x")],
        "run_id STRING, id STRING, v STRING",
    )
    assert {r["v"] for r in latest_run(df).collect()} == {"new", "x"}
    assert {r["v"] for r in latest_run(df, "1").collect()} == {"old", "only"}
    assert {(r["id"], r["v"]) for r in newest_per_key(df, "id").collect()} == {("a", "new"), ("b", "only")}


def test_filters(spark):
    df = spark.createDataFrame(
        [(1, 2000, "P", "LEO"), (2, 2001, "Q", "GTO"), (3, 2002, None, "LEO"), (4, 2003, "P", None)],
        "id INT, launch_year INT, provider_name STRING, mission_orbit STRING",
    )

    def ids(**choice):
        return {r["id"] for r in global_filter(df, **choice).collect()}

    assert ids() == {1, 2, 3, 4}
    assert ids(providers=[]) == {1, 2, 3, 4}
    assert ids(first_year=2001, last_year=2002) == {2, 3}
    assert ids(providers=["P", "Q"]) == {1, 2, 4}
    assert ids(providers=["P"], orbits=["LEO"]) == {1}


def test_stable_int(spark):
    assert evaluate(spark, stable_int(F.lit("abc"))) == 493_438
    for text in ("", "é", "pad:12", "x" * 300):
        head = int(hashlib.sha1(text.encode()).hexdigest()[:8], 16)
        assert evaluate(spark, stable_int(F.lit(text), 2_000, 800_000)) == 2_000 + head % 800_000


@pytest.mark.parametrize(
    "name, variant, expected",
    [
        ("Starlink 4", 1, ("Satellite Deployment", "LEO")),
        ("Crew Dragon", 1, ("Crewed Mission", "LEO")),
        ("CRS-20", 1, ("Cargo Resupply", "LEO")),
        ("Dragon CRS-20", 1, ("Crewed Mission", "LEO")),
        ("Transporter-1", 1, ("Ride Share", "LEO")),
        ("STARSHIP test", 5, ("Test Flight", "Suborbital")),
        ("GPS III", 1, ("Government Payload", "MEO")),
        ("Intelsat 40", 1, ("Communications", "GTO")),
        ("Other", 5, ("Technology Demonstration", "LEO")),
        ("Other", 6, ("Orbital Launch", "LEO")),
    ],
)
def test_mission_profile(spark, name, variant, expected):
    assert tuple(evaluate(spark, mission_profile(F.lit(name), F.lit(variant)))) == expected


@pytest.mark.parametrize(
    "celsius, factor",
    [(10.0, 1.0), (28.0, 1.0), (9.9, 1 - 0.1 * 0.025), (-20.0, 0.55), (28.1, 1 - 0.1 * 0.018), (50.0, 0.65)],
)
def test_temperature_factor(spark, celsius, factor):
    assert evaluate(spark, temperature_factor(F.lit(celsius))) == pytest.approx(factor)


@pytest.mark.parametrize("kmh, factor", [(30.0, 1.0), (45.0, 0.8), (60.0, 0.6), (60.1, 0.6 - 0.1 / 60 * 0.55), (120.0, 0.05), (500.0, 0.05)])
def test_wind_factor(spark, kmh, factor):
    assert evaluate(spark, wind_factor(F.lit(kmh))) == pytest.approx(factor)


def test_probability_is_clamped_and_null_safe(spark):
    def score(*factors):
        return evaluate(spark, success_probability(*[F.lit(f).cast("double") for f in factors]))

    assert score(1.0, 1.0, 1.0) == 0.99
    assert score(0.0, 1.0, 1.0) == 0.01
    assert score(0.82, 1.0, 0.5) == pytest.approx(0.41)
    assert score(0.82, None, 1.0) is None


def test_numbers_as_text(spark):
    for value in (0.25, 12.35, 1234567.75, 0.5, 1.5, 2.5, 99.95):
        for digits in (0, 1):
            assert evaluate(spark, grouped(F.lit(value), digits)) == f"{value:,.{digits}f}"
            assert evaluate(spark, fixed(F.lit(value), digits)) == f"{value:.{digits}f}"
    assert evaluate(spark, half_even(F.lit(0.25), 1)) == 0.2
    assert evaluate(spark, half_even(F.lit(0.35), 1)) == 0.4
    assert evaluate(spark, shortened(F.lit("abcd"), 3, "…")) == "abc…"
    assert evaluate(spark, shortened(F.lit("abc"), 3, "…")) == "abc"
