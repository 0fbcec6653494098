"""The text report: facts from all tables as lines of a Markdown document.

Lines are rows ``(section, measure, label, step, line)``. Sorting by section,
measure descending, label and step gives the reading order; the text sink then
puts a newline between lines. No section is gathered in one task, so a section
that lists every provider may be as long as it needs to be.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.constants import NOT_AVAILABLE
from skyledger.functions.numbers import exact_mean, money_sum
from skyledger.functions.text import fixed, grouped, nonempty, shortened
from skyledger.operators.topk import top_n, top_per_group
from skyledger.sources.sinks import write_text_lines

COST = "estimated_cost_usd"


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _line(section: int, text: Column, measure=None, label=None, step: int = 0) -> list[Column]:
    return [
        F.lit(section).alias("section"),
        (F.lit(None) if measure is None else measure).cast("double").alias("measure"),
        (F.lit("") if label is None else label).alias("label"),
        F.lit(step).alias("step"),
        text.alias("line"),
    ]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _stacked_lines(row: DataFrame, section: int, lines: list[Column]) -> DataFrame:
    """Several lines out of each row, in order, with the row's own sort keys."""
    numbered = F.posexplode(F.array(*lines))
    keys = [c for c in ("measure", "label") if c in row.columns]
    exploded = row.select(*keys, numbered.alias("step", "line"))
    measure = F.col("measure") if "measure" in keys else None
    label = F.col("label") if "label" in keys else None
    flat = _line(section, F.col("line"), measure, label)
    flat[3] = F.col("step")
    return exploded.select(*flat).where(F.col("line").isNotNull())


def context_overview(metrics: DataFrame) -> DataFrame:
    """One row: period, totals and success percentage."""
    success, total = F.sum("successful_launches"), F.sum("total_launches")
    return metrics.agg(
        F.min("launch_year").alias("first_year"),
        F.max("launch_year").alias("last_year"),
        total.alias("total"),
        success.alias("success"),
        (success / F.greatest(total, F.lit(1)) * 100).alias("success_pct"),
    )


def context_providers(metrics: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` largest providers with the unweighted mean of their yearly rates."""
    grouped_rates = metrics.where(F.col("provider_name").isNotNull()).groupBy("provider_name").agg(
        F.sum("total_launches").alias("total"), F.avg("success_rate_pct").alias("mean_rate")
    )
    return top_n(grouped_rates, n, "total", "provider_name")


#: part of the cost lines -> column it groups by
COST_PARTS = {"category": "cost_category", "provider": "provider_name", "rocket": "rocket_name"}


def context_costs(costs: DataFrame, rockets: int = 8) -> DataFrame:
    """``(part, label, measure)``: launches per category, mean cost per provider,
    and the ``rockets`` with the highest mean cost.

    Launches are read once: combinations of the three columns are summed first, and
    all parts come from these.
    """
    combinations = costs.select(
        *[F.col(c).alias(part) for part, c in COST_PARTS.items()], F.col(COST)
    ).groupBy(*COST_PARTS).agg(
        money_sum(F.col(COST)).alias("cost"), F.count(COST).alias("priced"), F.count("*").alias("launches")
    )
    measures = ["cost", "priced", "launches"]
    lines = (
        combinations.unpivot(measures, list(COST_PARTS), "part", "label")
        .where(F.col("label").isNotNull())
        .groupBy("part", "label")
        .agg(*[F.sum(m).alias(m) for m in measures])
        .select(
            "part",
            "label",
            F.when(F.col("part") == "category", F.col("launches").cast("double"))
            .otherwise(F.try_divide(F.col("cost").cast("double"), F.col("priced")))
            .alias("measure"),
        )
    )
    dearest = top_n(lines.where(F.col("part") == "rocket"), rockets, "measure", "label")
    return lines.where(F.col("part") != "rocket").unionByName(dearest)


#: dimension -> (how many values are reported, heading, what is counted)
TOP_VALUES = {
    # --- Fixed values: report sections ---------------------------------------
    "mission_type": (10, "## Tipos de misión", ""),
    "mission_orbit": (8, "## Órbitas", ""),
    "pad_country_code": (8, "## Países con más lanzamientos", ""),
    "rocket_name": (10, "## Cohetes más usados", " lanzamientos"),
}


def context_top_values(launches: DataFrame) -> DataFrame:
    """The most frequent values of four dimensions, in one pass.

    Combinations are counted first, so what is unpivoted is already small.
    """
    dims = list(TOP_VALUES)
    combinations = launches.groupBy(*dims).agg(F.count("*").alias("launches"))
    counts = (
        combinations.unpivot(["launches"], dims, "dim", "value")
        .where(F.col("value").isNotNull())
        .groupBy("dim", "value")
        .agg(F.sum("launches").alias("launches"))
    )
    longest = max(n for n, _, _ in TOP_VALUES.values())
    wanted = F.element_at(_literal_map({d: n for d, (n, _, _) in TOP_VALUES.items()}), F.col("dim"))
    best = top_per_group(counts, "dim", longest, "launches", "value")
    return best.where(F.col("place") <= wanted).drop("place")


def context_rockets(rockets: DataFrame) -> DataFrame:
    """Up to three report lines per rocket, as ``(rocket_name, step, line)``."""
    missing = F.lit(NOT_AVAILABLE)

    def value(*parts: Column | str) -> Column:
        return F.coalesce(_text(*parts), missing)

    # --- Fixed values: report texts -------------------------------------------
    facts = _text(
        "- Estado: ",
        F.when(F.coalesce("is_active", F.lit(False)), "Activo").otherwise("Inactivo"),
        " | Coste: ",
        value("$", fixed(F.col("cost_per_launch_usd") / 1e6, 0), "M"),
        " | Éxito: ",
        value(fixed(F.col("success_rate_pct"), 0), "%"),
        " | Altura: ",
        value(fixed(F.col("height_meters"), 0), "m"),
        " | Masa: ",
        value(fixed(F.col("mass_kg") / 1000, 0), "t"),
        " | Primer vuelo: ",
        F.coalesce("first_flight_date", missing),
    )
    description = shortened(nonempty(F.col("description")), 300, "...")
    lines = F.array(
        _text("### ", F.coalesce("rocket_name", F.lit("?"))),
        facts,
        _text("- ", description),
    )
    return rockets.select("rocket_name", F.posexplode(lines).alias("step", "line")).where(
        F.col("line").isNotNull()
    )


def context_document(
    metrics: DataFrame,
    costs: DataFrame,
    launches: DataFrame,
    rockets: DataFrame,
    title: str = "# Datos del Dashboard",
) -> DataFrame:
    """All lines of the report."""
    spark = metrics.sparkSession
    return _union(
        [
            _fixed_line(spark, 0, title),
            _fixed_line(spark, 0, "", step=1),
            _overview_lines(metrics),
            _provider_lines(metrics),
            *_cost_lines(costs),
            *_top_value_lines(launches),
            _rocket_lines(rockets),
        ]
    )


def _fixed_line(spark: SparkSession, section: int, text: str, step: int = 0) -> DataFrame:
    return spark.range(1).select(*_line(section, F.lit(text), step=step))


def _overview_lines(metrics: DataFrame) -> DataFrame:
    # --- Fixed values: report texts -------------------------------------------
    return _stacked_lines(
        context_overview(metrics),
        1,
        [
            F.lit("## Resumen general"),
            _text(
                "- Periodo: ",
                F.col("first_year").cast("string"),
                "–",
                F.col("last_year").cast("string"),
            ),
            _text("- Total lanzamientos: ", grouped(F.col("total"))),
            _text(
                "- Exitosos: ",
                grouped(F.col("success")),
                " (",
                fixed(F.col("success_pct"), 1),
                "%)",
            ),
            F.lit(""),
        ],
    )


def _provider_lines(metrics: DataFrame) -> DataFrame:
    # --- Fixed values: report texts -------------------------------------------
    text = _text(
        "- ",
        F.col("provider_name"),
        ": ",
        F.col("total").cast("string"),
        " lanzamientos, tasa éxito ",
        fixed(F.col("mean_rate"), 1),
        "%",
    )
    items = context_providers(metrics).select(
        *_line(3, text, F.col("total"), F.col("provider_name"))
    )
    return _titled(items, 2, "## Top 10 proveedores")


def _titled(items: DataFrame, section: int, title: str) -> DataFrame:
    """A heading before the items, which are in the section that follows, and an
    empty line after them."""
    spark = items.sparkSession
    return _union(
        [_fixed_line(spark, section, title), items, _fixed_line(spark, section + 2, "")]
    )


def _cost_lines(costs: DataFrame) -> list[DataFrame]:
    spark = costs.sparkSession
    parts = context_costs(costs)
    totals = costs.agg(
        (money_sum(F.col(COST)).cast("double") / 1e9).alias("billions"),
        (exact_mean(F.col(COST)) / 1e6).alias("millions"),
    )
    # --- Fixed values: report texts -------------------------------------------
    opening = _stacked_lines(
        totals,
        10,
        [
            F.lit("## Costes de lanzamiento (estimados)"),
            _text("- Inversión total: $", fixed(F.col("billions"), 1), "B USD"),
            _text("- Coste promedio: $", fixed(F.col("millions"), 1), "M USD/lanzamiento"),
        ],
    )
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("measure")).alias("m"), "label")))
    entries = F.transform(
        ranked, lambda x: _text(x["label"], "=", (-x["m"]).cast("bigint").cast("string"))
    )
    categories = (
        parts.where(F.col("part") == "category")
        .agg(F.array_join(entries, ", ").alias("listed"))
        .select(*_line(11, _text("- Categorías: ", F.col("listed"))))
    )
    item = _text("  - ", F.col("label"), ": $", fixed(F.col("measure") / 1e6, 1), "M")

    def listing(section: int, title: str, part: str) -> list[DataFrame]:
        items = parts.where(F.col("part") == part)
        return [
            _fixed_line(spark, section, title),
            items.select(*_line(section + 1, item, F.col("measure"), F.col("label"))),
        ]

    return [
        opening,
        categories,
        *listing(12, "- Coste medio por proveedor:", "provider"),
        *listing(14, "- Cohetes más caros:", "rocket"),
        _fixed_line(spark, 16, ""),
    ]


def _top_value_lines(launches: DataFrame) -> list[DataFrame]:
    spark = launches.sparkSession
    sections = {dim: 20 + 3 * i for i, dim in enumerate(TOP_VALUES)}
    values = context_top_values(launches)
    section = F.element_at(_literal_map({d: s + 1 for d, s in sections.items()}), F.col("dim"))
    unit = F.element_at(_literal_map({d: u for d, (_, _, u) in TOP_VALUES.items()}), F.col("dim"))
    text = _text("- ", F.col("value"), ": ", F.col("launches").cast("string"), unit)
    columns = _line(0, text, F.col("launches"), F.col("value"))
    columns[0] = section.alias("section")
    frames = [values.select(*columns)]
    for dim, (_, title, _) in TOP_VALUES.items():
        frames.append(_fixed_line(spark, sections[dim], title))
        frames.append(_fixed_line(spark, sections[dim] + 2, ""))
    return frames


def _literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def _rocket_lines(rockets: DataFrame) -> DataFrame:
    columns = _line(41, F.col("line"), None, F.coalesce("rocket_name", F.lit("?")))
    columns[3] = F.col("step")
    items = context_rockets(rockets).select(*columns)
    # --- Fixed values: report texts -------------------------------------------
    return _titled(items, 40, "## Cohetes SpaceX (API oficial)")


def write_document(lines: DataFrame, path: str) -> None:
    """Write the report as text, one line per row, in reading order."""
    write_text_lines(lines, path, "line", "section", F.desc("measure"), "label", "step")
