"""Image gallery: search and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.constants import MISSING_MARK
from skyledger.functions.text import heading_case, matches_ignoring_case, nonempty
from skyledger.operators.indexing import with_row_index

#: Cards are ordered by all that tells them apart; a missing name is an empty one.
PAGE_ORDER = ("launch_year", "source", "launch_id", "image_url", "launch_name")


def gallery_search(
    images: DataFrame,
    source: str | None = None,
    year: int | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Images of one source, one year, and names that match a regular expression."""
    if source is not None:
        images = images.where(F.col("source") == source)
    if year is not None:
        images = images.where(F.col("launch_year") == year)
    if pattern:
        images = images.where(matches_ignoring_case(F.col("launch_name"), pattern))
    return images.where(F.col("image_url").isNotNull())


def gallery_pages(found: DataFrame, page_size: int = 20) -> DataFrame:
    """One row: how many images and pages there are (at least one page)."""
    pages = F.greatest(F.lit(1), F.ceil(F.col("total") / page_size)).cast("bigint")
    return found.agg(F.count("*").alias("total")).withColumn("pages", pages)


def gallery_page(found: DataFrame, page: int, page_size: int = 20) -> DataFrame:
    """Cards of one page, counted from 0. Meant for the first pages: reaching page
    *p* sorts out the best ``p * page_size`` rows. To read on, use
    :func:`gallery_after`; for any page of a table that is written once,
    :func:`written_page`."""
    rows = found.orderBy(*_page_key())
    return _cards(rows.offset(page * page_size).limit(page_size))


def gallery_after(
    found: DataFrame,
    last: tuple[int, str, str, str, str],
    shown_alike: int = 1,
    page_size: int = 20,
) -> DataFrame:
    """The page that follows a known last card (its values in ``PAGE_ORDER``), at
    any depth: earlier cards are filtered out, not sorted. Images may repeat, so
    ``shown_alike`` says how many cards equal to the last one were shown."""
    shown = F.struct(*[F.lit(v).alias(c) for c, v in zip(PAGE_ORDER, last)])
    rows = found.where(F.struct(*_page_key()) >= shown).orderBy(*_page_key())
    return _cards(rows.offset(shown_alike).limit(page_size))


def write_pages(found: DataFrame, path: str) -> None:
    """Write the cards in the order of the pages, each with its ``position``, for pages at
    any depth. Part files hold ranges of positions, and their footers say which."""
    numbered = with_row_index(found, "position", *_page_key())
    numbered.sortWithinPartitions("position").write.mode("overwrite").parquet(path)


def written_page(spark: SparkSession, path: str, page: int, page_size: int = 20) -> DataFrame:
    """One page, counted from 0, of what ``write_pages`` wrote: its positions are known, so
    the scan skips all files and row groups but those that hold them."""
    first = page * page_size
    cards = spark.read.parquet(path).where(F.col("position").between(first, first + page_size - 1))
    return _cards(cards.orderBy("position"))


def _page_key() -> list[Column]:
    *plain, name = PAGE_ORDER
    return [F.col(c) for c in plain] + [F.coalesce(name, F.lit("")).alias(name)]


def _cards(rows: DataFrame) -> DataFrame:
    name = F.coalesce(nonempty(F.col("launch_name")), F.lit(MISSING_MARK))
    tag = F.when(F.col("launch_year").isNotNull(), F.concat(F.lit(" · "), "launch_year"))
    return rows.select(
        "launch_id",
        "image_url",
        F.concat(name, F.coalesce(tag, F.lit(""))).alias("caption"),
        heading_case(F.col("source")).alias("source_label"),
    )
