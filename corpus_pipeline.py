"""The corpus pipeline: from documents to packed training sequences.

Each stage takes what the one before wrote and returns the columns of ``documents``; the
last returns the pieces of the packed sequences. Every stage's operator says in its
docstring what it does with nulls, empty texts, ties and repeated rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import decontamination, line_dedup, near_duplicates, packing, toxicity
from skyledger.llm.common import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Toxicity score from which on a document goes.
TOXIC_FROM = 0.3


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression distance does not call toxic (operator 7)."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where(F.col("score") < TOXIC_FROM).drop("score")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of lines that others have before them (operator 9).

    A document of which no word is left goes, for all of it is elsewhere; one that was
    empty before stays. ``n_chars`` follows a text that was cut.
    """
    cut = line_dedup.without_repeats(docs)
    kept = cut.where((F.col("removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    chars = F.when(F.col("removed") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", chars).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies (operator 4).

    Of equal rows one stays; rows that share an id and not their text are told apart.
    """
    kept = near_duplicates.near_duplicates(docs).where("kept").select("doc_id", "text_hash").distinct()
    hashed = docs.withColumn("_hash", F.xxhash64("text"))
    same = hashed["doc_id"].eqNullSafe(kept["doc_id"]) & (hashed["_hash"] == kept["text_hash"])
    return hashed.join(kept, same, "left_semi").dropDuplicates(["doc_id", "_hash"]).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no item of the benchmark (operator 3)."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 2048 tokens (operator 10)."""
    return packing.pack(packing.token_pieces(docs))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("near dedup", one_of_each_group),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: Tokenization, compression distances and searches have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
