"""Documents to token ids: quality rules, near-duplicates, repeated passages, benchmark passages, tokens.

Each stage takes (spark, docs, folder of the tables) and works on all documents that the one before has kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from matchlytics.llm.common import stored
from matchlytics.llm.decontaminate import decontaminate
from matchlytics.llm.quality_rules import quality_rules
from matchlytics.llm.queries import MODEL
from matchlytics.llm.sentencepiece import round_trip
from matchlytics.llm.simhash import one_of_each
from matchlytics.llm.suffix_dedup import remove_repeated_strings


#: Columns that the operators read; all others are out of their sight, whatever their names.
USED = ("doc_id", "text", "source")


def _with_text(docs: DataFrame, operator: Callable[[DataFrame], DataFrame], kept: Column | None = None) -> DataFrame:
    """The rows that ``operator`` gives for ``docs``, those ``kept`` if given, with ``cleaned`` as their text and its length."""
    names = {c: f"user_column_{k}" for k, c in enumerate(docs.columns) if c not in USED}
    found = operator(docs.toDF(*(names.get(c, c) for c in docs.columns)))
    new = {"text": F.col("cleaned")} | ({"n_chars": F.length("cleaned").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    rows = found if kept is None else found.where(kept)
    return rows.select(*(new.get(c, F.col(names.get(c, c))).alias(c) for c in docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines above the limits go from the others.

    Null and empty texts are rejected. Rows of one id and text count as one document of their host and stay or go together;
    of the documents with a line above the limit the one of the smallest id (a null id is larger than any) keeps it.
    """
    return _with_text(docs, quality_rules, F.col("kept"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by fingerprints of three-word shingles that differ in three bits at most, the document of the smallest id stays.

    Rows of a null or shared id are documents of their own, told apart by their text; null ids come last. Rows equal in id and
    text are one document. Texts without words, null ones too, are copies of each other.
    """
    return one_of_each(docs).select(docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes found twice go, in whole characters, all their occurrences.

    Every row stays, if with an empty text. A null text stays null; repeated rows repeat each other's strings.
    """
    return _with_text(docs, remove_repeated_strings)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words hit by ten-word windows of the benchmark go.

    Every row stays, repeated rows and null ids too, if with an empty text; a null text stays null.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _with_text(docs, lambda own: decontaminate(own, benchmark))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, and what they decode to, a row for each row; a null text has no ids and decodes to an empty one."""
    both = round_trip(docs.select("doc_id", "text"), MODEL)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").alias("text"))


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_copies),
    ("repeated passages", repeated_passages),
    ("benchmark passages", benchmark_passages),
    ("tokens", tokens),
]

#: Near copies and tokens can't be said in SQL; tests/llm/test_pipeline.py has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
    return docs
