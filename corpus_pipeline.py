"""Documents to training tokens, in five stages.

Each stage reads what the one before has written and keeps its columns; the last one makes tokens.
A stage's table is in the shared folder, so a lost executor costs at most one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexigraph.llm import decontamination, language_id, line_dedup, near_dedup
from lexigraph.llm.common import read_table, written
from lexigraph.llm.queries import sentencepiece_digests

#: A document whose language is less sure than this is rejected.
MIN_LANGUAGE_SCORE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in no language that stands out, go."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    marked = language_id.identify(docs.select(row.alias("doc"), "text"), language_id.fit(docs))
    sure = (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return marked.where(sure).select("doc.*")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of lines go, and documents that held nothing else."""
    done = line_dedup.dedup_lines(docs)
    empty = (F.col("lines_removed") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    kept = done.where(~F.coalesce(empty, F.lit(False)))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dedup.drop_near_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontamination.remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the text decoded from them."""
    return sentencepiece_digests(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("sentencepiece", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Learnt language models and tokens are beyond SQL: tests/llm compares with a brute-force version.
ORACLE_SQL = None
