"""The corpus pipeline: toxicity, boilerplate lines, near duplicates, benchmark leaks, mixing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of ``documents``; the last returns the drawn copies.

Tables come in any state the operators define: nulls, empty texts, repeated
rows and extra columns pass through as each operator's docstring says; an empty
``documents`` table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulsekit.llm import decontaminate, line_spread, mixing, ngram_join, toxicity_fm
from pulsekit.llm.storage import read_table, saved


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half by the factorization machine stay."""
    return toxicity_fm.drop_toxic(spark, docs, read_table(spark, sf_dir, "documents"),
                                  read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on many sites are cut out of the texts; every document stays. Copies of a text count as one site:
    they go in the next stage, and must not be emptied before."""
    return line_spread.strip_lines(spark, docs, copies_once=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return ngram_join.keep_one_per_class(spark, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item stay."""
    return decontaminate.drop_leaks(spark, docs, read_table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies drawn by temperature mixing."""
    return mixing.mix(spark, docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixture),
]

# The first stage is a fitted model, which SQL does not express; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
